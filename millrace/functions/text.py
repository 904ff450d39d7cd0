"""Text helpers used as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(number: Column) -> Column:
    """Integer with grouped thousands: 1234567 -> ``1,234,567``."""
    return F.format_number(number, 0)


def base_name(path: Column) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def hash_prefix(*parts: Column, length: int = 6) -> Column:
    """First hex digits of the md5 of the joined parts; spreads file names over a key space."""
    return F.substring(F.md5(F.concat(*[p.cast("string") for p in parts])), 1, length)


def parse_int(text: Column) -> Column:
    """The number in ``text``, or NULL when it is not one (never an error)."""
    return text.try_cast("bigint")


def full_match(text: Column, pattern: str) -> Column:
    """True when the whole text matches the pattern."""
    return text.rlike(rf"(?s)\A(?:{pattern})\z")
