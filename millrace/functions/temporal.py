"""Event time, calendar paths and epoch conversions (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LONG = 2**63 - 1


def event_time(ts: Column) -> Column:
    """Zone-less parquet timestamps as instants, so that they can carry a watermark."""
    return ts.cast("timestamp")


def after_first_comma(line: Column) -> Column:
    return F.substring(line, F.instr(line, ",") + 1, F.length(line))


def instant_of_log_line(line: Column) -> Column:
    """The ISO instant after the first comma of ``key,instant``."""
    return F.to_timestamp(after_first_comma(line))


def date_parts(ts: Column, down_to: str = "hour") -> dict[str, Column]:
    """Columns of a ``year=/month=/day=/hour=/minute=`` directory layout, all of type string."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH", "minute": "mm"}
    names = list(parts)[:list(parts).index(down_to) + 1]
    return {name: F.date_format(ts, parts[name]) for name in names}


def date_path(ts: Column, minute: bool = False) -> Column:
    """The same layout as one path string."""
    pattern = "'year='yyyy'/month='MM'/day='dd'/hour='HH"
    return F.date_format(ts, pattern + ("'/minute='mm" if minute else ""))


def file_safe(text: Column) -> Column:
    """Window text usable in a file name: ``:`` becomes ``_``."""
    return F.translate(text, ":", "_")


def reverse_timestamp(ts: Column) -> Column:
    """Milliseconds counted down from the largest long, so that newer rows sort first."""
    return F.lit(MAX_LONG) - F.unix_millis(ts)


def micros_of_day(time: Column) -> Column:
    """Microseconds since midnight of a TIME value."""
    return F.time_diff(F.lit("MICROSECOND"), F.to_time(F.lit("00:00:00")), time)


def time_from_micros(micros: Column) -> Column:
    """TIME of day from microseconds since midnight."""
    second = F.floor(micros / 1_000_000)
    return F.make_time(
        F.floor(second / 3600).cast("int"),
        (F.floor(second / 60) % 60).cast("int"),
        ((micros % 60_000_000) / 1_000_000).cast("decimal(16,6)"),
    )


def decimal_scale9(number: Column) -> Column:
    """DECIMAL(38,9) of a decimal or of number text, and an error for more than nine decimals.

    The digits are looked at as text: comparing decimals would round them to a common scale first.
    """
    text = number.cast("string")
    fits = text.rlike(r"^[+-]?\d*(\.\d{0,9}0*)?$") | (number.cast("double") == 0)
    return F.when(number.isNull() | fits, number.cast("decimal(38,9)")).otherwise(
        F.raise_error(F.concat(F.lit("more than 9 decimals: "), text)).cast("decimal(38,9)"))


def freshness_ms(processed: Column, event: Column) -> Column:
    """Milliseconds from event to processing; -1 when there is no event time."""
    return F.coalesce(F.unix_millis(processed) - F.unix_millis(event), F.lit(-1).cast("bigint"))
