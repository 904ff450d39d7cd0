"""Message-bus records: ``payload BINARY, attrs MAP<STRING,STRING>, msg_id STRING``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "payload BINARY, attrs MAP<STRING,STRING>, msg_id STRING"


def sorted_attributes(attrs: Column) -> Column:
    """``{a=1, b=2}`` with the names in order."""
    entries = F.transform(F.array_sort(F.map_entries(attrs)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


def attribute_time(attrs: Column, name: str) -> Column:
    """Instant held by an attribute; NULL when the attribute is missing."""
    return F.to_timestamp(F.try_element_at(attrs, F.lit(name)))


def message_text(payload: Column, attrs: Column, msg_id: Column, **freshness: Column) -> Column:
    """Body, attributes, id and freshness figures in one text column."""
    parts = [F.lit("body="), F.decode(payload, "UTF-8"), F.lit(", attrs="), sorted_attributes(attrs),
             F.lit(", msgId="), msg_id]
    for name, value in freshness.items():
        parts += [F.lit(f", {name}="), value.cast("string")]
    return F.concat(*parts)
