"""End-to-end streaming flows put together from the parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.messages import attribute_time, message_text
from millrace.functions.temporal import date_parts, freshness_ms


def deduplicated(messages: DataFrame, id_attribute: str, ts: str, within: str) -> DataFrame:
    """Drop repeated messages by an id attribute; ids are remembered for ``within`` of event time.

    A message without the attribute (or with an empty one) goes by its own ``msg_id``, which is never taken for an attribute's
    value; one without either has no copies.

    Copies that meet in one Arrow batch are dropped before the shuffle, so that an id sent
    over and over does not send all its copies to one state store.
    """
    given = F.nullif(F.try_element_at("attrs", F.lit(id_attribute)), F.lit(""))
    own = F.nullif(F.col("msg_id"), F.lit(""))
    tagged = messages.withColumn("_id", F.coalesce(
        F.concat(F.lit("attribute "), given), F.concat(F.lit("message "), own), F.concat(F.lit("row "), F.expr("uuid()"))))
    thinned = tagged.mapInArrow(first_of_each_id, tagged.schema).withWatermark(ts, within)
    return thinned.dropDuplicatesWithinWatermark(["_id"]).drop("_id")


def first_of_each_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("_id"))
        codes = ids.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        first = np.sort(np.unique(codes, return_index=True)[1])
        yield batch if len(first) == len(codes) else batch.take(pa.array(first))


def with_event_time(messages: DataFrame, attribute: str, name: str = "event_ts") -> DataFrame:
    """Event time from an attribute."""
    return messages.withColumn(name, attribute_time(F.col("attrs"), attribute))


def message_records(messages: DataFrame, ts: str, processed: Column, window: str, dated: str = "hour") -> DataFrame:
    """One text column per message, next to its window and its date path columns (year down to ``dated``)."""
    publish, event = attribute_time(F.col("attrs"), "pt"), attribute_time(F.col("attrs"), "et")
    text = message_text(
        F.col("payload"), F.col("attrs"), F.col("msg_id"),
        dataFreshnessMs=freshness_ms(processed, F.col(ts)),
        customPublishTimeDataFreshnessMs=freshness_ms(processed, publish),
        customEventTimeDataFreshnessMs=freshness_ms(processed, event))
    return messages.select(
        text.alias("value"), F.date_format(F.window(F.col(ts), window)["start"], "yyyy-MM-dd_HH-mm-ss").alias("win_start"),
        *[c.alias(n) for n, c in date_parts(F.col(ts), dated).items()])


def write_three_ways(root: str):
    """Batch writer: table load, dated files and windowed files, each safe to repeat for a batch id."""

    def write(rows: DataFrame, batch_id: int) -> None:
        # the first sink is written once and feeds the other two; nothing needs to stay cached
        loaded = f"{root}/table/batch={batch_id}"
        rows.write.mode("overwrite").parquet(loaded)
        stored = rows.sparkSession.read.parquet(loaded)
        dated = [c for c in stored.columns if c not in ("value", "win_start")]
        stored.drop("win_start").hint("rebalance", *dated).write.mode("overwrite").partitionBy(*dated).parquet(
            f"{root}/dated/batch={batch_id}")
        stored.select("value", "win_start").hint("rebalance", "win_start").write.mode("overwrite").partitionBy(
            "win_start").parquet(f"{root}/windowed/batch={batch_id}")

    return write


def append_batches(root: str):
    """Batch writer that appends to one table; a repeated batch replaces its own earlier try."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return write


def windowed_sums(stream: DataFrame, ts: str, keys: list[str], value: Column, window: str,
                  lateness: str = "0 seconds", salt: Column | None = None) -> DataFrame:
    """Sum per window and key; with a salt a hot key is first summed in several state stores."""
    marked = stream.withWatermark(ts, lateness)
    if salt is None:
        sums = marked.groupBy(F.window(ts, window), *keys).agg(F.sum(value).alias("total"))
    else:
        parts = marked.groupBy(F.window(ts, window).alias("w"), *keys, salt.alias("_salt")).agg(
            F.sum(value).alias("part"))
        sums = parts.groupBy(F.window(F.window_time("w"), window), *keys).agg(F.sum("part").alias("total"))
    return sums.select(F.col("window.start").alias("window_start"), *keys, "total")


def windowed_lists(stream: DataFrame, ts: str, keys: list[str], value: Column, seq: str, window: str,
                   span: int, lateness: str = "0 seconds") -> DataFrame:
    """Values per window and key as lists, one for every ``span`` numbers of the unique ``seq``.

    A list is bounded by ``span`` however many rows a key has in a window.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), value.alias("v"))))
    lists = stream.withWatermark(ts, lateness).groupBy(
        F.window(ts, window), *keys, F.expr(f"{seq} div {span}").alias("block")).agg(pairs.alias("p"))
    return lists.select(F.col("window.start").alias("window_start"), *keys, "block",
                        F.transform("p", lambda p: p["v"]).alias("values"))
