"""Batches of bounded size, and shards sized by the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import in_order, paged


def with_batch(df: DataFrame, keys: list[str], seq: str, size: int) -> DataFrame:
    """Number the batches of a key (and window, when it is among the keys) from 0."""
    return paged(df, keys, seq, size, name="batch")


def group_into_batches(df: DataFrame, keys: list[str], value: Column, seq: str, size: int) -> DataFrame:
    """Lists of up to ``size`` values per key in arrival order; the last one of a key may be shorter."""
    narrow = df.select(*keys, F.col(seq).alias("_seq"), value.alias("_value"))
    return with_batch(narrow, keys, "_seq", size).groupBy(*keys, "batch").agg(
        F.count(F.lit(1)).alias("size"), in_order(F.col("_value"), "_seq").alias("values"))


def with_shards(df: DataFrame, window: list[str], spread: Column, rows_per_shard: int) -> DataFrame:
    """Add ``shards`` (window rows / ``rows_per_shard``, at least one) and the row's ``shard``.

    ``spread`` is an evenly distributed non-negative integer.
    """
    sizes = df.groupBy(*window).agg(
        F.greatest(F.lit(1), F.expr(f"count(*) div {rows_per_shard}")).alias("shards"))
    return df.join(sizes, window, "inner").withColumn("shard", F.pmod(spread, F.col("shards")))
