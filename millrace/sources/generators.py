"""Sequences and generated records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Messages per tick in each five-minute span of the load profile.
LOAD_PROFILE = [80, 85, 90, 95, 100, 95, 90, 85, 80, 75, 70, 65, 60, 65, 70]


def parameter_range(spark: SparkSession, parameter: str) -> DataFrame:
    """Numbers of a run-time parameter ``"start,end"``, both ends included."""
    match = re.fullmatch(r"\s*(-?\d+)\s*,\s*(-?\d+)\s*", parameter)
    if match is None:
        raise ValueError(f"expected 'start,end', got {parameter!r}")
    return spark.range(int(match[1]), int(match[2]) + 1)


def weighted_fanout(ticks: DataFrame, number: str, bucket: int, weights: list[int],
                    body: Column | None = None) -> DataFrame:
    """Messages ``<n>_<i>`` for i below the weight of the tick's bucket; past the profile's end there are none."""
    table = F.array(*[F.lit(w) for w in weights])
    text = F.col(number) if body is None else body
    sent = ticks.select(text.cast("string").alias("_n"), F.get(
        table, F.expr(f"cast({number} div {bucket} as int)")).alias("weight")).where(F.col("weight") > 0)
    return sent.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("weight") - 1))).select(
        "weight", F.concat_ws("_", "_n", F.col("i").cast("string")).alias("body"))


def rate_sequence(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """Unbounded sequence at a given rate; its event time is the time of creation."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def rate_steps(spark: SparkSession, rows_per_batch: int, start_ms: int = 0, step_ms: int = 1000) -> DataFrame:
    """The same with a fixed number of rows and a fixed clock step per micro-batch."""
    return (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
            .option("startTimestamp", start_ms).option("advanceMillisPerBatch", step_ms).load())


def generated_records(df: DataFrame, seed: Column, created: Column, text_length: int = 1000) -> DataFrame:
    """Records of id (uuid shape), creation time, number below 100 and a long text.

    Everything is drawn from a hash of the seed column, so a task that is run again
    gives the same records.
    """
    digest = F.md5(seed.cast("string"))
    uuid = F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.substring(digest, 13, 4),
                       F.substring(digest, 17, 4), F.substring(digest, 21, 12))
    return df.select(
        uuid.alias("id"), created.alias("created"),
        (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100).cast("int").alias("number"),
        F.substring(F.repeat(digest, text_length // 32 + 1), 1, text_length).alias("text"))
