"""Threshold alerts over windowed counts, without a calendar of silent periods.

A series is quiet in a period when its count is below the threshold; a period without rows counts 0. Only the busy
periods are rows: what lies between two neighbours is one quiet stretch, whose length is the gap in time. An alert that
asks for ``periods`` quiet periods in a row is in breach from the ``periods``-th period of a stretch on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import stored


def period_counts(df: DataFrame, ts: str, series: str, seconds: int) -> DataFrame:
    """``series, period, cnt``: rows per series and period, numbered since the epoch; periods without rows are no rows.

    They are kept, since they give the series, the span and the busy periods.
    """
    period = F.expr(f"unix_micros({ts}) div {seconds * 1_000_000}")
    return stored(df.groupBy(F.col(series).alias("series"), period.alias("period")).agg(F.count(F.lit(1)).alias("cnt")), "counts")


def over_all(counts: DataFrame, name: str = "all") -> DataFrame:
    """One series holding the total of all."""
    return counts.groupBy("period").agg(F.sum("cnt").alias("cnt")).select(F.lit(name).alias("series"), "period", "cnt")


def busy_periods(counts: DataFrame, threshold: Column) -> DataFrame:
    """``series, period`` of the periods that are not below the threshold."""
    return counts.where(F.col("cnt") >= threshold).select("series", "period")


def busy_anywhere(busy: DataFrame) -> DataFrame:
    """Periods in which any series is busy; between them all are quiet at once."""
    return busy.select(F.lit("all").alias("series"), "period").distinct()


def breaches(counts: DataFrame, busy: DataFrame, series: DataFrame, periods: int) -> DataFrame:
    """``series, first, n``: per quiet stretch in breach its first period in breach and how many there are.

    The span watched is that of ``counts``; ``series(series)`` lists who is watched. Each series is put in the order of its busy
    periods, of which there are as many as time has.
    """
    span = counts.agg(F.array(F.min("period") - 1, F.max("period") + 1).alias("ends"))
    ends = series.withColumn("period", F.explode(span.scalar())).where(F.col("period").isNotNull())
    marks = busy.select("series", "period").unionByName(ends.select("series", "period"))
    key = F.struct("series")  # compares NULL series as equal
    following = F.lead("period").over(W.partitionBy(key).orderBy("period"))
    stretches = marks.withColumn("quiet", following - F.col("period") - 1)
    return stretches.where(F.col("quiet") >= periods).select(
        "series", (F.col("period") + periods).alias("first"), (F.col("quiet") - (periods - 1)).alias("n"))
