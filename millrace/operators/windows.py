"""Tumbling event-time windows, and lateness replayed from an arrival log.

An arrival log holds, next to key, value and event time, the integer ``tick`` a row
arrived at. A tick is what one delivered bundle (or micro-batch) is to a runner: the
watermark a row meets is the largest event time of strictly earlier ticks. Ticks are units of processing time, so their
number depends on the time covered and not on the number of rows; rows are combined
per key, window and tick before anything is put in order.

The log is read twice: once for the (stored) table of ticks, once for the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.ranking import running_max
from millrace.session import stored

TICK_BLOCK = 10_000


def window_bounds(df: DataFrame, ts: str, duration: str) -> DataFrame:
    """Add ``window_start`` and ``window_end`` of the tumbling window a row falls into."""
    return df.withColumn("_w", F.window(ts, duration)).select(
        *df.columns, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"))


def output_time(window: Column) -> Column:
    """Default event time of a window's result: its last millisecond."""
    return window["end"] - F.expr("INTERVAL 1 MILLISECOND")


def tick_table(log: DataFrame, ts: str, tick: str, duration: str) -> DataFrame:
    """``_tick, _end, _top``: largest event time per tick and window end, stored."""
    ends = log.groupBy(F.col(tick).alias("_tick"), F.window(ts, duration)["end"].alias("_end"))
    return stored(ends.agg(F.max(ts).alias("_top")), "ticks")


def _watermarks(ticks: DataFrame) -> DataFrame:
    """``_tick, _top, _watermark``: the watermark is what the ticks before have seen."""
    tops = ticks.groupBy("_tick").agg(F.max("_top").alias("_top"))
    return running_max(tops, "_tick", "_top", "_watermark", TICK_BLOCK)


def with_timing(log: DataFrame, ts: str, tick: str, duration: str, lateness: str,
                ticks: DataFrame | None = None) -> DataFrame:
    """Add the window and ``timing``: ON_TIME, LATE (within the allowed lateness) or DROPPED."""
    ticks = tick_table(log, ts, tick, duration) if ticks is None else ticks
    marks = _watermarks(ticks).select("_tick", "_watermark")
    rows = window_bounds(log, ts, duration).join(marks, F.col(tick) == F.col("_tick"), "inner")
    timing = (
        F.when(F.col("_watermark").isNull() | (F.col("_watermark") < F.col("window_end")), "ON_TIME")
        .when(F.col("_watermark") < F.col("window_end") + F.expr(f"INTERVAL {lateness}"), "LATE")
        .otherwise("DROPPED"))
    return rows.withColumn("timing", timing).drop("_tick", "_watermark")


def late_panes(log: DataFrame, keys: list[str], value: str, ts: str, tick: str, duration: str,
               lateness: str = "0 seconds", accumulate: bool = False) -> DataFrame:
    """Sums per key, window and pane under the default trigger.

    Pane 0 is fired when the watermark passes the window's end; each later tick with rows
    within the allowed lateness fires one more, holding its own rows (discarding) or
    everything so far (accumulating). Rows beyond the lateness are dropped.
    """
    timed = with_timing(log, ts, tick, duration, lateness).where(F.col("timing") != "DROPPED")
    bundle = F.when(F.col("timing") == "LATE", F.col(tick))
    panes = timed.groupBy(*keys, "window_start", "window_end", "timing", bundle.alias("_bundle")).agg(
        F.sum(value).alias("total"))
    of_window = W.partitionBy(*keys, "window_start").orderBy(F.col("_bundle").asc_nulls_first())
    total = F.sum("total").over(of_window.rowsBetween(W.unboundedPreceding, 0)) if accumulate else F.col("total")
    late_number = F.sum(F.when(F.col("timing") == "LATE", 1).otherwise(0)).over(
        of_window.rowsBetween(W.unboundedPreceding, 0))
    return panes.select(*keys, "window_start", "window_end", "timing",
                        late_number.alias("pane"), total.alias("total"))


def dropped_rows(log: DataFrame, keys: list[str], ts: str, tick: str, duration: str, lateness: str) -> DataFrame:
    """How many rows per key and timing, dropped ones included."""
    timed = with_timing(log, ts, tick, duration, lateness)
    return timed.groupBy(*keys, "timing").agg(F.count(F.lit(1)).alias("rows"))
