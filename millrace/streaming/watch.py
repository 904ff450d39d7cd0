"""Watching streams: alerts on silence, progress kept as a table, stop conditions."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.session import scratch_path

ALERTS = T.StructType().add("series", "string").add("event", "string").add("first", "long").add("n", "long")


class Silence(StatefulProcessor):
    """Tell when a series has not been busy for ``periods`` periods, and when it is busy again.

    State is the last busy period and whether its alert is out. Every busy period moves the timer; if the watermark reaches
    the timer first, the alert fires without any row. Both events carry the first period in breach, RESOLVED also how many there were.
    """

    def __init__(self, periods: int, period_ms: int):
        self.periods, self.period_ms = periods, period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("busy", "last long, fired boolean")

    def _end(self, last: int) -> int:
        """When the stretch after a busy period is in breach."""
        return (last + self.periods + 1) * self.period_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.state.get()
        last, fired = known if known is not None else (None, False)
        before = last
        for period in sorted({row["period"] for row in rows}):
            quiet = period - last - 1 if last is not None else 0
            if quiet >= self.periods:
                first = last + self.periods
                if not fired:
                    yield Row(*ALERTS.names)(key[0], "FIRING", first, None)
                yield Row(*ALERTS.names)(key[0], "RESOLVED", first, quiet - self.periods + 1)
            if last is None or period > last:
                last, fired = period, False
        if last != before:
            if before is not None:
                self.handle.deleteTimer(self._end(before))
            self.handle.registerTimer(self._end(last))
        self.state.update((last, fired))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, fired = self.state.get()
        if not fired and expiredTimerInfo.getExpiryTimeInMs() == self._end(last):
            self.state.update((last, True))
            yield Row(*ALERTS.names)(key[0], "FIRING", last + self.periods, None)

    def close(self) -> None:
        pass


def silence_alerts(stream: DataFrame, ts: str, series: str, seconds: int, threshold: int, periods: int, lateness: str = "0 seconds") -> DataFrame:
    """``series, event, first, n``: alerts for series with fewer than ``threshold`` rows a period for ``periods`` periods in a row.

    Rows are counted per series and period before the alert's state sees them, so a hot series is combined ahead of the shuffle
    and its state gets one row a period. A series is watched from its first busy period on.
    """
    counts = stream.withWatermark(ts, lateness).groupBy(F.window(ts, f"{seconds} seconds"), F.col(series).alias("series")).agg(F.count(F.lit(1)).alias("n"))
    busy = counts.where(F.col("n") >= threshold).select(
        "series", F.window_time("window").alias("at"), F.expr(f"unix_seconds(window.start) div {seconds}").alias("period"))
    return busy.groupBy("series").transformWithState(
        statefulProcessor=Silence(periods, seconds * 1000), outputStructType=ALERTS, outputMode="Append", timeMode="EventTime")


class ProgressLog(StreamingQueryListener):
    """Progress of all queries of a session while the log is open: one row per micro-batch, kept as files once there are many.

    Observed metrics come as ``name.field -> value``; ``late_rows`` are what stateful operators dropped behind the watermark.
    """

    SCHEMA = T.StructType().add("run_id", "string").add("query", "string").add("batch_id", "long").add("started", "string") \
        .add("input_rows", "long").add("late_rows", "long").add("watermark", "string").add("metrics", T.MapType(T.StringType(), T.StringType()))

    def __init__(self, spark: SparkSession, keep: int = 10_000):
        self.spark, self.keep = spark, keep
        self.rows: list[tuple] = []
        self.path: str | None = None
        self.read: dict[str, tuple[int, float]] = {}   # run -> rows read so far, when the last ones came
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.read[str(event.runId)] = (0, time.monotonic())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        metrics = {f"{name}.{field}": None if value is None else str(value)
                   for name, row in (p.observedMetrics or {}).items() for field, value in row.asDict().items()}
        with self.changed:
            total, since = self.read.get(str(p.runId), (0, time.monotonic()))
            self.read[str(p.runId)] = (total + p.numInputRows, time.monotonic() if p.numInputRows else since)
            self.rows.append((str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows,
                              sum(op.numRowsDroppedByWatermark for op in p.stateOperators), (p.eventTime or {}).get("watermark"), metrics))
            self.changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, run_id, seconds: float = 60) -> None:
        """Until everything about a run has come; events come some time after what they tell."""
        with self.changed:
            if not self.changed.wait_for(lambda: str(run_id) in self.ended, seconds):
                raise TimeoutError(f"no end of run {run_id} within {seconds} s")

    def flush(self, least: int = 0) -> None:
        """Move rows from memory to the shared folder, if there are more than ``least``."""
        with self.changed:
            taken, self.rows = (self.rows, []) if len(self.rows) > least else ([], self.rows)
        if taken:
            self.path = self.path or scratch_path(self.spark, "progress")
            self.spark.createDataFrame(taken, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        self.flush()
        return self.spark.read.schema(self.SCHEMA).parquet(self.path) if self.path else self.spark.createDataFrame([], self.SCHEMA)


def run_until(stream: DataFrame, name: str, rows: int | None = None, idle_seconds: float | None = None, every: str = "0 seconds",
              meanwhile: Iterable[Callable[[], None]] = ()) -> tuple[DataFrame, DataFrame]:
    """Run an endless stream into files until it has read ``rows`` rows or nothing has come for ``idle_seconds``; then it is stopped.

    Returns what was written and the progress of the run. ``meanwhile`` is called step by step while the query runs, each step when
    the one before has been read; the idle time counts after the last one. A micro-batch at work is not idle and is finished.
    """
    if rows is None and idle_seconds is None:
        raise ValueError("give a number of rows or an idle time")
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, f"{name}-progress"))
    with ProgressLog(spark) as log:
        query = writer.trigger(processingTime=every).start()
        run = str(query.runId)
        steps, seen, since = iter(meanwhile), -1, time.monotonic()
        waiting = True
        while query.isActive:
            total, last = log.read.get(run, (0, since))
            if waiting and total > seen:
                seen = total
                step = next(steps, None)
                if step is None:
                    waiting = False
                else:
                    step()
                since = time.monotonic()
            status = query.status
            if status["isTriggerActive"] and status["isDataAvailable"]:
                since = time.monotonic()
            idle = time.monotonic() - max(since, last)
            if rows is not None and total >= rows or idle_seconds is not None and not waiting and idle >= idle_seconds:
                query.stop()
                break
            log.flush(log.keep)
            query.awaitTermination(0.1)
        if query.exception():
            raise query.exception()
        log.wait(run)
    return spark.read.schema(stream.schema).parquet(out), log.table()
