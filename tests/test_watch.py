"""Alerts on silence, progress as a table, queries that stop themselves."""

import random
from functools import partial

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import scratch_path
from millrace.streaming.runtime import run_in_steps
from millrace.streaming.watch import ProgressLog, run_until, silence_alerts
from tests.conftest import rows

START = pd.Timestamp("2021-12-16")
EVENTS = T.StructType().add("series", "string").add("ts", "timestamp")
BASE = int(START.timestamp()) // 60


def at(series, *minutes):
    return [(series, (START + pd.Timedelta(minutes=m)).to_pydatetime()) for m in minutes]


def alerts(spark, deliveries, threshold, periods):
    frames = [spark.createDataFrame(d, EVENTS) for d in deliveries]
    found = run_in_steps(frames, lambda s: silence_alerts(s, "ts", "series", 60, threshold, periods), "alerts")
    return rows(found.select("series", "event", (F.col("first") - BASE).alias("first"), "n"))


def test_a_timer_fires_on_silence_and_rows_resolve_it(spark):
    """The alert is out before the series is busy again, in a run of its own."""
    first = at("s", 0, 1, 2) + at(None, 0) + at("-", 9)
    second = at("s", 10, 20) + at("-", 20)
    assert alerts(spark, [first], 1, 3) == [("s", "FIRING", 5, None), (None, "FIRING", 3, None)]
    assert alerts(spark, [first, second, at("-", 22)], 1, 3) == sorted([
        (None, "FIRING", 3, None), ("s", "FIRING", 5, None), ("s", "RESOLVED", 5, 5), ("-", "FIRING", 12, None), ("-", "RESOLVED", 12, 8),
        ("s", "FIRING", 13, None), ("s", "RESOLVED", 13, 7)], key=repr)


@pytest.mark.parametrize("cuts", [[], [40, 90]])
def test_alerts_do_not_depend_on_deliveries(spark, cuts):
    rng = random.Random(4)
    minutes = sorted((rng.choice("ab"), rng.choice([rng.randint(0, 30), rng.randint(60, 120)])) for _ in range(60))
    edges = [-1, *cuts, 10_000]
    parts = [[e for s, m in minutes if lo < m <= hi for e in at(s, m)] for lo, hi in zip(edges, edges[1:], strict=False)]
    parts[-1] += at("-", 100_000)
    count = pd.Series(minutes).value_counts()
    want = []
    for s in "ab":
        busy = sorted(m for (x, m), n in count.items() if x == s and n >= 2)
        for p, following in zip(busy, [*busy[1:], None], strict=True):
            if following is None or following - p - 1 >= 5:
                want.append((s, "FIRING", p + 5, None))
            if following is not None and following - p - 1 >= 5:
                want.append((s, "RESOLVED", p + 5, following - p - 5))
    assert alerts(spark, parts, 2, 5) == sorted(want, key=repr)


def landing(spark, name, files):
    root = scratch_path(spark, name)
    return spark.readStream.schema("id long").parquet(f"{root}/*"), [
        partial(spark.range(n * 10, n * 10 + 10).coalesce(1).write.parquet, f"{root}/{n}") for n in range(files)]


def test_a_query_stops_after_so_many_rows(spark):
    stream, lands = landing(spark, "total", 3)
    read, progress = run_until(stream, "total", rows=30, meanwhile=lands)
    assert sorted(r.id for r in read.collect()) == list(range(30))
    assert progress.agg(F.sum("input_rows")).first()[0] == 30 and not spark.streams.active


def test_a_query_stops_when_nothing_comes(spark):
    stream, lands = landing(spark, "idle", 2)
    read, progress = run_until(stream.withColumn("twice", F.col("id") * 2), "idle", idle_seconds=2, meanwhile=lands)
    assert read.count() == 20 and progress.where("input_rows > 0").count() == 2
    with pytest.raises(ValueError):
        run_until(stream, "never")


def test_progress_is_kept_as_files(spark):
    stream, lands = landing(spark, "kept", 3)
    for land in lands:
        land()
    with ProgressLog(spark, keep=0) as log:
        seen = stream.observe("seen", F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
        query = seen.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "kept")).trigger(availableNow=True).start()
        query.awaitTermination()
        log.wait(query.runId)
        log.flush(0)
        assert log.rows == [] and log.path
        with pytest.raises(TimeoutError):
            log.wait("nobody", 0.1)
    found = log.table().where("input_rows > 0").collect()
    assert [(r.input_rows, r.metrics["seen.n"], r.metrics["seen.top"], r.late_rows) for r in found] == [(30, "30", "29", 0)]
    assert ProgressLog(spark).table().count() == 0
