"""Streaming cases: one parquet file is one arrival step; rows with key ``-`` only move the watermark."""

import os
import time

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans import QUERIES, streams
from millrace.session import scratch_path
from millrace.sources.generators import rate_sequence
from millrace.streaming import flows
from millrace.streaming import state as st
from millrace.streaming.runtime import (
    closing_heartbeat, draw_some_batches, run_each_batch, run_on_the_clock, run_some_batches, run_to_table, stream_table,
)
from tests.conftest import rows

START = pd.Timestamp("2021-12-16")
SCHEMA = T.StructType().add("key", "string").add("value", "long").add("ts", "timestamp")


class Steps:
    """Folder of arrival steps, read in the order they were written."""

    def __init__(self, folder):
        self.folder, self.count = folder, 0

    def add(self, *elements):
        df = pd.DataFrame([(k, v, START + pd.Timedelta(seconds=s)) for k, v, s in elements], columns=["key", "value", "ts"])
        df["ts"] = df["ts"].astype("datetime64[us]").dt.tz_localize("UTC")
        hidden = f"{self.folder}/.{self.count:03d}.parquet"
        df.to_parquet(hidden, index=False)
        os.utime(hidden, (1_700_000_000 + self.count,) * 2)
        os.rename(hidden, f"{self.folder}/{self.count:03d}.parquet")
        self.count += 1
        return self

    def stream(self, spark):
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(self.folder))


@pytest.fixture
def steps(tmp_path):
    return Steps(tmp_path)


def shown(df):
    start = (F.col("window_end_ms") - 1639612800000) / 1000
    return rows(df.where("key <> '-'").select("key", start.cast("int").alias("end"), "timing", "total"))


# The panes of these arrivals
ON_TIME = [("a", 2, "ON_TIME", 30), ("b", 2, "ON_TIME", 20), ("b", 4, "ON_TIME", 30)]


@pytest.mark.parametrize("lateness, accumulate, late", [
    (0, False, []), (2000, False, [("a", 2, "LATE", 40)]), (2000, True, [("a", 2, "LATE", 70)])])
def test_late_panes(spark, steps, lateness, accumulate, late):
    steps.add(("a", 10, 0)).add(("a", 20, 1), ("b", 20, 1)).add(("b", 30, 2)).add(("-", 0, 3)).add(("a", 40, 1)).add(("-", 0, 99))
    panes = st.streaming_panes(steps.stream(spark), ["key"], "value", "ts", "2 seconds", lateness, accumulate)
    assert shown(run_to_table(panes, "panes")) == sorted(ON_TIME + late, key=repr)


def test_beyond_lateness_is_dropped_after_one_heartbeat(spark, steps):
    steps.add(("a", 10, 0)).add(("a", 20, 1), ("b", 20, 1)).add(("b", 30, 2)).add(("-", 0, 5)).add(("a", 40, 1)).add(("-", 0, 99))
    panes = st.streaming_panes(steps.stream(spark), ["key"], "value", "ts", "2 seconds", 2000)
    assert shown(run_to_table(panes, "panes")) == sorted(ON_TIME, key=repr)


def test_count_trigger(spark, steps):
    steps.add(("a", 1, 0), ("a", 2, .001))
    for value, second in ((4, .5), (8, 1), (9, 1.1), (10, 2.1), (100, 3.1), (1000, 4.1), (10000, 4.6)):
        steps.add(("a", value, second))
    steps.add(("-", 0, 99))
    panes = run_to_table(st.streaming_panes(steps.stream(spark), ["key"], "value", "ts", "5 seconds", count=2), "panes")
    found = [(r["timing"], r["total"]) for r in panes.where("key = 'a'").orderBy("pane").collect()]
    assert found == [("EARLY", 3), ("EARLY", 12), ("EARLY", 19), ("EARLY", 1100), ("ON_TIME", 10000)]


def deliveries(spark, *steps):
    return [spark.createDataFrame([(k, v, (START + pd.Timedelta(seconds=s)).to_pydatetime()) for k, v, s in step], SCHEMA) for step in steps]


@pytest.mark.parametrize("trigger, first, rest", [
    (dict(delay_ms=200), [("EARLY", 3)], [("EARLY", 15), ("ON_TIME", 1100), ("LATE", 7)]),
    (dict(delay_ms=200, count=2), [("EARLY", 3)], [("EARLY", 15), ("EARLY", 1100), ("LATE", 7)]),
    # a delay that never passes leaves the count and the watermark
    (dict(delay_ms=3_600_000, count=3), [], [("EARLY", 18), ("ON_TIME", 1100)])])
def test_deliveries_on_the_clock(spark, trigger, first, rest):
    """Each delivery's panes are fired by the clock before the next one comes; the last one closes everything."""
    parts = deliveries(spark, [("a", 1, 0), ("a", 2, .001)], [("a", 15, .5)], [], [("a", 100, 2), ("a", 1000, 3), ("-", 0, 6)],
                       [("a", 7, 1), ("-", 0, 7)], [("a", 9, 1), ("-", 0, 99)])

    def flow(stream):
        return st.streaming_panes(stream, ["key"], "value", "ts", "5 seconds", 2000, **trigger)

    panes = run_on_the_clock(parts, flow, "panes", settle_ms=900)
    found = [(r["timing"], r["total"]) for r in panes.where("key = 'a'").orderBy("pane").collect()]
    if trigger["delay_ms"] > 1_000_000:  # its processing timers are asleep: only rows wake a window
        found = found[:2]
    assert found == first + rest


def test_no_deliveries_at_all(spark):
    out = run_on_the_clock(deliveries(spark, []), lambda stream: st.streaming_panes(stream, ["key"], "value", "ts", "5 seconds", delay_ms=10), "none", 10)
    assert out.count() == 0


def test_processing_delay_trigger(spark, steps):
    """Fires by the clock, without new input, and flushes the rest on time."""
    steps.add(("a", 1, 0), ("a", 2, .001))
    panes = st.streaming_panes(steps.stream(spark), ["key"], "value", "ts", "5 seconds", delay_ms=6000)
    out = scratch_path(spark, "clocked")
    query = (panes.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "clocked-progress"))
             .trigger(processingTime="200 milliseconds").start())
    schema = panes.schema

    def wait_for(timing, total):
        deadline = time.monotonic() + 90
        while time.monotonic() < deadline:
            found = [(r["timing"], r["total"]) for r in spark.read.schema(schema).parquet(out).where("key = 'a'").orderBy("pane").collect()] \
                if os.path.isdir(out) else []
            if (timing, total) in found:
                return found
            assert query.exception() is None
            time.sleep(.3)
        raise AssertionError(f"no {timing} pane of {total}")

    try:
        steps.add(("a", 10, 1))
        assert wait_for("EARLY", 13) == [("EARLY", 13)]
        steps.add(("a", 100, 2)).add(("-", 0, 99)).add(("-", 0, 99))
        assert wait_for("ON_TIME", 100) == [("EARLY", 13), ("ON_TIME", 100)]
    finally:
        query.stop()


def batch_rows(key, values, why):
    yield key[0], key[-1], list(values), why


BATCHES = (T.StructType().add("key", "string").add("window_end_ms", "long").add("values", T.ArrayType(T.LongType())).add("why", "string"))


def test_pairs_with_timer(spark, steps):
    steps.add(("a", 10, 0)).add(("a", 20, 1)).add(("a", 30, 1)).add(("a", 40, 2)).add(("a", 50, 3)).add(("-", 0, 99))
    windows = st.keyed_windows(steps.stream(spark), "ts", "2 seconds")
    out = run_to_table(st.stateful_batches(windows, ["key"], "value", 2, batch_rows, BATCHES), "pairs").where("key = 'a'")
    assert rows(out.select("values", "why")) == [([10, 20], "FULL"), ([30], "REST"), ([40, 50], "FULL")]


def test_buffer_is_kept_between_micro_batches(spark, steps):
    for i in range(7):
        steps.add(("a", i, 0))
    steps.add(("-", 0, 99))
    windows = st.keyed_windows(steps.stream(spark), "ts", "2 seconds")
    out = run_to_table(st.stateful_batches(windows, ["key"], "value", 3, batch_rows, BATCHES), "threes").where("key = 'a'")
    assert rows(out.select("values", "why")) == [([0, 1, 2], "FULL"), ([3, 4, 5], "FULL"), ([6], "REST")]


def test_dedup_by_attribute(spark, tmp_path):
    sent = spark.range(600).select(
        F.encode(F.col("id").cast("string"), "UTF-8").alias("payload"),
        F.create_map(F.lit("msgAttrName"), F.concat(F.lit("m"), F.expr("id div 2").cast("string")),
                     F.lit("et"), F.lit("2021-12-16T00:00:00Z")).alias("attrs"), F.col("id").cast("string").alias("msg_id"))
    sent.write.parquet(str(tmp_path / "bus"))
    stream = flows.with_event_time(spark.readStream.schema(sent.schema).parquet(str(tmp_path / "bus")), "et")
    once = run_to_table(flows.deduplicated(stream, "msgAttrName", "event_ts", "10 minutes"), "once")
    assert once.count() == 300
    assert once.select(F.col("attrs")["msgAttrName"]).distinct().count() == 300


def test_repeated_batch_replaces_its_first_try(spark, tmp_path):
    write = flows.append_batches(str(tmp_path / "t"))
    write(spark.range(3).toDF("n"), 0)
    write(spark.range(3).toDF("n"), 0)
    write(spark.range(5).toDF("n"), 1)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 8


def test_table_stream_reads_files_and_folders(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "folder.parquet"))
    spark.range(10).repartition(3).write.mode("append").parquet(str(tmp_path / "folder.parquet"))
    schema = T.StructType().add("id", "long")
    stream = stream_table(spark, str(tmp_path / "folder.parquet"), schema, files_per_step=2)
    assert run_to_table(stream, "copied").count() == 20


def test_heartbeat_closes_windows(spark, steps):
    steps.add(("a", 1, 0), ("a", 2, 61))
    for salt in (None, F.pmod("value", F.lit(3))):
        stream, close = closing_heartbeat(spark.readStream.schema(SCHEMA).parquet(str(steps.folder)), "ts")
        sums = flows.windowed_sums(stream, "ts", ["key"], F.col("value"), "1 minute", salt=salt)
        assert rows(run_to_table(sums.select("key", "total"), "sums", close=close)) == [("a", 1), ("a", 2)]


def hourly(steps):
    """Four files of one hour each, in the order of time."""
    for hour in range(4):
        steps.add(*[(k, hour * 100 + i, hour * 3600 + i) for i in range(6) for k in ("a", "b")])
    return steps


def replayed(spark, steps, flow, one_batch):
    reader = spark.readStream.schema(SCHEMA)
    if not one_batch:
        reader = reader.option("maxFilesPerTrigger", 1)
    stream, close = closing_heartbeat(reader.parquet(str(steps.folder)), "ts")
    return rows(run_to_table(flow(stream), "replay", close=close))


FLOWS = {
    "lists": lambda s: flows.windowed_lists(s, "ts", ["key"], F.col("value"), "value", "1 hour", 4).drop("window_start"),
    "sums": lambda s: flows.windowed_sums(s, "ts", ["key"], F.col("value"), "1 hour").select("key", "total"),
    "salted sums": lambda s: flows.windowed_sums(s, "ts", ["key"], F.col("value"), "1 hour", salt=F.pmod("value", F.lit(3))).select("key", "total"),
    "batches": lambda s: st.stateful_batches(st.keyed_windows(s.where("key is not null or value is null"), "ts", "1 hour"), ["key"], "value", 4,
                                             batch_rows, BATCHES, order=lambda v: v or 0).where("key is not null"),
}


@pytest.mark.parametrize("name", list(FLOWS))
def test_replays_close_after_several_micro_batches(spark, steps, name):
    hourly(steps)
    several = replayed(spark, steps, FLOWS[name], one_batch=False)
    assert several == replayed(spark, steps, FLOWS[name], one_batch=True) and len(several) >= 8


def test_late_rows_never_reach_a_closed_buffer(spark, steps):
    steps.add(("a", 1, 0)).add(("-", 0, 99)).add(("a", 2, 1)).add(("-", 0, 199))
    windows = st.keyed_windows(steps.stream(spark), "ts", "2 seconds")
    out = run_to_table(st.stateful_batches(windows, ["key"], "value", 2, batch_rows, BATCHES), "late").where("key = 'a'")
    assert rows(out.select("values", "why")) == [([1], "REST")]


def test_struct_values_are_kept_whole(spark, steps):
    steps.add(("a|b", 1, 0), ("a|b", 2, 0)).add(("a|b", 3, 1)).add(("-", 0, 99))
    asking = st.keyed_windows(steps.stream(spark), "ts", "2 seconds").withColumn("v", F.struct("key", "value"))
    out = T.StructType().add("names", T.ArrayType(T.StringType())).add("n", "long")
    act = lambda key, values, why: iter([([v["key"] for v in values], sum(v["value"] for v in values))])
    got = run_to_table(st.stateful_batches(asking, ["key"], "v", 2, act, out), "structs")
    assert sorted(r.n for r in got.where("array_contains(names, 'a|b')").collect()) == [3, 3]


class CountedRows(st.BatchBuffer):
    def handleInputRows(self, key, rows, timerValues):
        taken = list(rows)
        for out in super().handleInputRows(key, taken, timerValues):
            yield type(out)(**{**out.asDict(), "why": f"{out.why} {len(taken)}"})


def test_values_reach_the_state_in_lists(spark, steps, monkeypatch):
    steps.add(*[("ab"[i % 2], i, 0) for i in range(3000)]).add(("-", 0, 99))
    monkeypatch.setattr(st, "BatchBuffer", CountedRows)
    windows = st.keyed_windows(steps.stream(spark), "ts", "2 seconds")
    out = run_to_table(st.stateful_batches(windows, ["key"], "value", 500, batch_rows, BATCHES), "lists").where("key <> '-'").collect()
    assert sorted(v for r in out for v in r["values"]) == list(range(3000)) and len(out) == 6
    assert all(int(r.why.split()[1]) <= 16 for r in out)


@pytest.mark.parametrize("nested", [False, True])
def test_lists_hold_every_value_once_and_in_order(nested):
    def keys(i):
        a = None if i % 5 == 0 else f"k{i % 3}"
        return ([a], i % 2) if nested else (a, i % 2)

    given = [(*keys(i), None if i % 7 == 0 else "x" * (30_000 if i % 211 == 0 else 3) + str(i)) for i in range(20_000)]
    kinds = pa.schema([("a", pa.list_(pa.string()) if nested else pa.string()), ("b", pa.int64()), ("values", pa.string())])
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*given, strict=True), kinds, strict=True)], schema=kinds)
    out = [r for b in st.listed(iter(table.to_batches(1000))) for r in b.to_pylist()]
    expected, got = {}, {}
    for a, b, v in given:
        expected.setdefault((str(a), b), []).append(v)
    for r in out:
        got.setdefault((str(r["a"]), r["b"]), []).extend(r["values"])
        assert len(r["values"]) == 1 or len(r["values"]) <= st.LIST_ROWS and sum(len(v or "") for v in r["values"]) <= st.LIST_BYTES
    assert got == expected and (nested or len(out) < 400)
    assert not list(st.listed(iter(table.slice(0, 0).to_batches()))) and not list(st.listed(iter([])))


def test_messages_without_the_attribute_are_no_copies(spark, tmp_path):
    sent = [("x", {"id": "1"}, "m1"), ("x", {"id": "1"}, "m2"), ("y", {"id": ""}, "m3"), ("y", {}, "m4"), ("y", None, "m5"), ("y", {}, "m5"),
            ("z", {"id": "m4"}, "m6"), ("w", {}, None), ("w", {}, None)]
    df = spark.createDataFrame([(*m, START.to_pydatetime()) for m in sent], "payload string, attrs map<string,string>, msg_id string, ts timestamp")
    df.write.parquet(str(tmp_path / "bus"))
    once = flows.deduplicated(spark.readStream.schema(df.schema).parquet(str(tmp_path / "bus")), "id", "ts", "1 hour")
    assert sorted(r.payload for r in run_to_table(once, "once").collect()) == ["w", "w", "x", "y", "y", "y", "z"]


def test_periodic_load_returns_its_query(spark, steps):
    steps.add(("a", 1, 0))
    root = scratch_path(spark, "periodic")
    query = run_each_batch(steps.stream(spark), "periodic", flows.append_batches(root), every="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(root).count() == 1


def test_rate_source(spark):
    stream = rate_sequence(spark, 50)
    assert [f.name for f in stream.schema.fields] == ["timestamp", "value"]
    out = run_some_batches(stream, "rate", 3)
    seen = sorted(r["value"] for r in out.collect())
    assert seen == list(range(len(seen)))


def test_batch_loader(spark, steps):
    steps.add(("a", 1, 0)).add(("b", 2, 0))
    root = scratch_path(spark, "loads")
    run_each_batch(steps.stream(spark), "loads", flows.append_batches(root))
    assert rows(spark.read.parquet(root).select("key", "batch")) == [("a", 0), ("b", 1)]


def test_drawing_reads_its_own_step_only(spark, tmp_path, monkeypatch):
    spark.range(35).selectExpr("id AS event_id", "IF(id % 2 = 0, 'a', 'b') AS event_type").where("event_id NOT BETWEEN 10 AND 19").write.parquet(
        f"{tmp_path}/events.parquet")
    plans = []

    def watched(stream, draw, *args):
        def look(ticks):
            drawn = draw(ticks)
            plans.append(drawn._jdf.queryExecution().executedPlan().toString())
            return drawn
        return draw_some_batches(stream, look, *args)

    monkeypatch.setattr(streams, "RATE", 10)
    monkeypatch.setattr(streams, "draw_some_batches", watched)
    assert rows(QUERIES["stream_rate_agg"](spark, str(tmp_path))) == [("a", 13, sum(range(0, 10, 2)) + sum(range(20, 35, 2))), (
        "b", 12, sum(range(1, 10, 2)) + sum(range(21, 35, 2)))]
    assert len(plans) >= 4 and "(step" in plans[2].split("PartitionFilters: [")[1].split("]")[0] and "<= 2)" in plans[2]
