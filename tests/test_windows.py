import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import alerts as al
from millrace.operators import windows as wn
from millrace.operators.aggregates import sorted_set
from millrace.plans import QUERIES
from tests.conftest import rows

DAY = dt.datetime(2021, 12, 16)


def log(frame, data):
    """(key, value, event second, tick in ms) as an arrival log."""
    return frame([(k, v, int(s * 1000), int(t)) for k, v, s, t in data], "key string, value bigint, ms bigint, tick bigint").withColumn(
        "ts", F.timestamp_millis(F.lit(1639612800000) + F.col("ms"))).drop("ms")


def panes(df):
    second = (F.unix_millis("window_start") - 1639612800000) / 1000
    return rows(df.select("key", second.cast("int"), "timing", "total"))


def test_windows(frame):
    e = log(frame, [("a", 1, 0, 0), ("a", 2, 1, 0), ("b", 10, 5, 0), ("c", 20, 6, 0), ("a", 30, 7, 0)])
    start = (F.unix_millis("window.start") - 1639612800000) / 1000
    by_window = e.groupBy(F.window("ts", "5 seconds"))
    assert rows(by_window.agg(F.sum("value").alias("s")).select(start, "s")) == [(0.0, 3), (5.0, 60)]
    counts = e.groupBy(F.window("ts", "5 seconds"), "key").agg(F.count("*").alias("n"), F.max("ts").alias("latest"))
    latest = (F.unix_millis("latest") - 1639612800000) / 1000
    assert rows(counts.select("key", start, "n", latest)) == [
        ("a", 0.0, 2, 1.0), ("a", 5.0, 1, 7.0), ("b", 5.0, 1, 5.0), ("c", 5.0, 1, 6.0)]
    default = (F.unix_millis(wn.output_time(F.col("window"))) - 1639612800000).alias("t")
    assert rows(by_window.agg(F.count("*")).select(default)) == [(4999,), (9999,)]


def test_sorted_sets(frame):
    e = log(frame, [("a1", 1, 0, 0), ("a2", 2, 1, 0), ("b1", 10, 5, 0), ("c1", 20, 6, 0), ("a3", 30, 7, 0)])
    assert rows(e.groupBy(F.window("ts", "5 seconds")).agg(sorted_set(F.col("key")).alias("s")).select("s")) == [
        (["a1", "a2"],), (["a3", "b1", "c1"],)]


# arrival steps: the watermark is moved by heartbeat rows of a key of their own
# Arrivals that pin which pane an element belongs to
LATE = [("a", 10, 0, 1), ("a", 20, 1, 2), ("b", 20, 1, 2), ("b", 30, 2, 3), ("-", 0, 3, 4), ("a", 40, 1, 5), ("-", 0, 99, 6)]
ON_TIME = [("a", 0, "ON_TIME", 30), ("b", 0, "ON_TIME", 20), ("b", 2, "ON_TIME", 30)]


@pytest.mark.parametrize("lateness, accumulate, late", [
    ("0 seconds", False, []),
    ("2 seconds", False, [("a", 0, "LATE", 40)]),
    ("2 seconds", True, [("a", 0, "LATE", 70)]),
])
def test_late_panes(frame, lateness, accumulate, late):
    out = wn.late_panes(log(frame, LATE), ["key"], "value", "ts", "tick", "2 seconds", lateness, accumulate)
    assert panes(out.where("key <> '-'")) == sorted(ON_TIME + late, key=repr)


def test_beyond_lateness_is_dropped(frame):
    beyond = [(k, v, 5 if (k, t) == ("-", 4) else s, t) for k, v, s, t in LATE]
    out = wn.late_panes(log(frame, beyond), ["key"], "value", "ts", "tick", "2 seconds", "2 seconds")
    assert panes(out.where("key <> '-'")) == sorted(ON_TIME, key=repr)
    assert rows(wn.dropped_rows(log(frame, beyond), ["key"], "ts", "tick", "2 seconds", "2 seconds").where("timing = 'DROPPED'")) == [
        ("a", "DROPPED", 1)]


def alert_log(frame, data):
    return frame(data, "series string, at string").select("series", F.to_timestamp("at").alias("ts"))


def minutes(found, seconds):
    """The minutes of the hour at which a series is in breach."""
    return sorted(((r.series, r["first"] * seconds // 60 % 60 + i * seconds // 60) for r in found.collect() for i in range(r.n)),
                  key=lambda x: (str(x[0]), x[1]))


def test_series_without_a_name_is_watched(frame):
    df = alert_log(frame, [(None, "2021-12-16 00:00:10"), (None, "2021-12-16 00:07:10"), ("t", "2021-12-16 00:04:00")])
    counts = al.period_counts(df, "ts", "series", 180)
    quiet = al.breaches(counts, al.busy_periods(counts, F.lit(1)), counts.select("series").distinct(), 1)
    assert minutes(quiet, 180) == [(None, 3), ("t", 0), ("t", 6)]


def test_alerts(frame):
    at = [0] * 4 + [3] + [6] * 3 + [20]
    df = alert_log(frame, [("s", f"2021-12-16 00:{m:02d}:10") for m in at] + [("t", "2021-12-16 00:00:30")])
    counts = al.period_counts(df, "ts", "series", 180)
    busy = al.busy_periods(counts, F.lit(3))
    assert minutes(al.breaches(counts, busy, counts.select("series").distinct(), 4), 180) == [("s", 18), ("t", 9), ("t", 12), ("t", 15), ("t", 18)]
    one = frame([("all",)], "series string")
    assert minutes(al.breaches(counts, al.busy_anywhere(busy), one, 4), 180) == [("all", 18)]
    assert al.breaches(counts.limit(0), busy.limit(0), one, 4).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_alerts_equal_a_calendar(frame, seed):
    rng = random.Random(seed)
    data = [(rng.choice("ab"), f"2021-12-16 {rng.randint(0, 3):02d}:{rng.randint(0, 59):02d}:{rng.randint(0, 59):02d}") for _ in range(60)]
    counts = al.period_counts(alert_log(frame, data), "ts", "series", 300)
    have = {(r.series, r.period): r.cnt for r in counts.collect()}
    lo, hi = min(p for _, p in have), max(p for _, p in have)
    want = {(s, p) for s in "ab" for p in range(lo + 2, hi + 1) if all(have.get((s, q), 0) < 2 for q in range(p - 2, p + 1))}
    found = al.breaches(counts, al.busy_periods(counts, F.lit(2)), counts.select("series").distinct(), 3).collect()
    assert {(r.series, r["first"] + i) for r in found for i in range(r.n)} == want


def test_alerts_on_everything_report_when_all_is_well(spark, frame, tmp_path):
    busy = [("s", f"2021-12-16 00:{m:02d}:{s:02d}") for m in range(20) for s in range(0, 60, 10)]
    alert_log(frame, busy).withColumnRenamed("series", "event_type").write.parquet(f"{tmp_path}/events.parquet")
    assert rows(QUERIES["alert_low_volume"](spark, str(tmp_path))) == [("all series", 0, None), ("rate", 0, None)]
