"""Event-time windows, lateness, triggers and alerts, in batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import alerts as al
from millrace.operators import windows as wn
from millrace.operators.aggregates import sorted_set
from millrace.operators.transforms import union_all
from millrace.plans.registry import Tables, cents, money, query, stamp


@query("window_sum_global", """
    SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1""")
def window_sum_global(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "1 day")).agg(F.sum(money("value")).cast("double").alias("total")).select(
        stamp("window.start").alias("window_start"), "total")


@query("window_count_per_key", """
    SELECT event_type AS key, strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS cnt,
           strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest FROM events GROUP BY 1, 2""")
def window_count_per_key(t: Tables) -> DataFrame:
    """Counts per window, timestamped with the latest element."""
    return t.events.groupBy(F.window("ts", "6 hours"), F.col("event_type").alias("key")).agg(
        F.count("*").alias("cnt"), F.max("ts").alias("latest")).select(
        "key", stamp("window.start").alias("window_start"), "cnt", stamp("latest").alias("latest"))


@query("window_sum_per_key", """
    SELECT event_type AS key, strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
           strftime(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND, '%Y-%m-%d %H:%M:%S') AS output_ts
    FROM events GROUP BY 1, 2, 4""")
def window_sum_per_key(t: Tables) -> DataFrame:
    """Sums per key and one-day window, timestamped with the window's last millisecond."""
    return t.events.groupBy(F.window("ts", "1 day"), F.col("event_type").alias("key")).agg(
        F.sum(money("value")).cast("double").alias("total")).select(
        "key", stamp("window.start").alias("window_start"), "total", stamp(wn.output_time(F.col("window"))).alias("output_ts"))


@query("window_sorted_set", """
    SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM events GROUP BY 1""")
def window_sorted_set(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "6 hours")).agg(sorted_set(F.col("event_type")).alias("types")).select(
        stamp("window.start").alias("window_start"), F.array_join("types", ",").alias("types"))


@query("window_info", """
    SELECT event_id, 'interval' AS type, strftime(time_bucket(INTERVAL 10 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS starts,
           strftime(time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS ends FROM events
    UNION ALL SELECT event_id, 'global', NULL, NULL FROM events""")
def window_info(t: Tables) -> DataFrame:
    """The window of each element by kind: its interval, and the global window, which has no bounds."""
    rows = wn.window_bounds(t.events.select("event_id", "ts"), "ts", "10 seconds")
    interval = F.struct(F.lit("interval").alias("type"), stamp("window_start").alias("starts"), stamp("window_end").alias("ends"))
    whole = F.struct(F.lit("global").alias("type"), F.lit(None).cast("string").alias("starts"), F.lit(None).cast("string").alias("ends"))
    return rows.select("event_id", F.explode(F.array(interval, whole)).alias("w")).select("event_id", "w.*")


# --- lateness --------------------------------------------------------------

def arrivals(t: Tables, minutes_per_tick: int) -> DataFrame:
    """Events as an arrival log: each comes 0 to 96 minutes after it happened."""
    minute = F.expr("unix_micros(ts) div 60000000") + F.pmod(F.col("event_id") * 7919, F.lit(97))
    return t.events.select(F.col("event_type").alias("key"), cents("value").alias("value"), "ts", minute.alias("minute")).select(
        "key", "value", "ts", F.expr(f"minute div {minutes_per_tick}").alias("tick"))


def timed_sql(minutes_per_tick: int, window: str, lateness: str) -> str:
    return f"""log AS (SELECT event_type AS key, CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) AS value, ts,
                   (epoch_us(ts) // 60000000 + (event_id * 7919) % 97) // {minutes_per_tick} AS tick FROM events),
      tops AS (SELECT tick, max(ts) AS top FROM log GROUP BY 1),
      marks AS (SELECT tick, top, max(top) OVER (ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm FROM tops),
      win AS (SELECT *, time_bucket(INTERVAL {window}, ts) AS w FROM log),
      timed AS (SELECT key, value, ts, tick, w, CASE WHEN wm IS NULL OR wm < w + INTERVAL {window} THEN 'ON_TIME'
                  WHEN wm < w + INTERVAL {window} + INTERVAL {lateness} THEN 'LATE' ELSE 'DROPPED' END AS timing
                FROM win JOIN marks USING (tick))"""


def _panes(panes: DataFrame) -> DataFrame:
    return panes.select("key", stamp("window_start").alias("window_start"), "timing", F.col("pane").cast("bigint").alias("pane"), "total")


@query("late_drop", f"""
    WITH {timed_sql(10, "1 HOUR", "0 SECOND")}
    SELECT key, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, timing, CAST(0 AS BIGINT) AS pane, CAST(sum(value) AS BIGINT) AS total
    FROM timed WHERE timing = 'ON_TIME' GROUP BY 1, 2, 3""")
def late_drop(t: Tables) -> DataFrame:
    return _panes(wn.late_panes(arrivals(t, 10), ["key"], "value", "ts", "tick", "1 hour"))


LATE_PANES = f"""WITH {timed_sql(10, "1 HOUR", "30 MINUTE")},
    panes AS (SELECT key, w, timing, CASE WHEN timing = 'LATE' THEN tick END AS bundle, CAST(sum(value) AS BIGINT) AS total
              FROM timed WHERE timing <> 'DROPPED' GROUP BY 1, 2, 3, 4),
    numbered AS (SELECT *, CAST(sum(CASE WHEN timing = 'LATE' THEN 1 ELSE 0 END) OVER o AS BIGINT) AS pane,
                        CAST(sum(total) OVER o AS BIGINT) AS so_far FROM panes
                 WINDOW o AS (PARTITION BY key, w ORDER BY bundle NULLS FIRST ROWS UNBOUNDED PRECEDING))"""


@query("late_pane_discarding", f"{LATE_PANES} SELECT key, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, timing, pane, total FROM numbered")
def late_pane_discarding(t: Tables) -> DataFrame:
    return _panes(wn.late_panes(arrivals(t, 10), ["key"], "value", "ts", "tick", "1 hour", "30 minutes"))


@query("late_pane_accumulating", f"{LATE_PANES} SELECT key, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, timing, pane, so_far AS total FROM numbered")
def late_pane_accumulating(t: Tables) -> DataFrame:
    return _panes(wn.late_panes(arrivals(t, 10), ["key"], "value", "ts", "tick", "1 hour", "30 minutes", accumulate=True))


@query("late_drop_beyond", f"""
    WITH {timed_sql(10, "1 HOUR", "30 MINUTE")} SELECT key, timing, count(*) AS rows FROM timed GROUP BY 1, 2""")
def late_drop_beyond(t: Tables) -> DataFrame:
    """How many elements were on time, late and too late."""
    return wn.dropped_rows(arrivals(t, 10), ["key"], "ts", "tick", "1 hour", "30 minutes")


# --- alerts ----------------------------------------------------------------

def _dense_sql(minutes: int, series: str) -> str:
    return f"""(SELECT s.series, c.w, coalesce(n.cnt, 0) AS cnt
      FROM (SELECT DISTINCT {series} AS series FROM events) s CROSS JOIN
           (SELECT unnest(generate_series(min(w), max(w), INTERVAL {minutes} MINUTE)) AS w
            FROM (SELECT time_bucket(INTERVAL {minutes} MINUTE, ts) AS w FROM events)) c
      LEFT JOIN (SELECT {series} AS series, time_bucket(INTERVAL {minutes} MINUTE, ts) AS w, count(*) AS cnt FROM events GROUP BY 1, 2) n
        ON n.series IS NOT DISTINCT FROM s.series AND n.w = c.w)"""


def _breach_sql(minutes: int, series: str, periods: int, limit: str) -> str:
    return f"""(SELECT *, count(*) OVER o = {periods} AND max(cnt) OVER o < {limit} AS breach FROM {_dense_sql(minutes, series)}
                WINDOW o AS (PARTITION BY series ORDER BY w ROWS BETWEEN {periods - 1} PRECEDING AND CURRENT ROW))"""


@query("alert_low_volume", f"""
    SELECT 'series ' || series AS alert, count(*) AS windows, strftime(min(w), '%Y-%m-%d %H:%M:%S') AS first_window
    FROM {_breach_sql(3, "event_type", 5, "3")} WHERE breach GROUP BY 1
    UNION ALL
    SELECT 'all series', count(*), strftime(min(w), '%Y-%m-%d %H:%M:%S') FROM (
      SELECT w FROM {_breach_sql(3, "event_type", 5, "3")} GROUP BY 1 HAVING bool_and(breach))
    UNION ALL
    SELECT 'rate', count(*), strftime(min(w), '%Y-%m-%d %H:%M:%S') FROM {_breach_sql(1, "'all'", 3, "6")} WHERE breach""")
def alert_low_volume(t: Tables) -> DataFrame:
    """Fewer than 3 per 3 minutes for 15 minutes, per series and in all; a total rate below 0.1/s for 3 minutes.

    The alerts on everything report in any case, with 0 windows when all was well; of the series those in breach do.
    """
    def summary(found: DataFrame, name, seconds: int, *per: str) -> DataFrame:
        first = F.timestamp_seconds(F.min("first") * seconds)
        rows = found.groupBy(*per).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("windows"), stamp(first).alias("first_window"))
        return rows.select(name.alias("alert"), "windows", "first_window")

    counts = al.period_counts(t.events, "ts", "event_type", 180)
    busy = al.busy_periods(counts, F.lit(3))
    total = al.over_all(al.period_counts(t.events, "ts", "event_type", 60))
    everything = t.spark.createDataFrame([("all",)], "series string")
    return union_all([
        summary(al.breaches(counts, busy, counts.select("series").distinct(), 5), F.concat(F.lit("series "), F.col("series")), 180, "series"),
        summary(al.breaches(counts, al.busy_anywhere(busy), everything, 5), F.lit("all series"), 180),
        summary(al.breaches(total, al.busy_periods(total, F.lit(0.1 * 60)), everything, 3), F.lit("rate"), 60)])
