"""Streaming queries that act on time itself: triggers, alerts on silence, stop conditions, metrics, a bus."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.temporal import after_first_comma
from millrace.plans.payloads import messages
from millrace.plans.registry import Tables, cents, query, stamp
from millrace.session import scratch_path
from millrace.sources import bus
from millrace.sources.connectors import bus_writer, kafka_batch, kafka_messages, kafka_stream
from millrace.sources.files import csv_line
from millrace.streaming.runtime import heartbeat, run_in_steps, run_on_the_clock, run_to_table, stream_table
from millrace.streaming.state import streaming_panes
from millrace.streaming.watch import ProgressLog, run_until, silence_alerts

# --- triggers --------------------------------------------------------------

# what has come until each of these times is one delivery, the rest is the last one
CUTS = ["2024-01-16 00:45:00", "2024-01-16 03:10:00", "2024-01-16 06:20:00"]
COUNT = 6
DELAY_MS = 300


def _steps_sql() -> str:
    """Per key, window and delivery: rows, sum, latest, and whether the window was closed before and is closed by it."""
    step = " ".join(f"WHEN arrived < TIMESTAMP '{cut}' THEN {n}" for n, cut in enumerate(CUTS))
    return f"""log AS (SELECT event_type AS key, CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) AS value, ts,
        ts + to_minutes((event_id * 7919) % 97) AS arrived, time_bucket(INTERVAL 6 HOUR, ts) AS w FROM events),
      stepped AS (SELECT *, CASE {step} ELSE {len(CUTS)} END AS step FROM log),
      marks AS (SELECT s.step, max(l.ts) FILTER (WHERE l.step < s.step) AS before,
                       CASE WHEN s.step = {len(CUTS)} THEN TIMESTAMP '2999-12-31' ELSE max(l.ts) FILTER (WHERE l.step <= s.step) END AS after
                FROM (SELECT unnest(generate_series(0, {len(CUTS)})) AS step) s, stepped l GROUP BY 1),
      timed AS (SELECT *, before IS NOT NULL AND before >= w + INTERVAL 6 HOUR AS closed, coalesce(after >= w + INTERVAL 6 HOUR, false) AS closing
                FROM stepped JOIN marks USING (step) WHERE before IS NULL OR before < w + INTERVAL 405 MINUTE),
      steps AS (SELECT key, w, step, closed, closing, count(*) AS n, CAST(sum(value) AS BIGINT) AS s, max(ts) AS latest
                FROM timed GROUP BY 1, 2, 3, 4, 5)"""


def _at_once_sql(count: int) -> str:
    """A delay passes before the next delivery, so every delivery is one pane."""
    return f"""WITH {_steps_sql()}
    SELECT key, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, CASE WHEN closed THEN 'LATE' WHEN n >= {count} OR NOT closing THEN 'EARLY' ELSE 'ON_TIME' END AS timing,
           row_number() OVER (PARTITION BY key, w ORDER BY step) - 1 AS pane, s AS total, strftime(latest, '%Y-%m-%d %H:%M:%S') AS latest FROM steps"""


def _count_sql(count: int) -> str:
    """Deliveries are added up until there are enough rows; what is left is fired when the window closes or its lateness ends."""
    return f"""WITH RECURSIVE {_steps_sql()},
      numbered AS (SELECT *, row_number() OVER o AS rn, lead(step) OVER o IS NULL AS last FROM steps WINDOW o AS (PARTITION BY key, w, closed ORDER BY step)),
      fold AS (SELECT key, w, closed, rn, step, last, n, s, latest FROM numbered WHERE rn = 1
        UNION ALL SELECT x.key, x.w, x.closed, x.rn, x.step, x.last, CASE WHEN f.n >= {count} THEN x.n ELSE f.n + x.n END,
          CASE WHEN f.n >= {count} THEN x.s ELSE f.s + x.s END, CASE WHEN f.n >= {count} THEN x.latest ELSE greatest(f.latest, x.latest) END
        FROM fold f JOIN numbered x ON x.key IS NOT DISTINCT FROM f.key AND x.w = f.w AND x.closed = f.closed AND x.rn = f.rn + 1)
    SELECT key, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, CASE WHEN closed THEN 'LATE' WHEN n >= {count} THEN 'EARLY' ELSE 'ON_TIME' END AS timing,
           row_number() OVER (PARTITION BY key, w ORDER BY closed, rn) - 1 AS pane, s AS total, strftime(latest, '%Y-%m-%d %H:%M:%S') AS latest
    FROM fold WHERE n >= {count} OR last"""


def delivery_step():
    """The number of the delivery with which a row arrives."""
    return reduce(lambda otherwise, n: F.when(F.col("arrived") < F.lit(CUTS[n]).cast("timestamp"), n).otherwise(otherwise),
                  reversed(range(len(CUTS))), F.lit(len(CUTS)))


def deliveries(t: Tables) -> list[DataFrame]:
    """Events in the order in which they arrive, 0 to 96 minutes after they happened; the last delivery closes all windows."""
    arrived = F.col("ts") + F.expr("make_interval(0, 0, 0, 0, 0, cast(event_id * 7919 % 97 as int), 0)")
    log = t.events.select(F.col("event_type").alias("key"), cents("value").alias("value"), "ts", arrived.alias("arrived"))
    step = delivery_step()
    parts = [log.where(step == n).drop("arrived") for n in range(len(CUTS) + 1)]
    return [*parts[:-1], parts[-1].unionByName(heartbeat(parts[-1], "ts"))]


def _panes(t: Tables, **trigger) -> DataFrame:
    def flow(stream: DataFrame) -> DataFrame:
        return streaming_panes(stream, ["key"], "value", "ts", "6 hours", 45 * 60 * 1000, **trigger)

    if "delay_ms" in trigger:
        panes = run_on_the_clock(deliveries(t), flow, "clocked", settle_ms=2 * trigger["delay_ms"] + 200)
    else:
        panes = run_in_steps(deliveries(t), flow, "counted")
    start = F.timestamp_millis(F.col("window_end_ms") - 6 * 3_600_000)
    latest = F.timestamp_micros("latest_us")
    return panes.where(F.year(latest) < 2999).select("key", stamp(start).alias("window_start"), "timing", F.col("pane").cast("bigint").alias("pane"),
                                                     "total", stamp(latest).alias("latest"))


@query("trigger_element_count", _count_sql(COUNT))
def trigger_element_count(t: Tables) -> DataFrame:
    """A pane whenever at least so many rows have come; the count is looked at when a micro-batch has been added."""
    return _panes(t, count=COUNT)


@query("trigger_processing_delay", _at_once_sql(10**12))
def trigger_processing_delay(t: Tables) -> DataFrame:
    """A pane some processing time after its first row, fired by a timer next to the watermark."""
    return _panes(t, delay_ms=DELAY_MS)


@query("trigger_after_first", _at_once_sql(COUNT))
def trigger_after_first(t: Tables) -> DataFrame:
    """Whichever comes first, the count or the delay."""
    return _panes(t, count=COUNT, delay_ms=DELAY_MS)


# --- alerts, metrics, stop conditions --------------------------------------

@query("stream_silence_alerts", """
    WITH busy AS (SELECT event_type AS series, epoch_us(ts) // 3600000000 AS period FROM events GROUP BY 1, 2 HAVING count(*) >= 3),
      gaps AS (SELECT series, period, lead(period) OVER (PARTITION BY series ORDER BY period) AS next FROM busy)
    SELECT series, 'FIRING' AS event, period + 4 AS first, CAST(NULL AS BIGINT) AS n FROM gaps WHERE next IS NULL OR next - period - 1 >= 4
    UNION ALL SELECT series, 'RESOLVED', period + 4, next - period - 4 FROM gaps WHERE next - period - 1 >= 4""")
def stream_silence_alerts(t: Tables) -> DataFrame:
    """Fewer than 3 events an hour for 4 hours: a timer per series fires when the watermark passes silence. Over several deliveries,
    so that some alerts fire in one run of the flow and are resolved in a later one."""
    events = t.events.select("event_type", "ts")
    cuts = [F.col("ts") < F.lit(day).cast("timestamp") for day in ("2024-01-11", "2024-01-21")]
    parts = [events.where(cuts[0]), events.where(~cuts[0] & cuts[1]), events.where(~cuts[1])]
    parts[-1] = parts[-1].unionByName(heartbeat(events, "ts"))
    return run_in_steps(parts, lambda stream: silence_alerts(stream, "ts", "event_type", 3600, 3, 4), "alerts")


def _metrics_sql() -> str:
    step = " ".join(f"WHEN arrived < TIMESTAMP '{cut}' THEN {n}" for n, cut in enumerate(CUTS))
    return f"""WITH log AS (SELECT event_id, ts, ts + to_minutes((event_id * 7919) % 97) AS arrived FROM events),
      stepped AS (SELECT *, CASE {step} ELSE {len(CUTS)} END AS step FROM log),
      marks AS (SELECT step, max(max(ts)) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM stepped GROUP BY 1)
    SELECT row_number() OVER (ORDER BY step) AS delivery, count(*) AS input_rows, CAST(sum(event_id) AS VARCHAR) AS id_sum,
           strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest, CAST(count(*) FILTER (WHERE epoch_us(ts) <= (epoch_ms(top) - 600000) * 1000) AS BIGINT) AS late_rows
    FROM stepped JOIN marks USING (step) GROUP BY step"""


@query("stream_metrics", _metrics_sql())
def stream_metrics(t: Tables) -> DataFrame:
    """Metrics observed on a running stream and rows dropped as late, a row per delivery, from the progress of its micro-batches."""
    arrived = F.col("ts") + F.expr("make_interval(0, 0, 0, 0, 0, cast(event_id * 7919 % 97 as int), 0)")
    log = t.events.select("event_id", "ts", arrived.alias("arrived"))

    def flow(stream: DataFrame) -> DataFrame:
        seen = stream.observe("events", F.sum("event_id").alias("id_sum"), stamp(F.max("ts")).alias("latest"))
        return seen.withWatermark("ts", "10 minutes").dropDuplicates(["event_id", "ts"])

    step = delivery_step()
    with ProgressLog(t.spark) as progress:
        run_in_steps([log.where(step == n).drop("arrived") for n in range(len(CUTS) + 1)], flow, "metered", ended=progress.wait)
    batches = progress.table().where("input_rows > 0")
    # some rows per run of the flow: the order of their start numbers them
    number = F.row_number().over(W.orderBy("started")).cast("bigint")
    return batches.select(number.alias("delivery"), "input_rows", F.col("metrics")["events.id_sum"].alias("id_sum"),
                          F.col("metrics")["events.latest"].alias("latest"), "late_rows")


@query("stream_until_idle", """
    SELECT event_type AS key, count(*) AS cnt, min(strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) AS first, max(strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) AS last
    FROM events GROUP BY 1""")
def stream_until_idle(t: Tables) -> DataFrame:
    """Log lines in files that land while the query runs; it stops itself when no more come."""
    root = scratch_path(t.spark, "landing")
    line = csv_line(F.col("event_type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("value")
    third = F.pmod("event_id", F.lit(3))
    lands = [partial(t.events.where(third == n).select(line).write.text, f"{root}/{n}") for n in range(3)]
    lines = t.spark.readStream.text(f"{root}/*")
    parsed = lines.select(F.nullif(F.substring_index("value", ",", 1), F.lit("")).alias("key"), after_first_comma(F.col("value")).alias("at"))
    read, _ = run_until(parsed, "until-idle", idle_seconds=3, meanwhile=lands)
    return read.groupBy("key").agg(F.count("*").alias("cnt"), F.min("at").alias("first"), F.max("at").alias("last"))


# --- bus -------------------------------------------------------------------

def published(t: Tables, partitions: int) -> str:
    """A bus whose topic ``events`` holds the events as messages, written by a stream of files; returns its path."""
    path, source = scratch_path(t.spark, "bus"), scratch_path(t.spark, "bus-source")
    rows = messages(t).withColumn("partition", (F.decode("payload", "UTF-8").cast("long") % partitions).cast("int"))
    files = t.spark.sparkContext.defaultParallelism
    rows.repartition(3 * files).write.parquet(source)
    sent = stream_table(t.spark, source, rows.schema, files_per_step=files)  # three deliveries
    writer = bus_writer(sent, bus.register(t.spark), scratch_path(t.spark, "bus-progress"), path=path, topic="events")
    writer.trigger(availableNow=True).start().awaitTermination()
    return path


@query("stream_bus_read", """
    SELECT CAST(event_id % 4 AS INT) AS partition, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(0 AS BIGINT) AS first_offset,
           count(*) - 1 AS last_offset, count(*) FILTER (WHERE event_id % 10 <> 3) AS with_id, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS latest
    FROM events GROUP BY 1""")
def stream_bus_read(t: Tables) -> DataFrame:
    """Messages published by one stream and consumed by another, with headers, partitions and offsets."""
    options = {"path": published(t, 4), "subscribe": "events", "rowsPerTask": "5000", "group": "readers"}
    read = kafka_stream(t.spark, options, bus.FORMAT)
    message = kafka_messages(read.select("*")).withColumn("partition", F.split("msg_id", "-")[1].cast("int")).withColumn(
        "offset", F.split("msg_id", "-")[2].cast("long"))
    rows = run_to_table(message.select("partition", "offset", F.decode("payload", "UTF-8").cast("long").alias("id"), "attrs"), "bus-read")
    return rows.groupBy("partition").agg(
        F.count("*").alias("cnt"), F.sum("id").alias("id_sum"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count(F.col("attrs")["msgAttrName"]).alias("with_id"), F.max(F.substring(F.col("attrs")["et"], 1, 19)).alias("latest"))


@query("bus_assigned_partitions", """
    SELECT CAST(event_id % 4 AS INT) AS partition, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events WHERE event_id % 4 IN (1, 3) GROUP BY 1""")
def bus_assigned_partitions(t: Tables) -> DataFrame:
    """A bounded read of the partitions named, and of no others."""
    options = {"path": published(t, 4), "assign": '{"events": [1, 3]}'}
    rows = kafka_batch(t.spark, options, fmt=bus.FORMAT)
    return rows.groupBy("partition").agg(F.count("*").alias("cnt"), F.sum(F.decode("value", "UTF-8").cast("long")).alias("id_sum"))
