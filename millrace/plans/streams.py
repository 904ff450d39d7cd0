"""Streaming queries: the tables read as streams and run to their end."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import payload as pl
from millrace.functions.temporal import after_first_comma, instant_of_log_line
from millrace.operators.batching import group_into_batches
from millrace.operators.services import KeyedFiles, call_per_batch, write_keyed_files
from millrace.operators.transforms import bucket_key, skewed_key
from millrace.plans.payloads import BASIC, COUNTRY, MESSAGE_SQL, college_of_order, messages, spread_orders
from millrace.plans.registry import Tables, cents, query, stamp
from millrace.session import scratch_path
from millrace.sources.files import csv_line
from millrace.sources.generators import rate_steps
from millrace.streaming import flows
from millrace.streaming.runtime import (
    END_OF_TIME, closing_heartbeat, draw_some_batches, heartbeat, run_each_batch, run_in_steps, run_to_table, stream_table,
)
from millrace.streaming.state import keyed_windows, stateful_batches, streaming_panes

LIST_SPAN = 4096
RATE = 50_000   # ticks per step, the load the jobs are meant for
SHARDS = 16     # state keys that share a hot key and window


def event_stream(t: Tables) -> tuple[DataFrame, Callable[[], None]]:
    """Events as a stream, and what closes all its windows when it has been read."""
    events = t("events")
    rows = stream_table(t.spark, t.path("events"), events.schema)
    return closing_heartbeat(rows.withColumn("ts", F.col("ts").cast("timestamp")), "ts")


@query("stream_rate_agg", "SELECT event_type, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1")
def stream_rate_agg(t: Tables) -> DataFrame:
    """A paced sequence, a fixed number of ticks a step, that draws the events by number.

    The events are dealt once into the steps that draw them; a step reads its own and no others.
    """
    root = scratch_path(t.spark, "by-step")
    step = F.expr(f"event_id div {RATE}")
    events = t("events").select("event_id", "event_type").where("event_id >= 0").withColumn("step", step)
    events.repartition("step").write.partitionBy("step").parquet(root)
    by_step = t.spark.read.schema(events.schema).parquet(root)
    last = by_step.agg(F.max("event_id")).first()[0] or 0

    def draw(ticks: DataFrame) -> DataFrame:
        first, after = ticks.agg(F.min("value"), F.max("value")).first()
        near = by_step.where(F.col("step").between((first or 0) // RATE, (after or 0) // RATE))
        return ticks.join(near, F.col("value") == F.col("event_id")).select("event_id", "event_type")

    drawn = draw_some_batches(rate_steps(t.spark, RATE), draw, "rate", last // RATE + 1)
    return drawn.groupBy("event_type").agg(F.count("*").alias("cnt"), F.sum("event_id").alias("total"))


@query("stream_files_window", """
    SELECT event_type AS key, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS cnt,
           min(strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) AS first, max(strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) AS last
    FROM events GROUP BY 1, 2""")
def stream_files_window(t: Tables) -> DataFrame:
    """Log lines ``key,instant`` from files as they appear, windowed by the instant they carry."""
    root = scratch_path(t.spark, "logs")
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    t.events.select(csv_line(F.col("event_type"), F.date_format("ts", iso)).alias("value")).write.text(f"{root}/a")
    last = t.spark.range(1).select(F.concat(F.lit("-,"), F.date_format(F.to_timestamp(F.lit(END_OF_TIME)), iso)).alias("value"))
    lines = t.spark.readStream.text(f"{root}/*")
    parsed = lines.select(F.nullif(F.substring_index("value", ",", 1), F.lit("")).alias("key"), after_first_comma(F.col("value")).alias("at"),
                          instant_of_log_line(F.col("value")).alias("ts"))
    windows = parsed.withWatermark("ts", "2 days").groupBy(F.window("ts", "1 hour"), "key").agg(
        F.count("*").alias("cnt"), F.min("at").alias("first"), F.max("at").alias("last"))
    return run_to_table(windows.select("key", stamp("window.start").alias("window_start"), "cnt", "first", "last"), "log-windows",
                        close=lambda: last.write.text(f"{root}/b"))


def message_stream(t: Tables, copies: int) -> DataFrame:
    """Messages as they lie in a bus's landing files."""
    path = scratch_path(t.spark, "bus")
    messages(t, copies).write.parquet(path)
    return t.spark.readStream.schema("payload BINARY, attrs MAP<STRING,STRING>, msg_id STRING").parquet(path)


@query("stream_dedup", """
    SELECT CAST(event_id AS VARCHAR) AS body, 'm' || event_id AS id FROM events WHERE event_id % 10 <> 3
    UNION ALL SELECT CAST(event_id AS VARCHAR), NULL FROM events, (VALUES (0), (1)) AS c(n) WHERE event_id % 10 = 3""")
def stream_dedup(t: Tables) -> DataFrame:
    """Every message was sent twice under one id attribute, of which one is kept; those without the attribute all stay."""
    sent = flows.with_event_time(message_stream(t, 2), "et")
    once = flows.deduplicated(sent, "msgAttrName", "event_ts", "1 hour")
    return run_to_table(once.select(F.decode("payload", "UTF-8").alias("body"), F.col("attrs")["msgAttrName"].alias("id")), "once")


@query("stream_messages", f"""
    SELECT sink, slot, count(*) AS cnt, min(value) AS lo, max(value) AS hi FROM (
      SELECT 'table' AS sink, strftime(ts, '%Y-%m') AS slot, ts, {MESSAGE_SQL} || event_id
        || ', dataFreshnessMs=5000, customPublishTimeDataFreshnessMs=2000, customEventTimeDataFreshnessMs=5000' AS value FROM events
      UNION ALL SELECT 'dated', strftime(ts, '%Y-%m-%d'), ts, {MESSAGE_SQL} || event_id
        || ', dataFreshnessMs=5000, customPublishTimeDataFreshnessMs=2000, customEventTimeDataFreshnessMs=5000' FROM events
      UNION ALL SELECT 'windowed', strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d_%H-%M-%S'), ts, {MESSAGE_SQL} || event_id
        || ', dataFreshnessMs=5000, customPublishTimeDataFreshnessMs=2000, customEventTimeDataFreshnessMs=5000' FROM events)
    GROUP BY 1, 2""")
def stream_messages(t: Tables) -> DataFrame:
    """Bus to table, dated files and windowed files: dedup, event time, windows, text records."""
    sent = flows.with_event_time(message_stream(t, 1), "et")
    once = flows.deduplicated(sent, "msgAttrName", "event_ts", "1 hour")
    processed = F.col("event_ts") + F.expr("INTERVAL 5 SECONDS")
    records = flows.message_records(once, "event_ts", processed, "1 day", dated="day")
    root = scratch_path(t.spark, "messages")
    run_each_batch(records, "messages", flows.write_three_ways(root))
    dated = "value STRING, batch INT, year STRING, month STRING, day STRING"
    sinks = [
        t.spark.read.parquet(f"{root}/table").select(F.lit("table").alias("sink"), F.concat_ws("-", "year", "month").alias("slot"), "value"),
        t.spark.read.schema(dated).parquet(f"{root}/dated").select(
            F.lit("dated").alias("sink"), F.concat_ws("-", "year", "month", "day").alias("slot"), "value"),
        t.spark.read.schema("value STRING, batch INT, win_start STRING").parquet(f"{root}/windowed").select(
            F.lit("windowed").alias("sink"), F.col("win_start").alias("slot"), "value")]
    rows = sinks[0].unionByName(sinks[1]).unionByName(sinks[2])
    return rows.groupBy("sink", "slot").agg(F.count("*").alias("cnt"), F.min("value").alias("lo"), F.max("value").alias("hi"))


@query("stream_to_table", "SELECT event_type, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1")
def stream_to_table(t: Tables) -> DataFrame:
    """Micro-batches appended to a table; a batch that is repeated replaces its first try."""
    root = scratch_path(t.spark, "loads")
    events = stream_table(t.spark, t.path("events"), t("events").schema)
    run_each_batch(events.select("event_id", "event_type"), "loads", flows.append_batches(root))
    return t.spark.read.parquet(root).groupBy("event_type").agg(
        F.count("*").alias("cnt"), F.sum("event_id").alias("total"))


@query("stream_window_concat", f"""
    SELECT event_type AS key, strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_id // {LIST_SPAN} AS block,
           string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids FROM events GROUP BY 1, 2, 3""")
def stream_window_concat(t: Tables) -> DataFrame:
    rows, close = event_stream(t)
    lists = flows.windowed_lists(rows.withColumnRenamed("event_type", "key"), "ts", ["key"], F.col("event_id"), "event_id", "6 hours", LIST_SPAN)
    return run_to_table(lists.select("key", stamp("window_start").alias("window_start"), "block",
                                     F.array_join("values", ",").alias("ids")), "concat", close=close)


@query("stream_bucket_groups", f"""
    SELECT CASE WHEN event_id % 2000 < 10 THEN 'a' WHEN event_id % 2000 < 100 THEN 'b' WHEN event_id % 2000 < 1000 THEN 'c' ELSE 'd' END AS bucket,
           strftime(time_bucket(INTERVAL 12 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_id // {LIST_SPAN} AS block,
           string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids FROM events GROUP BY 1, 2, 3""")
def stream_bucket_groups(t: Tables) -> DataFrame:
    key = bucket_key(F.col("event_id") % 2000, [(10, "a"), (100, "b"), (1000, "c")], "d")
    rows, close = event_stream(t)
    lists = flows.windowed_lists(rows.withColumn("bucket", key), "ts", ["bucket"], F.col("event_id"), "event_id", "12 hours", LIST_SPAN)
    return run_to_table(lists.select("bucket", stamp("window_start").alias("window_start"), "block",
                                     F.array_join("values", ",").alias("ids")), "groups", close=close)


@query("stream_xml_window_sum", f"""
    SELECT layout, strftime(time_bucket(INTERVAL 30 DAY, o_orderdate, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start, {COUNTRY} AS country,
           CAST(sum({BASIC}) AS BIGINT) AS total
    FROM orders CROSS JOIN (VALUES ('plain'), ('salted')) AS l(layout) GROUP BY 1, 2, 3""")
def stream_xml_window_sum(t: Tables) -> DataFrame:
    """Compressed documents summed per window and key, parsed before the shuffle; once plain, once salted."""
    path = scratch_path(t.spark, "xml")
    packed = spread_orders(t).select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"),
                                pl.gzip(F.encode(college_of_order(), "UTF-8")).alias("payload"))
    packed.write.parquet(path)
    salary = pl.packed_salary_sum(F.col("payload"))
    layouts = {"plain": None, "salted": F.pmod("o_orderkey", F.lit(10))}
    done = []
    for name, salt in layouts.items():
        stream, close = closing_heartbeat(t.spark.readStream.schema(packed.schema).parquet(path), "ts")
        parsed = stream.select("ts", "o_orderkey", skewed_key(F.col("o_orderkey")).alias("country"), salary.alias("basic"))
        sums = flows.windowed_sums(parsed, "ts", ["country"], F.col("basic"), "30 days", salt=salt)
        done.append(run_to_table(sums.select(F.lit(name).alias("layout"), stamp("window_start").alias("window_start"), "country", "total"), name,
                                 close=close))
    return done[0].unionByName(done[1])


# --- panes -----------------------------------------------------------------

CUT = "2024-01-16 00:45:00"


def _pane_sql(accumulate: bool) -> str:
    """Two deliveries: the second meets the watermark of the first, and what it brings late makes panes of its own."""
    return f"""WITH log AS (SELECT event_type AS key, CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) AS value, ts,
        ts + to_minutes((event_id * 7919) % 97) AS arrived, time_bucket(INTERVAL 6 HOUR, ts) AS w FROM events),
      stepped AS (SELECT *, CASE WHEN arrived < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END AS step FROM log),
      marks AS (SELECT s.step, max(l.ts) AS wm FROM (VALUES (0), (1)) AS s(step) LEFT JOIN stepped l ON l.step < s.step GROUP BY 1),
      timed AS (SELECT *, CASE WHEN wm IS NULL OR wm < w + INTERVAL 6 HOUR THEN 'ON_TIME'
                  WHEN wm < w + INTERVAL 450 MINUTE THEN 'LATE' ELSE 'DROPPED' END AS timing FROM stepped JOIN marks USING (step)),
      panes AS (SELECT key, w, timing, CASE WHEN timing = 'LATE' THEN step ELSE -1 END AS bundle, CAST(sum(value) AS BIGINT) AS total
                FROM timed WHERE timing <> 'DROPPED' GROUP BY 1, 2, 3, 4)
    SELECT key, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, timing, {"CAST(sum(total) OVER (PARTITION BY key, w ORDER BY bundle) AS BIGINT)" if accumulate else "total"} AS total
    FROM panes"""


def _stream_panes(t: Tables, accumulate: bool) -> DataFrame:
    arrived = F.col("ts") + F.expr("make_interval(0, 0, 0, 0, 0, cast(event_id * 7919 % 97 as int), 0)")
    log = t.events.select(F.col("event_type").alias("key"), cents("value").alias("value"), "ts", arrived.alias("arrived"))
    early = F.col("arrived") < F.lit(CUT).cast("timestamp")
    first, second = log.where(early).drop("arrived"), log.where(~early).drop("arrived")
    panes = run_in_steps([first, second.unionByName(heartbeat(second, "ts"))], lambda stream: streaming_panes(
        stream, ["key"], "value", "ts", "6 hours", 90 * 60 * 1000, accumulate), "panes")
    start = F.timestamp_millis(F.col("window_end_ms") - 6 * 3_600_000)
    return panes.select("key", stamp(start).alias("window_start"), "timing", "total")


@query("stream_late_discarding", _pane_sql(False))
def stream_late_discarding(t: Tables) -> DataFrame:
    """Panes fired by keyed state over two deliveries of out-of-order events; late panes hold new data only."""
    return _stream_panes(t, False)


@query("stream_late_accumulating", _pane_sql(True))
def stream_late_accumulating(t: Tables) -> DataFrame:
    """The same with late panes holding everything so far."""
    return _stream_panes(t, True)


# --- keyed state -----------------------------------------------------------

def _by_number(value):
    return -1 if value is None else value  # the closing row has none


def emit_batch(key, values, why):
    yield (*key, values, why)


def _batches(t: Tables, size: int, window: str) -> DataFrame:
    """``event_type, shard, window_end, members, why`` of the batches per key, shard and window."""
    rows, close = event_stream(t)
    keyed = keyed_windows(rows.withColumn("shard", F.col("event_id") % SHARDS), "ts", window)
    batches = stateful_batches(keyed, ["event_type", "shard"], "event_id", size, emit_batch,
                               T.StructType().add("event_type", "string").add("shard", "long").add("window_end_ms", "long")
                               .add("members", T.ArrayType(T.LongType())).add("why", "string"), order=_by_number)
    return run_to_table(batches, "batches", close=close).withColumn(
        "window_end", F.date_format(F.timestamp_millis("window_end_ms"), "yyyy-MM-dd")).drop("window_end_ms")


def _batches_sql(size: int) -> str:
    return f"""(SELECT event_type, shard, strftime(w + INTERVAL 1 DAY, '%Y-%m-%d') AS window_end, event_id,
        (row_number() OVER (PARTITION BY event_type, shard, w ORDER BY event_id) - 1) // {size} AS batch
        FROM (SELECT *, event_id % {SHARDS} AS shard, time_bucket(INTERVAL 1 DAY, ts) AS w FROM events))"""


@query("stream_group_into_batches", f"""
    SELECT event_type, shard, window_end, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS members,
           CASE WHEN count(*) = 5 THEN 'FULL' ELSE 'REST' END AS why FROM {_batches_sql(5)} GROUP BY event_type, shard, window_end, batch""")
def stream_group_into_batches(t: Tables) -> DataFrame:
    """Batches of 5 per key in one-day windows; keys are sharded, so a hot one has several buffers."""
    return _batches(t, 5, "1 day").withColumn("members", F.array_join("members", ","))


@query("stream_state_pairs", f"""
    SELECT event_type, shard, window_end, min(event_id) AS first, CASE WHEN count(*) = 2 THEN max(event_id) END AS second
    FROM {_batches_sql(2)} GROUP BY event_type, shard, window_end, batch""")
def stream_state_pairs(t: Tables) -> DataFrame:
    """Value and list state that act on every second element; a timer gives out a single one at the window's end."""
    return _batches(t, 2, "1 day").select("event_type", "shard", "window_end", F.get("members", F.lit(0)).alias("first"),
                                          F.get("members", F.lit(1)).alias("second"))


def keyed_service(t: Tables) -> str:
    """The last order priority of every customer as a look-up service; returns its place."""
    path = scratch_path(t.spark, "service")
    write_keyed_files(t("orders").groupBy("o_custkey").agg(F.max_by("o_orderpriority", "o_orderkey").alias("last")), "o_custkey", "last", path)
    return path


def ask_users(service, requests):
    return service.ask([r["user_id"] for r in requests])


def enriched_text():
    """User and answer; a call that has failed is an error of the query."""
    answer = F.when(F.col("error").isNull(), F.coalesce("answer", F.lit("UNKNOWN"))).otherwise(F.raise_error("error"))
    return F.concat(F.col("user_id").cast("string"), F.lit(":"), answer)


@query("enrich_batched_calls", """
    SELECT event_id, user_id || ':' || coalesce(last, 'UNKNOWN') AS enriched FROM events
    LEFT JOIN (SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS last FROM orders GROUP BY 1) ON user_id = o_custkey""")
def enrich_batched_calls(t: Tables) -> DataFrame:
    """Batches of up to 200 requests per event type, one call each, a few calls at a time in a task."""
    batches = group_into_batches(t("events"), ["event_type"], F.struct("event_id", "user_id"), "event_id", 200)
    answered = call_per_batch(batches.repartition("event_type", "batch"), "values", partial(KeyedFiles, keyed_service(t), "o_custkey", "last"), ask_users,
                              T.StringType())
    return answered.select("event_id", enriched_text().alias("enriched"))


def emit_requests(key, values, why):
    yield [(v["event_id"], v["user_id"]) for v in values], why


@query("stream_enrich_batched", """
    SELECT event_id, user_id || ':' || coalesce(o_orderpriority, 'UNKNOWN') AS enriched FROM events
    LEFT JOIN (SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1)
    ON user_id = o_custkey""")
def stream_enrich_batched(t: Tables) -> DataFrame:
    """Requests gathered in batches of up to 20 per key and shard, the rest when the window expires; the service is called once per batch."""
    service = keyed_service(t)
    rows, close = event_stream(t)
    request = T.StructType().add("event_id", "long").add("user_id", "long")
    asking = rows.withColumn("request", F.struct("event_id", "user_id")).withColumn("shard", F.col("event_id") % 4)
    batches = stateful_batches(keyed_windows(asking, "ts", "7 days"), ["event_type", "shard"], "request", 20, emit_requests,
                               T.StructType().add("requests", T.ArrayType(request)).add("why", "string"))
    # the closing row asks for nothing
    real = batches.withColumn("requests", F.filter("requests", lambda r: r["event_id"].isNotNull()))
    answered = call_per_batch(real, "requests", partial(KeyedFiles, service, "o_custkey", "last"), ask_users, T.StringType())
    return run_to_table(answered.select("event_id", enriched_text().alias("enriched")), "enriched", close=close)
