"""Element-wise queries: sources in memory, maps, filters, keys, routing, dead letters, metrics, scalars."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.arrays import register_array_functions
from millrace.functions.temporal import (
    date_path, decimal_scale9, file_safe, freshness_ms, micros_of_day, reverse_timestamp,
)
from millrace.functions.text import hash_prefix, parse_int, thousands
from millrace.operators import transforms as tr
from millrace.plans.registry import Tables, query, stamp
from millrace.sources.generators import LOAD_PROFILE, generated_records, parameter_range, weighted_fanout
from millrace.sources.tables import DATE, checked, sql_with_parameters


@query("src_values", """
    SELECT e.event_type, count(*) AS cnt, sum(w.weight) AS weight
    FROM events e JOIN (VALUES ('click', 3), ('view', 1), ('error', 7)) AS w(event_type, weight)
      ON e.event_type = w.event_type GROUP BY 1""")
def src_values(t: Tables) -> DataFrame:
    weights = t.spark.createDataFrame([("click", 3), ("view", 1), ("error", 7)], "event_type string, weight bigint")
    return t("events").join(weights, "event_type").groupBy("event_type").agg(
        F.count("*").alias("cnt"), F.sum("weight").alias("weight"))


@query("src_timestamped", """
    SELECT m.name, count(e.event_id) AS cnt
    FROM (VALUES ('start', TIMESTAMP '2024-01-01 00:00:00'), ('mid', TIMESTAMP '2024-01-15 12:00:00'),
                 ('none', TIMESTAMP '2025-06-01 00:00:00')) AS m(name, mark)
    LEFT JOIN events e ON CAST(e.ts AS DATE) = CAST(m.mark AS DATE) GROUP BY 1""")
def src_timestamped(t: Tables) -> DataFrame:
    marks = t.spark.createDataFrame(
        [("start", "2024-01-01 00:00:00"), ("mid", "2024-01-15 12:00:00"), ("none", "2025-06-01 00:00:00")],
        "name string, at string").withColumn("at", F.to_timestamp("at"))
    per_day = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return marks.join(per_day, F.to_date("at") == F.col("day"), "left").select(
        "name", F.coalesce("n", F.lit(0)).alias("cnt"))


@query("src_param_range", """
    SELECT count(*) AS ids, count(o.o_orderkey) AS present, sum(r.id) AS id_sum
    FROM (SELECT unnest(range(lo, hi + 1)) AS id
          FROM (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)) r
    LEFT JOIN orders o ON o.o_orderkey = r.id""")
def src_param_range(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey")
    lo, hi = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    ids = parameter_range(t.spark, f"{lo},{hi}")
    return ids.join(orders, F.col("id") == F.col("o_orderkey"), "left").agg(
        F.count("*").alias("ids"), F.count("o_orderkey").alias("present"), F.sum("id").alias("id_sum"))


@query("src_sequence", """
    SELECT r.id % 10 AS digit, count(*) AS cnt, count(e.event_id) AS matched
    FROM (SELECT unnest(range(0, n)) AS id FROM (SELECT count(*) AS n FROM events)) r
    LEFT JOIN events e ON e.event_id = r.id GROUP BY 1""")
def src_sequence(t: Tables) -> DataFrame:
    events = t("events").select("event_id")
    return t.spark.range(events.count()).join(events, F.col("id") == F.col("event_id"), "left").groupBy(
        (F.col("id") % 10).alias("digit")).agg(F.count("*").alias("cnt"), F.count("event_id").alias("matched"))


@query("gen_weighted_fanout", f"""
    WITH w AS (SELECT c_custkey, ({LOAD_PROFILE})[CAST(c_custkey % 600 // 40 AS INT) + 1] AS weight FROM customer),
         m AS (SELECT weight, c_custkey || '_' || unnest(range(0, weight)) AS body FROM w)
    SELECT weight, count(*) AS messages, CAST(sum(length(body)) AS BIGINT) AS chars FROM m GROUP BY 1""")
def gen_weighted_fanout(t: Tables) -> DataFrame:
    # the load profile starts again every 600 customers
    ticks = t("customer").select((F.col("c_custkey") % 600).alias("tick"), "c_custkey")
    sent = weighted_fanout(ticks, "tick", 40, LOAD_PROFILE, body=F.col("c_custkey"))
    return sent.groupBy("weight").agg(F.count("*").alias("messages"), F.sum(F.length("body")).alias("chars"))


@query("gen_records", """
    SELECT substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(o_orderkey AS VARCHAR)), 9, 4)
             || '-' || substr(md5(CAST(o_orderkey AS VARCHAR)), 13, 4) || '-'
             || substr(md5(CAST(o_orderkey AS VARCHAR)), 17, 4) || '-'
             || substr(md5(CAST(o_orderkey AS VARCHAR)), 21, 12) AS id,
           CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 AS INT) AS number,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created, 1000 AS text_length
    FROM orders""")
def gen_records(t: Tables) -> DataFrame:
    records = generated_records(t("orders"), F.col("o_orderkey"), F.col("o_orderdate"))
    return records.select("id", "number", stamp("created").alias("created"), F.length("text").alias("text_length"))


@query("sql_param_filter", """
    SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
    WHERE o_orderdate = TIMESTAMP '1997-01-15' AND o_totalprice >= 10000""")
def sql_param_filter(t: Tables) -> DataFrame:
    day = checked("orderDate", "1997-01-15", DATE)
    return sql_with_parameters(t.spark, """
        SELECT o_orderkey, o_custkey, o_orderpriority FROM {orders}
        WHERE o_orderdate = CAST(:day AS TIMESTAMP_NTZ) AND o_totalprice >= :least""",
        {"day": day, "least": 10000.0}, orders=t("orders"))


# --- maps, filters, keys ---------------------------------------------------

@query("map_upper_len", "SELECT c_custkey, upper(c_name) AS name, length(c_name) AS len FROM customer")
def map_upper_len(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", F.upper("c_name").alias("name"), F.length("c_name").alias("len"))


@query("string_funcs", """
    SELECT p_partkey, upper(p_name) AS up, length(p_name) AS len, p_brand || '/' || p_type AS joined,
           split_part(p_name, ' ', 1) AS first_word, substr(p_brand, 7) AS brand_no,
           contains(p_name, 'widget') AS has_widget, ends_with(p_type, 'Y') AS ends_y,
           format('{:,}', p_partkey * 12345) AS grouped
    FROM part""")
def string_funcs(t: Tables) -> DataFrame:
    return t("part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.length("p_name").alias("len"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.get(F.split("p_name", " "), F.lit(0)).alias("first_word"),
        F.substring("p_brand", 7, 100).alias("brand_no"), F.col("p_name").contains("widget").alias("has_widget"),
        F.col("p_type").endswith("Y").alias("ends_y"), thousands(F.col("p_partkey") * 12345).alias("grouped"))


@query("udf_setup_once", """
    SELECT event_type, count(*) AS cnt, CAST(sum(CASE WHEN CAST(json_extract(props, '$.k') AS INT) % 2 = 0
           THEN 1 ELSE 0 END) AS BIGINT) AS even_k
    FROM events GROUP BY 1""")
def udf_setup_once(t: Tables) -> DataFrame:
    def build():
        import re
        return re.compile(r'"k":\s*(\d+)')

    def apply(pattern, batch):
        k = batch["props"].str.extract(pattern, expand=False)
        return batch[["event_type"]].assign(even=(k.astype("int64") % 2 == 0))

    flagged = tr.map_partitions_with_setup(
        t("events").select("event_type", "props"), build, apply, "event_type string, even boolean")
    return flagged.groupBy("event_type").agg(
        F.count("*").alias("cnt"), F.sum(F.col("even").cast("bigint")).alias("even_k"))


@query("udf_factorial_digits", """
    SELECT n, parts, CAST(floor((SELECT sum(log10(k)) FROM range(1, 10051) AS r(k) WHERE k <= n)) AS INT) + 1 AS digits
    FROM (SELECT 10000 + p_size AS n, count(*) AS parts FROM part GROUP BY 1)""")
def udf_factorial_digits(t: Tables) -> DataFrame:
    """Digits of (10000 + size)! per part; the numbers are few, so each is computed once and looked up."""
    from millrace.functions.numbers import factorial_text

    sizes = t("part").groupBy((F.lit(10000) + F.col("p_size")).alias("n")).agg(F.count("*").alias("parts"))
    return sizes.repartition("n").select("n", "parts", F.length(factorial_text(F.col("n"))).alias("digits"))


@query("flatmap_explode", r"""
    SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1""")
def flatmap_explode(t: Tables) -> DataFrame:
    words = t("documents").select(F.explode(F.split("text", " ")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count("*").alias("cnt"))


@query("flatten_groups", """
    SELECT vec_id % 7 AS grp, count(*) AS cnt, CAST(sum(CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT)) AS BIGINT) AS total
    FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) GROUP BY 1""")
def flatten_groups(t: Tables) -> DataFrame:
    values = tr.flatten_lists(t("embeddings").select("vec_id", "embedding"), "embedding", "x")
    return values.groupBy((F.col("vec_id") % 7).alias("grp")).agg(
        F.count("*").alias("cnt"), F.sum(F.floor(F.col("x").cast("double") * 1000)).alias("total"))


@query("filter_pred", "SELECT event_id, event_type FROM events WHERE event_type <> 'click' AND value > 50")
def filter_pred(t: Tables) -> DataFrame:
    return t("events").where("event_type <> 'click' AND value > 50").select("event_id", "event_type")


@query("filter_not_null", """
    SELECT c_custkey, c_mktsegment AS segment FROM customer WHERE c_mktsegment <> 'FURNITURE'""")
def filter_not_null(t: Tables) -> DataFrame:
    some = t("customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"))
    return some.where(F.col("segment").isNotNull())


@query("sql_not_null", "SELECT count(*) AS cnt, min(doc_id) AS first_id FROM documents WHERE lang IS NOT NULL AND n_chars BETWEEN 100 AND 5000")
def sql_not_null(t: Tables) -> DataFrame:
    return t.spark.sql("""SELECT count(*) AS cnt, min(doc_id) AS first_id FROM {documents}
                          WHERE lang IS NOT NULL AND n_chars BETWEEN 100 AND 5000""", documents=t("documents"))


@query("with_keys", "SELECT length(p_name) AS key, p_partkey AS value FROM part")
def with_keys(t: Tables) -> DataFrame:
    return t("part").select(F.length("p_name").alias("key"), F.col("p_partkey").alias("value"))


@query("keys_values", """
    SELECT 'key' AS part, o_orderpriority AS item, count(*) AS cnt FROM orders GROUP BY 2
    UNION ALL SELECT 'value', o_orderstatus, count(*) FROM orders GROUP BY 2""")
def keys_values(t: Tables) -> DataFrame:
    pairs = t("orders").select(F.col("o_orderpriority").alias("key"), F.col("o_orderstatus").alias("value"))
    items = pairs.select(F.explode(F.array(*[F.struct(F.lit(c).alias("part"), F.col(c).alias("item")) for c in ("key", "value")])).alias("i"))
    return items.groupBy("i.part", "i.item").agg(F.count("*").alias("cnt"))


@query("key_buckets", """
    SELECT CASE WHEN event_id < 10 THEN 'a' WHEN event_id < 100 THEN 'b' WHEN event_id < 1000 THEN 'c' ELSE 'd' END AS bucket,
           count(*) AS cnt, min(event_id) AS lo, max(event_id) AS hi FROM events GROUP BY 1""")
def key_buckets(t: Tables) -> DataFrame:
    key = tr.bucket_key(F.col("event_id"), [(10, "a"), (100, "b"), (1000, "c")], "d")
    return t("events").groupBy(key.alias("bucket")).agg(
        F.count("*").alias("cnt"), F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))


@query("key_skew_distribution", f"""
    SELECT ({tr.COUNTRIES})[event_id % 10 + 1] AS country, count(*) AS cnt FROM events GROUP BY 1""")
def key_skew_distribution(t: Tables) -> DataFrame:
    return t("events").groupBy(tr.skewed_key(F.col("event_id")).alias("country")).agg(F.count("*").alias("cnt"))


# --- several outputs, dead letters -----------------------------------------

@query("multi_output_even_odd", """
    SELECT CASE WHEN n % 2 = 0 THEN 'even' ELSE 'odd' END AS output, count(*) AS cnt, CAST(sum(n) AS BIGINT) AS total
    FROM (SELECT CASE WHEN event_id % 3 = 0 THEN -event_id ELSE event_id END AS n FROM events)
    WHERE n % 2 IN (0, 1) GROUP BY 1""")
def multi_output_even_odd(t: Tables) -> DataFrame:
    signed = t("events").select(
        F.when(F.col("event_id") % 3 == 0, -F.col("event_id")).otherwise(F.col("event_id")).alias("n"))
    return tr.tagged(signed, tr.odd_even_rules("n")).groupBy("output").agg(F.count("*").alias("cnt"), F.sum("n").alias("total"))


@query("partition_three_way", """
    SELECT CASE WHEN regexp_full_match(s, '[a-z]+') THEN 0 WHEN regexp_full_match(s, '[A-Z]+') THEN 1 ELSE 2 END AS part,
           count(*) AS cnt, min(s) AS lo, max(s) AS hi
    FROM (SELECT CASE l_linenumber % 3 WHEN 0 THEN lower(l_returnflag) WHEN 1 THEN l_linestatus
                 ELSE CAST(l_linenumber AS VARCHAR) END AS s FROM lineitem) GROUP BY 1""")
def partition_three_way(t: Tables) -> DataFrame:
    third = F.col("l_linenumber") % 3
    items = t("lineitem").select(F.when(third == 0, F.lower("l_returnflag")).when(third == 1, F.col("l_linestatus"))
                                 .otherwise(F.col("l_linenumber").cast("string")).alias("s"))
    index = F.when(F.col("s").rlike("^[a-z]+$"), 0).when(F.col("s").rlike("^[A-Z]+$"), 1).otherwise(2)
    return items.groupBy(tr.checked_index(index, 3).alias("part")).agg(
        F.count("*").alias("cnt"), F.min("s").alias("lo"), F.max("s").alias("hi"))


def _spoiled(t: Tables) -> DataFrame:
    """Customer keys as text, every third one not a number."""
    return t("customer").select(F.concat(F.when(F.col("c_custkey") % 3 == 0, "x").otherwise(""),
                                         F.col("c_custkey").cast("string")).alias("line"))


@query("dead_letter_parse", """
    SELECT 'good' AS output, CAST(c_custkey AS VARCHAR) AS item FROM customer WHERE c_custkey % 3 <> 0
    UNION ALL SELECT 'bad', 'For input string: "x' || c_custkey || '"' FROM customer WHERE c_custkey % 3 = 0""")
def dead_letter_parse(t: Tables) -> DataFrame:
    tried = tr.attempted(_spoiled(t), F.col("line"), parse_int(F.col("line")), "n", "For input string: ")
    return tried.select(F.when(F.col("error").isNull(), "good").otherwise("bad").alias("output"),
                        F.coalesce("error", F.col("n").cast("string")).alias("item"))


@query("dead_letter_union", """
    SELECT step, count(*) AS cnt, min(raw) AS lo, max(raw) AS hi FROM (
      SELECT 'parse' AS step, 'x' || c_custkey AS raw FROM customer WHERE c_custkey % 3 = 0
      UNION ALL SELECT 'divide', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 5 = 0
      UNION ALL SELECT 'good', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 5 <> 0)
    GROUP BY 1""")
def dead_letter_union(t: Tables) -> DataFrame:
    """Failures of two steps, told apart in one pass."""
    parsed = tr.attempted(_spoiled(t), F.col("line"), parse_int(F.col("line")), "n", "For input string: ", "parse_error")
    both = tr.attempted(parsed, F.col("line"), F.try_divide(F.lit(100), F.col("n") % 5), "q", "Division by zero: ", "divide_error")
    step = F.when(F.col("parse_error").isNotNull(), "parse").when(F.col("divide_error").isNotNull(), "divide").otherwise("good")
    return both.groupBy(step.alias("step")).agg(F.count("*").alias("cnt"), F.min("line").alias("lo"), F.max("line").alias("hi"))


# --- metrics ---------------------------------------------------------------

@query("observe_metrics", """
    SELECT count(*) AS rows, count(user_id) AS count, min(user_id) AS min, max(user_id) AS max,
           CAST(sum(user_id) AS BIGINT) AS sum FROM events""")
def observe_metrics(t: Tables) -> DataFrame:
    """Metrics gathered while the rows pass on their way to a sink."""
    rows, observation = tr.observed(t("events").select("user_id"), "events", "user_id")
    rows.write.format("noop").mode("overwrite").save()
    seen = observation.get
    names = ["rows", "count", "min", "max", "sum"]
    return t.spark.createDataFrame([tuple(seen[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


@query("partition_sizes", "SELECT count(*) AS rows, true AS none_empty, true AS even FROM lineitem")
def partition_sizes(t: Tables) -> DataFrame:
    """How the rows lie after dealing them out: all there, no partition empty or twice as full as the average."""
    sizes = tr.partition_sizes(t("lineitem").select("l_orderkey").repartition(8))
    return sizes.agg(F.sum("rows").alias("rows"), (F.count("*") == 8).alias("none_empty"), (F.max("rows") < 2 * F.avg("rows")).alias("even"))


@query("data_freshness", """
    SELECT event_type, CAST(min(f) AS BIGINT) AS lo, CAST(max(f) AS BIGINT) AS hi, CAST(sum(f) AS BIGINT) AS total FROM (
      SELECT event_type, CASE WHEN event_id % 4 = 0 THEN -1 ELSE epoch_ms(TIMESTAMP '2024-02-01') - (epoch_us(ts) // 1000) END AS f
      FROM events) GROUP BY 1""")
def data_freshness(t: Tables) -> DataFrame:
    processed = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    event = F.when(F.col("event_id") % 4 != 0, F.col("ts"))
    return t.events.withColumn("f", freshness_ms(processed, event)).groupBy("event_type").agg(
        F.min("f").alias("lo"), F.max("f").alias("hi"), F.sum("f").alias("total"))


# --- scalars, views --------------------------------------------------------

@query("hash_prefix", """
    SELECT substr(md5((epoch_us(ts) // 1000) || CAST(event_id % 8 AS VARCHAR)), 1, 6) AS prefix, event_id FROM events""")
def hash_prefix_query(t: Tables) -> DataFrame:
    return t.events.select(hash_prefix(F.unix_millis("ts"), F.col("event_id") % 8).alias("prefix"), "event_id")


@query("temporal_conversions", """
    SELECT event_id, epoch_us(ts) AS micros, CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INT) AS epoch_day,
           epoch_us(ts) % 86400000000 AS time_micros, strftime(ts, '%Y-%m-%d') AS day,
           strftime(ts, '%H:%M:%S.%f') AS time_text,
           'year=' || strftime(ts, '%Y') || '/month=' || strftime(ts, '%m') || '/day=' || strftime(ts, '%d') || '/hour='
             || strftime(ts, '%H') || '/minute=' || strftime(ts, '%M') AS path,
           strftime(ts, '%Y-%m-%dT%H_%M_%S') AS safe
    FROM events""")
def temporal_conversions(t: Tables) -> DataFrame:
    ts = F.col("ts")
    time = F.to_time(F.date_format(ts, "HH:mm:ss.SSSSSS"))
    back = F.timestamp_micros(F.unix_micros(ts))
    return t.events.select(
        "event_id", F.unix_micros(ts).alias("micros"), F.unix_date(F.to_date(ts)).alias("epoch_day"),
        micros_of_day(time).alias("time_micros"),
        F.date_format(F.date_from_unix_date(F.unix_date(F.to_date(ts))), "yyyy-MM-dd").alias("day"),
        F.date_format(back, "HH:mm:ss.SSSSSS").alias("time_text"), date_path(ts, minute=True).alias("path"),
        file_safe(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).alias("safe"))


@query("kv_reverse_ts_key", """
    SELECT event_id, event_type || '#' || CAST(9223372036854775807 - (epoch_us(ts) // 1000) AS VARCHAR) AS row_key FROM events""")
def kv_reverse_ts_key(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.concat(
        "event_type", F.lit("#"), reverse_timestamp(F.col("ts")).cast("string")).alias("row_key"))


@query("decimal_scale9", """
    SELECT l_returnflag, CAST(CAST(sum(CAST(l_discount AS DECIMAL(38,9)) * 100) AS BIGINT) AS VARCHAR) AS hundredths,
           CAST(max(CAST(l_tax AS DECIMAL(38,9))) AS VARCHAR) AS max_tax
    FROM lineitem GROUP BY 1""")
def decimal_scale9_query(t: Tables) -> DataFrame:
    exact = t("lineitem").select("l_returnflag", decimal_scale9(F.col("l_discount").cast("string")).alias("d"),
                                 decimal_scale9(F.col("l_tax").cast("string")).alias("x"))
    return exact.groupBy("l_returnflag").agg(
        (F.sum("d") * 100).cast("bigint").cast("string").alias("hundredths"), F.max("x").cast("string").alias("max_tax"))


def _with_numbers(t: Tables) -> DataFrame:
    """Vectors as arrays of integers; every eleventh one empty."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000))
    return t("embeddings").select("vec_id", F.when(F.col("vec_id") % 11 == 0, F.array().cast("array<bigint>"))
                                  .otherwise(whole).alias("numbers"))


NUMBERS_SQL = """(SELECT vec_id, CASE WHEN vec_id % 11 = 0 THEN [] ELSE
      list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT)) END AS numbers FROM embeddings)"""


@query("view_array_sum", f"""
    SELECT vec_id, len(numbers) AS n, CAST(list_sum(numbers) AS BIGINT) AS "sum" FROM {NUMBERS_SQL}""")
def view_array_sum(t: Tables) -> DataFrame:
    register_array_functions(t.spark)
    return t.spark.sql("SELECT vec_id, size(numbers) AS n, my_sum(numbers) AS sum FROM {numbers}", numbers=_with_numbers(t))


@query("view_even_numbers", f"""
    SELECT vec_id, n[1] AS n0, n[2] AS n1, CASE WHEN len(n) > 0 THEN len(n) END AS evens
    FROM (SELECT vec_id, list_filter(numbers, lambda x: x % 2 = 0) AS n FROM {NUMBERS_SQL})""")
def view_even_numbers(t: Tables) -> DataFrame:
    register_array_functions(t.spark)
    return t.spark.sql("""
        SELECT vec_id, get(n, 0) AS n0, get(n, 1) AS n1, CASE WHEN n IS NOT NULL THEN size(n) END AS evens
        FROM (SELECT *, my_even_numbers(numbers) AS n FROM {numbers})""", numbers=_with_numbers(t))


@query("view_restricted", "SELECT c_custkey, c_mktsegment FROM customer")
def view_restricted(t: Tables) -> DataFrame:
    """A restricting view over a table that is itself not shown; both have names of their own in the session."""
    mark = uuid.uuid4().hex[:12]
    t("customer").createOrReplaceTempView(f"private_customer_{mark}")
    t.spark.sql(f"""CREATE TEMPORARY VIEW public_customer_{mark} AS
                    SELECT c_custkey, c_mktsegment FROM private_customer_{mark}""")
    return t.spark.table(f"public_customer_{mark}")


@query("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def limit_n(t: Tables) -> DataFrame:
    return t("orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_totalprice").limit(10)


@query("flatten_union_all", """
    SELECT name, count(*) AS cnt FROM (SELECT r_name AS name FROM region UNION ALL SELECT n_name FROM nation
      UNION ALL SELECT c_mktsegment FROM customer UNION ALL SELECT o_orderpriority FROM orders) GROUP BY 1""")
def flatten_union_all(t: Tables) -> DataFrame:
    parts = [("region", "r_name"), ("nation", "n_name"), ("customer", "c_mktsegment"), ("orders", "o_orderpriority")]
    return tr.union_all([t(table).select(F.col(c).alias("name")) for table, c in parts]).groupBy("name").agg(
        F.count("*").alias("cnt"))
