"""Grouping, combining, batching."""

from __future__ import annotations

import gzip as gz
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.temporal import date_path
from millrace.operators import aggregates as ag
from millrace.operators.batching import group_into_batches, with_batch, with_shards
from millrace.operators.ranking import set_pages, value_pages
from millrace.operators.transforms import COUNTRIES, skewed_key, tagged
from millrace.plans.payloads import college_payloads
from millrace.plans.registry import Tables, money, query, stamp
from millrace.session import scratch_path
from millrace.sources.files import write_by_destination

PAGE = 500


@query("group_by_key", f"""
    SELECT event_type AS key, page, count(*) AS cnt, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids
    FROM (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // {PAGE} AS page FROM events)
    GROUP BY 1, 2""")
def group_by_key(t: Tables) -> DataFrame:
    """Values of each key, as lists of bounded length."""
    lists = value_pages(t("events"), ["event_type"], F.col("event_id"), "event_id", PAGE)
    return lists.select(F.col("event_type").alias("key"), "page", F.size("values").cast("bigint").alias("cnt"),
                        F.array_join("values", ",").alias("ids"))


@query("group_by_expr", f"""
    SELECT grp, page, string_agg(c_custkey || ':' || c_name, '|' ORDER BY c_custkey) AS members
    FROM (SELECT *, (row_number() OVER (PARTITION BY grp ORDER BY c_custkey) - 1) // {PAGE} AS page
          FROM (SELECT *, c_mktsegment || c_nationkey % 3 AS grp FROM customer)) GROUP BY 1, 2""")
def group_by_expr(t: Tables) -> DataFrame:
    """Whole rows grouped by a computed key."""
    customer = t("customer")
    row = F.struct(*customer.columns)
    keyed = customer.withColumn("grp", F.concat("c_mktsegment", (F.col("c_nationkey") % 3).cast("string")))
    lists = value_pages(keyed, ["grp"], row, "c_custkey", PAGE, name="rows")
    text = F.transform("rows", lambda r: F.concat_ws(":", r["c_custkey"].cast("string"), r["c_name"]))
    return lists.select("grp", "page", F.array_join(text, "|").alias("members"))


@query("sum_globally", """
    SELECT CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
           CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_id < 0), 0) AS DOUBLE) AS of_none FROM events""")
def sum_globally(t: Tables) -> DataFrame:
    value = money("value")
    none = F.when(F.col("event_id") < 0, value)
    return t("events").agg(F.coalesce(F.sum(value), F.lit(0)).cast("double").alias("total"),
                           F.coalesce(F.sum(none), F.lit(0)).cast("double").alias("of_none"))


@query("sum_without_defaults", """
    SELECT name, total FROM (
      SELECT 'some' AS name, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem
      UNION ALL SELECT 'none', count(*), CAST(sum(l_linenumber) AS BIGINT) FROM lineitem WHERE l_quantity < 0) WHERE n > 0""")
def sum_without_defaults(t: Tables) -> DataFrame:
    """Two collections summed in one pass; the empty one gives no row."""
    both = tagged(t("lineitem").select("l_linenumber", "l_quantity"), {"some": F.lit(True), "none": F.col("l_quantity") < 0}, "name")
    return both.groupBy("name").agg(F.sum("l_linenumber").alias("total"))


@query("count_globally", "SELECT count(*) AS cnt FROM lineitem")
def count_globally(t: Tables) -> DataFrame:
    return t("lineitem").agg(F.count("*").alias("cnt"))


@query("count_per_element", "SELECT l_quantity AS value, count(*) AS cnt FROM lineitem GROUP BY 1")
def count_per_element(t: Tables) -> DataFrame:
    return ag.count_per(t("lineitem").select(F.col("l_quantity").alias("value")), "value")


@query("count_per_key", "SELECT l_suppkey AS key, count(*) AS cnt FROM lineitem GROUP BY 1")
def count_per_key(t: Tables) -> DataFrame:
    return ag.count_per(t("lineitem").select(F.col("l_suppkey").alias("key")), "key")


@query("sum_per_key", """
    SELECT l_returnflag AS key, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem GROUP BY 1""")
def sum_per_key(t: Tables) -> DataFrame:
    return ag.sum_per(t("lineitem").withColumnRenamed("l_returnflag", "key"), ["key"], money("l_extendedprice")).select(
        "key", F.col("total").cast("double").alias("total"))


@query("grouped_values_sum", """
    SELECT vec_id AS key, CAST(list_sum(list_transform(embedding,
             lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT))) AS BIGINT) AS total FROM embeddings""")
def grouped_values_sum(t: Tables) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000))
    return t("embeddings").select(F.col("vec_id").alias("key"), ag.sum_of_list(whole).alias("total"))


@query("gbk_sum_len", """
    SELECT o_orderpriority AS key, CAST(sum(o_custkey) AS BIGINT) AS total, count(*) AS len FROM orders GROUP BY 1""")
def gbk_sum_len(t: Tables) -> DataFrame:
    return t("orders").groupBy(F.col("o_orderpriority").alias("key")).agg(
        F.sum("o_custkey").alias("total"), F.count("*").alias("len"))


@query("top_n", """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20""")
def top_n(t: Tables) -> DataFrame:
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ag.top_n(rows, 20, F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"))


@query("agg_delimited", f"""
    SELECT c_nationkey AS key, page, string_agg(c_name, ':' ORDER BY c_custkey) AS text
    FROM (SELECT *, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // {PAGE} AS page FROM customer)
    GROUP BY 1, 2""")
def agg_delimited(t: Tables) -> DataFrame:
    lists = value_pages(t("customer"), ["c_nationkey"], F.col("c_name"), "c_custkey", PAGE)
    return lists.select(F.col("c_nationkey").alias("key"), "page", F.array_join("values", ":").alias("text"))


@query("agg_to_list", f"""
    SELECT page, string_agg(CAST(p_size AS VARCHAR), ',' ORDER BY p_partkey) AS sizes
    FROM (SELECT *, (row_number() OVER (ORDER BY p_partkey) - 1) // {PAGE} AS page FROM part) GROUP BY 1""")
def agg_to_list(t: Tables) -> DataFrame:
    """The whole collection as a list, in pages."""
    lists = value_pages(t("part"), [], F.col("p_size"), "p_partkey", PAGE)
    return lists.select("page", F.array_join("values", ",").alias("sizes"))


@query("agg_sorted_set", """
    SELECT p_type, string_agg(DISTINCT CAST(p_size AS VARCHAR), ',' ORDER BY CAST(p_size AS VARCHAR)) AS sizes
    FROM part GROUP BY 1""")
def agg_sorted_set(t: Tables) -> DataFrame:
    return t("part").groupBy("p_type").agg(
        F.array_join(ag.sorted_set(F.col("p_size").cast("string")), ",").alias("sizes"))


@query("agg_sorted_set_pages", f"""
    SELECT l_linestatus, page, count(*) AS n, string_agg(part, ',' ORDER BY part) AS parts
    FROM (SELECT *, (row_number() OVER (PARTITION BY l_linestatus ORDER BY part) - 1) // {PAGE} AS page
          FROM (SELECT DISTINCT l_linestatus, CAST(l_partkey AS VARCHAR) AS part FROM lineitem)) GROUP BY 1, 2""")
def agg_sorted_set_pages(t: Tables) -> DataFrame:
    """The parts of each line status as sorted sets, in pages: a set that grows with the data."""
    sets = set_pages(t("lineitem"), ["l_linestatus"], F.col("l_partkey").cast("string"), PAGE)
    return sets.select("l_linestatus", "page", F.size("values").cast("long").alias("n"), F.array_join("values", ",").alias("parts"))


@query("window_sorted_set_pages", f"""
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, page, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS users
    FROM (SELECT *, (row_number() OVER (PARTITION BY w ORDER BY user_id) - 1) // {PAGE} AS page
          FROM (SELECT DISTINCT time_bucket(INTERVAL 1 DAY, ts) AS w, user_id FROM events WHERE user_id IS NOT NULL)) GROUP BY 1, 2""")
def window_sorted_set_pages(t: Tables) -> DataFrame:
    """The users of each day as a sorted set, in pages."""
    rows = t.events.select("user_id", F.window("ts", "1 day")["start"].alias("w"))
    sets = set_pages(rows, ["w"], F.col("user_id"), PAGE)
    return sets.select(stamp("w").alias("window_start"), "page", F.array_join("values", ",").alias("users"))


@query("window_join_strings", f"""
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, page,
           string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids
    FROM (SELECT *, (row_number() OVER (PARTITION BY event_type, w ORDER BY event_id) - 1) // {PAGE} AS page
          FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS w FROM events)) GROUP BY 1, 2, 3""")
def window_join_strings(t: Tables) -> DataFrame:
    rows = t.events.select("event_type", "event_id", F.window("ts", "6 hours")["start"].alias("w"))
    lists = value_pages(rows, ["event_type", "w"], F.col("event_id"), "event_id", PAGE)
    return lists.select(stamp("w").alias("window_start"), "event_type", "page",
                        F.array_join("values", ",").alias("ids"))


class SalarySum(ag.CombineFn):
    """Gunzip, parse and add up the basic salaries of a payload."""

    basic = re.compile(rb"<basic>(-?\d+)</basic>")

    def create(self):
        return 0

    def add(self, acc, payload):
        return acc + sum(map(int, self.basic.findall(gz.decompress(payload))))

    def merge(self, left, right):
        return left + right


@query("udaf_combinefn", f"""
    SELECT ({COUNTRIES})[o_orderkey % 10 + 1] AS country,
           CAST(sum(CAST(floor(o_totalprice) AS BIGINT) + o_custkey + 35000) AS BIGINT) AS total
    FROM orders GROUP BY 1""")
def udaf_combinefn(t: Tables) -> DataFrame:
    rows = college_payloads(t).select(skewed_key(F.col("o_orderkey")).alias("country"), "payload")
    return ag.combine_per_key(rows, "country", "payload", SalarySum(), "bigint", "total")


@query("salted_two_phase_sum", f"""
    SELECT ({COUNTRIES})[event_id % 10 + 1] AS country,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1""")
def salted_two_phase_sum(t: Tables) -> DataFrame:
    rows = t("events").withColumn("country", skewed_key(F.col("event_id")))
    salt = F.pmod(F.xxhash64("event_id"), F.lit(10))
    return ag.salted_sum(rows, ["country"], money("value"), salt).select("country", F.col("total").cast("double").alias("total"))


@query("distinct_values", "SELECT DISTINCT o_custkey FROM orders")
def distinct_values(t: Tables) -> DataFrame:
    return t("orders").select("o_custkey").dropDuplicates()


# --- batches and shards ----------------------------------------------------

def _windowed(t: Tables, duration: str) -> DataFrame:
    return t.events.withColumn("w", F.window("ts", duration)["start"])


def _batch_sql(window: str, size: int | str, key: str = "event_type") -> str:
    return f"""(SELECT *, (row_number() OVER (PARTITION BY {key}, w ORDER BY event_id) - 1) // {size} AS batch
                FROM (SELECT *, {window} AS w FROM events))"""


@query("group_into_batches", f"""
    SELECT event_type AS key, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, batch, count(*) AS size,
           string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids
    FROM {_batch_sql("time_bucket(INTERVAL 1 DAY, ts)", 7)} GROUP BY 1, 2, 3""")
def group_into_batches_query(t: Tables) -> DataFrame:
    batches = group_into_batches(_windowed(t, "1 day"), ["event_type", "w"], F.col("event_id"), "event_id", 7)
    return batches.select(F.col("event_type").alias("key"), stamp("w").alias("window_start"), "batch", "size",
                          F.array_join("values", ",").alias("ids"))


@query("batch_by_minute", f"""
    SELECT path, batch, count(*) AS size, min(event_id) AS first_id, max(event_id) AS last_id
    FROM (SELECT *, 'year=' || strftime(w, '%Y') || '/month=' || strftime(w, '%m') || '/day=' || strftime(w, '%d')
            || '/hour=' || strftime(w, '%H') || '/minute=' || strftime(w, '%M') AS path
          FROM {_batch_sql("date_trunc('minute', ts)", 3, "1")}) GROUP BY 1, 2""")
def batch_by_minute(t: Tables) -> DataFrame:
    keyed = t.events.select(date_path(F.col("ts"), minute=True).alias("path"), "event_id")
    batches = group_into_batches(keyed, ["path"], F.col("event_id"), "event_id", 3)
    return batches.select("path", "batch", "size", F.element_at("values", 1).alias("first_id"),
                          F.element_at("values", -1).alias("last_id"))


FIVE_DAYS = "time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '1970-01-01')"


BATCH_ROWS = 500     # rows of a batch, and of a shard, whatever the size of the table
SHARD_ROWS = 1000


@query("batch_files", f"""
    SELECT event_type, strftime(w, '%Y-%m-%d') AS win, batch, count(*) AS size, min(event_id) AS first_id
    FROM {_batch_sql(FIVE_DAYS, BATCH_ROWS)} GROUP BY 1, 2, 3""")
def batch_files(t: Tables) -> DataFrame:
    """Batches under their destination and window, written and read back; the batch is a column of the files."""
    rows = _windowed(t, "5 days").select("event_type", F.date_format("w", "yyyy-MM-dd").alias("win"), "event_id")
    path = scratch_path(t.spark, "batch_files")
    write_by_destination(with_batch(rows, ["event_type", "win"], "event_id", BATCH_ROWS), path, ["event_type", "win"])
    stored = t.spark.read.schema("event_id BIGINT, batch BIGINT, event_type STRING, win STRING").parquet(path)
    return stored.groupBy("event_type", "win", "batch").agg(
        F.count("*").alias("size"), F.min("event_id").alias("first_id"))


@query("shard_by_count", f"""
    SELECT strftime(w, '%Y-%m-%d') AS win, greatest(1, n // {SHARD_ROWS}) AS shards, event_id % greatest(1, n // {SHARD_ROWS}) AS shard, count(*) AS cnt
    FROM (SELECT *, count(*) OVER (PARTITION BY w) AS n FROM (SELECT *, {FIVE_DAYS} AS w FROM events)) GROUP BY 1, 2, 3""")
def shard_by_count(t: Tables) -> DataFrame:
    """As many shards per window as its rows ask for, written under the window and read back."""
    rows = _windowed(t, "5 days").select(F.date_format("w", "yyyy-MM-dd").alias("win"), "event_id")
    path = scratch_path(t.spark, "shards")
    sharded = with_shards(rows, ["win"], F.col("event_id"), SHARD_ROWS)
    write_by_destination(sharded, path, ["win"])
    stored = t.spark.read.schema("event_id BIGINT, shards BIGINT, shard BIGINT, win STRING").parquet(path)
    return stored.groupBy("win", "shards", "shard").agg(F.count("*").alias("cnt"))
