"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import joins as jn
from millrace.plans.registry import Tables, cents, query
from millrace.streaming.runtime import run_to_table, stream_table

PAGE = 200


@query("join_inner_product", """
    SELECT l_orderkey AS key, l_linenumber, CAST(l_quantity AS BIGINT) * o_custkey AS product
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def join_inner_product(t: Tables) -> DataFrame:
    main = t("lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber", F.col("l_quantity").cast("bigint").alias("m"))
    side = t("orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("s"))
    return main.join(side, "key").select("key", "l_linenumber", (F.col("m") * F.col("s")).alias("product"))


def _two_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers and suppliers by nation; each side misses some nations of the other."""
    main = t("customer").where("c_nationkey < 20").select(
        F.col("c_nationkey").alias("key"), F.col("c_custkey").alias("seq"), cents("c_acctbal").alias("m"))
    side = t("supplier").where("s_nationkey > 4").select(
        F.col("s_nationkey").alias("key"), F.col("s_suppkey").alias("seq"), cents("s_acctbal").alias("s"))
    return main, side


TWO_SIDES = """m AS (SELECT c_nationkey AS key, c_custkey AS seq, CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT) AS m
                     FROM customer WHERE c_nationkey < 20),
               s AS (SELECT s_nationkey AS key, s_suppkey AS seq, CAST(CAST(s_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT) AS s
                     FROM supplier WHERE s_nationkey > 4)"""


@query("cogroup_sum", f"""
    WITH {TWO_SIDES}
    SELECT key, CAST(sum(v) AS BIGINT) AS total FROM (SELECT key, m AS v FROM m UNION ALL SELECT key, s FROM s) GROUP BY 1""")
def cogroup_sum(t: Tables) -> DataFrame:
    main, side = _two_sides(t)
    return jn.cogroup_sums(main, side, "key", "m", "s")


@query("cogroup_sum_multiply", f"""
    WITH {TWO_SIDES}, a AS (SELECT key, sum(m) AS m FROM m GROUP BY 1),
         b AS (SELECT key, min_by(seq, seq) AS s FROM s GROUP BY 1)
    SELECT key, CAST(coalesce(m, 0) * coalesce(s, 1) AS BIGINT) AS total FROM a FULL JOIN b USING (key)""")
def cogroup_sum_multiply(t: Tables) -> DataFrame:
    main, side = _two_sides(t)
    first = side.select("key", "seq", F.col("seq").alias("times"))
    return jn.cogroup_sum_times_first(main, first, "key", "m", "times", "seq")


@query("cogroup_lists", f"""
    WITH {TWO_SIDES},
      a AS (SELECT key, page, string_agg(CAST(m AS VARCHAR), ',' ORDER BY seq) AS l FROM
            (SELECT *, (row_number() OVER (PARTITION BY key ORDER BY seq) - 1) // {PAGE} AS page FROM m) GROUP BY 1, 2),
      b AS (SELECT key, page, string_agg(CAST(s AS VARCHAR), ',' ORDER BY seq) AS r FROM
            (SELECT *, (row_number() OVER (PARTITION BY key ORDER BY seq) - 1) // {PAGE} AS page FROM s) GROUP BY 1, 2)
    SELECT key, page, coalesce(l, '') AS l, coalesce(r, '') AS r FROM a FULL JOIN b USING (key, page)""")
def cogroup_lists(t: Tables) -> DataFrame:
    main, side = _two_sides(t)
    lists = jn.cogroup_pages(main, side, "key", "m", "s", "seq", PAGE)
    return lists.select("key", "page", F.array_join("left_values", ",").alias("l"), F.array_join("right_values", ",").alias("r"))


def _multipliers(t: Tables) -> DataFrame:
    return t("part").where("p_size < 25").select(F.col("p_partkey").alias("key"), F.col("p_size").cast("bigint").alias("times"))


@query("join_broadcast_default", """
    SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) * coalesce(p_size, 1) AS product
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 25) ON p_partkey = l_partkey""")
def join_broadcast_default(t: Tables) -> DataFrame:
    main = t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("key"), F.col("l_quantity").cast("bigint").alias("m"))
    joined = jn.lookup_or_default(main, _multipliers(t), "key", "times", F.lit(1))
    return joined.select("l_orderkey", "l_linenumber", (F.col("m") * F.col("times")).alias("product"))


@query("join_broadcast_sum", """
    SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT) * coalesce(p_size, 1)) AS BIGINT) AS total
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 25) ON p_partkey = l_partkey GROUP BY 1""")
def join_broadcast_sum(t: Tables) -> DataFrame:
    # combined by lookup key first, so the join sees one row per key and flag
    main = t("lineitem").groupBy("l_returnflag", F.col("l_partkey").alias("key")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("m"))
    joined = jn.lookup_or_default(main, _multipliers(t), "key", "times", F.lit(1))
    return joined.groupBy("l_returnflag").agg(F.sum(F.col("m") * F.col("times")).alias("total"))


@query("semi_join_list", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 10)""")
def semi_join_list(t: Tables) -> DataFrame:
    return jn.in_lookup(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"),
                        t("part").where("p_size < 10").select("p_partkey"), "l_partkey", "p_partkey")


@query("semi_join_map", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def semi_join_map(t: Tables) -> DataFrame:
    keys = t("customer").where("c_mktsegment = 'MACHINERY'").select("c_custkey")
    return jn.in_lookup(t("orders").select("o_orderkey", "o_custkey"), keys, "o_custkey", "c_custkey")


@query("anti_join_restricted", """
    SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def anti_join_restricted(t: Tables) -> DataFrame:
    restricted = t("customer").where("c_acctbal < 0").select("c_custkey")
    return jn.in_lookup(t("orders").select("o_orderkey", "o_custkey"), restricted, "o_custkey", "c_custkey", "anti").select("o_orderkey")


@query("stream_static_lookup", """
    SELECT event_type, contained, count(*) AS cnt FROM (
      SELECT event_type, user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS contained FROM events) GROUP BY 1, 2""")
def stream_static_lookup(t: Tables) -> DataFrame:
    """Streamed events flagged by membership in a reference set."""
    events = stream_table(t.spark, t.path("events"), t("events").schema)
    restricted = t("customer").where("c_acctbal < 0").select("c_custkey")
    flagged = jn.in_lookup(events.select("event_type", "user_id"), restricted, "user_id", "c_custkey", "flag")
    return run_to_table(flagged, "flagged").groupBy("event_type", "contained").agg(F.count("*").alias("cnt"))


@query("side_singleton", """
    SELECT c_custkey, (SELECT min(r_name) FROM region) || c_mktsegment AS tagged FROM customer""")
def side_singleton(t: Tables) -> DataFrame:
    meta = t("region").agg(F.min("r_name").alias("meta"))
    tagged = jn.with_singleton(t("customer").select("c_custkey", "c_mktsegment"), meta, "meta")
    return tagged.select("c_custkey", F.concat("meta", "c_mktsegment").alias("tagged"))


@query("side_list", """
    SELECT c_custkey, '[' || (SELECT string_agg(DISTINCT r_name, ', ' ORDER BY r_name) FROM region) || ']__' || c_mktsegment AS tagged
    FROM customer""")
def side_list(t: Tables) -> DataFrame:
    tagged = jn.with_side_set(t("customer").select("c_custkey", "c_mktsegment"), t("region"), "r_name", "names")
    return tagged.select("c_custkey", F.concat(F.lit("["), F.array_join("names", ", "), F.lit("]__"), "c_mktsegment").alias("tagged"))


@query("join_schema_struct", """
    SELECT c_custkey AS id, c_name || ',' || o_orderkey || ',' || o_orderpriority AS text
    FROM customer JOIN orders ON c_custkey = o_custkey""")
def join_schema_struct(t: Tables) -> DataFrame:
    names = t("customer").select(F.col("c_custkey").alias("id"), "c_name")
    orders = t("orders").select(F.col("o_custkey").alias("id"), "o_orderkey", "o_orderpriority")
    return jn.schema_join(names, orders, ["id"]).select(
        F.col("lhs.id").alias("id"), F.concat_ws(",", "lhs.c_name", F.col("rhs.o_orderkey").cast("string"), "rhs.o_orderpriority").alias("text"))


@query("join_tiered_match", """
    WITH p AS (SELECT o_orderkey AS k1, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'O' END AS k2,
                      CASE o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS k3 FROM orders),
         s AS (SELECT l_orderkey AS k1, l_linestatus AS k2, l_returnflag AS k3, l_partkey AS v FROM lineitem),
         exact AS (SELECT p.*, 1 AS tier, s.v AS v FROM p JOIN s USING (k1, k2, k3)),
         rest AS (SELECT p.* FROM p ANTI JOIN s USING (k1, k2, k3)),
         best AS (SELECT k1, k2, v FROM (SELECT *, row_number() OVER (PARTITION BY k1, k2 ORDER BY k3 DESC, v DESC) AS rn FROM s) WHERE rn = 1)
    SELECT k1, k2, k3, tier, v FROM exact
    UNION ALL SELECT k1, k2, k3, CASE WHEN best.v IS NOT NULL THEN 2 END, best.v FROM rest LEFT JOIN best USING (k1, k2)""")
def join_tiered_match(t: Tables) -> DataFrame:
    left = t("orders").select(
        F.col("o_orderkey").alias("k1"), F.when(F.col("o_orderstatus") == "F", "F").otherwise("O").alias("k2"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("k3"))
    right = t("lineitem").select(F.col("l_orderkey").alias("k1"), F.col("l_linestatus").alias("k2"),
                                 F.col("l_returnflag").alias("k3"), F.col("l_partkey").alias("v"))
    return jn.tiered_match(left, right, ["k1", "k2"], "k3", "v")


@query("enrich_batched_lookup", """
    SELECT event_id, user_id || ':' || coalesce(last, 'UNKNOWN') AS enriched FROM events
    LEFT JOIN (SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS last FROM orders GROUP BY 1) ON user_id = o_custkey""")
def enrich_batched_lookup(t: Tables) -> DataFrame:
    service = t("orders").select("o_custkey", "o_orderpriority", "o_orderkey")
    enriched = jn.enrich_with_last(t("events").select("event_id", "user_id"), service, "user_id", "o_custkey",
                                   "o_orderpriority", "o_orderkey")
    return enriched.select("event_id", F.concat_ws(":", F.col("user_id").cast("string"), "o_orderpriority").alias("enriched"))
