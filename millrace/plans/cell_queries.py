"""Wide-column rows: customers as cells of two families, two versions each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import cells as cl
from millrace.plans.registry import Tables, cents, query
from millrace.session import scratch_path

BASE = 1_700_000_000_000_000
LATER = 3_000_000
PROFILE, ACCOUNT = "profile", "account"


def customer_cells(t: Tables, whole_rows: bool = False) -> DataFrame:
    key = F.concat(F.lit("n"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("#"),
                   F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    old = F.lit(BASE) + F.col("c_custkey") % 1000 * 1000
    values = {
        (PROFILE, "segment"): F.concat("c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, "-plus").otherwise("")),
        (PROFILE, "tier"): F.when(F.col("c_custkey") % 5 == 0, "gold").when(
            F.col("c_custkey") % 5 < 3, F.concat(F.lit("level "), (F.col("c_custkey") % 7).cast("string"))),
        (PROFILE, "region"): F.concat(F.lit("region "), (F.col("c_nationkey") % 3).cast("string")),
        (ACCOUNT, "name"): F.col("c_name"),
        (ACCOUNT, "cents"): cents("c_acctbal").cast("string"),
    }
    cells = []
    for (family, qualifier), value in values.items():
        cells.append(cl.cell(family, qualifier, old, F.concat(F.lit("old_"), value)))
        cells.append(cl.cell(family, qualifier, old + LATER, value))
    return cl.unpivot(t("customer"), key, cells, whole_rows)


CELLS = f"""WITH c AS (SELECT *, 'n' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS row_key,
                       {BASE} + c_custkey % 1000 * 1000 AS old FROM customer),
    one AS (SELECT row_key, old, '{PROFILE}' AS family, 'segment' AS qualifier,
                   c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN '-plus' ELSE '' END AS value FROM c
      UNION ALL SELECT row_key, old, '{PROFILE}', 'tier', CASE WHEN c_custkey % 5 = 0 THEN 'gold'
                   WHEN c_custkey % 5 < 3 THEN 'level ' || c_custkey % 7 END FROM c
      UNION ALL SELECT row_key, old, '{PROFILE}', 'region', 'region ' || c_nationkey % 3 FROM c
      UNION ALL SELECT row_key, old, '{ACCOUNT}', 'name', c_name FROM c
      UNION ALL SELECT row_key, old, '{ACCOUNT}', 'cents', CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT) AS VARCHAR) FROM c),
    cells AS (SELECT row_key, family, qualifier, old AS ts_micros, 'old_' || value AS value FROM one WHERE value IS NOT NULL
      UNION ALL SELECT row_key, family, qualifier, old + {LATER}, value FROM one WHERE value IS NOT NULL),
    latest AS (SELECT row_key, family, qualifier, max(ts_micros) AS ts_micros, max_by(value, ts_micros) AS value FROM cells GROUP BY 1, 2, 3)"""


@query("kv_latest_cell", f"{CELLS} SELECT * FROM latest")
def kv_latest_cell(t: Tables) -> DataFrame:
    return cl.latest(customer_cells(t, whole_rows=True))


@query("kv_range_scan", f"{CELLS} SELECT * FROM cells WHERE row_key >= 'n05#' AND row_key < 'n07#~'")
def kv_range_scan(t: Tables) -> DataFrame:
    """Cells stored in key order, so that a key range reads only the files and row groups it touches."""
    path = scratch_path(t.spark, "cells")
    cl.write_sorted(customer_cells(t), path)
    return cl.key_range(t.spark.read.parquet(path), "n05#", "n07#~")


@query("kv_ts_range", f"{CELLS} SELECT * FROM cells WHERE ts_micros >= {BASE + LATER} AND ts_micros < {BASE + LATER + 500_000}")
def kv_ts_range(t: Tables) -> DataFrame:
    return cl.time_range(customer_cells(t), BASE + LATER, BASE + LATER + 500_000)


@query("kv_cell_filter", f"""{CELLS} SELECT * FROM cells WHERE regexp_full_match(family, 'prof.*')
    AND regexp_full_match(qualifier, 'segment') AND regexp_full_match(value, '.*-plus')""")
def kv_cell_filter(t: Tables) -> DataFrame:
    return customer_cells(t).where(cl.matches(family="prof.*", qualifier="segment", value=".*-plus"))


@query("kv_condition_row", f"""{CELLS} SELECT * FROM cells WHERE row_key IN (
    SELECT row_key FROM cells WHERE family = '{PROFILE}' AND qualifier = 'tier' AND value = 'gold')""")
def kv_condition_row(t: Tables) -> DataFrame:
    return cl.rows_with(customer_cells(t), cl.matches(PROFILE, "tier", "gold"))


@query("kv_condition_label", f"""{CELLS}, seen AS (
      SELECT * FROM latest WHERE ts_micros >= {BASE + LATER} AND ts_micros < {BASE + LATER + 10_000_000}),
    flags AS (SELECT row_key, bool_or(qualifier = 'tier' AND value = 'gold') AS gold,
                     bool_or(qualifier = 'segment' AND value LIKE '%-plus') AS plus,
                     bool_or(qualifier = 'region' AND value = 'region 2') AS far FROM seen GROUP BY 1)
    SELECT row_key, qualifier, value, label FROM seen JOIN (
      SELECT row_key, CASE WHEN gold AND plus THEN 'gold plus' WHEN NOT gold AND far THEN 'far' END AS label FROM flags)
    USING (row_key) WHERE label IS NOT NULL""")
def kv_condition_label(t: Tables) -> DataFrame:
    """Newest cells in a time range; rows labelled by a nested condition, all others blocked."""
    seen = cl.time_range(cl.latest(customer_cells(t, whole_rows=True)), BASE + LATER, BASE + LATER + 10_000_000)
    predicates = {"gold": cl.matches(qualifier="tier", value="gold"), "plus": cl.matches(qualifier="segment", value=".*-plus"),
                  "far": cl.matches(qualifier="region", value="region 2")}
    gold = F.col("gold")
    label = F.when(gold & F.col("plus"), "gold plus").when(~gold & F.col("far"), "far")
    return cl.label_rows(seen, predicates, label).select("row_key", "qualifier", "value", "label")


@query("kv_all_predicates", f"""{CELLS} SELECT row_key, qualifier, value FROM latest WHERE family = '{PROFILE}' AND row_key IN (
    SELECT row_key FROM latest GROUP BY 1 HAVING bool_or(qualifier = 'tier' AND value = 'gold')
      AND bool_or(qualifier = 'segment' AND ends_with(value, '-plus')))""")
def kv_all_predicates(t: Tables) -> DataFrame:
    family = cl.latest(customer_cells(t, whole_rows=True).where(F.col("family") == PROFILE))
    found = cl.rows_with_all(family, cl.matches(qualifier="tier", value="gold"),
                             (F.col("qualifier") == "segment") & F.col("value").endswith("-plus"))
    return found.select("row_key", "qualifier", "value")


@query("kv_render_row", f"""{CELLS}, fam AS (
      SELECT row_key, family, string_agg(qualifier || '=' || value, ',' ORDER BY qualifier) AS f FROM latest GROUP BY 1, 2)
    SELECT row_key, split_part(row_key, '#', 1) || '#... ' || string_agg(family || ':' || f, '|' ORDER BY family) AS text
    FROM fam GROUP BY 1""")
def kv_render_row(t: Tables) -> DataFrame:
    return cl.render_rows(cl.latest(customer_cells(t, whole_rows=True)))
