"""Wide-column rows kept as a long table of cells.

``row_key STRING, family STRING, qualifier STRING, ts_micros BIGINT, value STRING``
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import full_match

CELLS_PER_TASK = 500_000
CELL_COLUMNS = ["row_key", "family", "qualifier", "ts_micros", "value"]


def cell(family: str, qualifier: str, ts_micros: Column, value: Column) -> Column:
    """One cell as a struct, for :func:`unpivot`."""
    return F.struct(F.lit(family).alias("family"), F.lit(qualifier).alias("qualifier"),
                    ts_micros.alias("ts_micros"), value.alias("value"))


def unpivot(df: DataFrame, row_key: Column, cells: list[Column], whole_rows: bool = False) -> DataFrame:
    """Turn typed rows into cells in one pass; cells without a value are not written.

    With ``whole_rows`` the typed rows, which are narrow, are first dealt out by row key over as many tasks as keep the cells of each
    to a bounded number. What follows per row or cell (:func:`latest`, :func:`render_rows`) then needs no other exchange.
    """
    keyed = df.withColumn("_row_key", row_key)
    if whole_rows:
        parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() * len(cells) / CELLS_PER_TASK))
        keyed = keyed.repartition(parts, "_row_key")
    return keyed.select(F.col("_row_key").alias("row_key"), F.explode(F.array(*cells)).alias("c")).select(
        "row_key", "c.*").where(F.col("value").isNotNull())


def key_range(cells: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Rows with ``start <= row_key < end``; both bounds reach the scan."""
    rows = cells.where(F.col("row_key") >= start)
    return rows if end is None else rows.where(F.col("row_key") < end)


def key_prefix(cells: DataFrame, prefix: str) -> DataFrame:
    """Rows whose key starts with a prefix."""
    return cells.where(F.col("row_key").startswith(prefix))


def latest(cells: DataFrame, by_row: bool = False) -> DataFrame:
    """Newest version of every cell.

    ``by_row`` deals whole rows out at once, so that what follows per row (:func:`label_rows`) needs no exchange of its own;
    otherwise versions are combined before the exchange.
    """
    if by_row:
        cells = cells.repartition("row_key")
    return cells.groupBy("row_key", "family", "qualifier").agg(
        F.max("ts_micros").alias("ts_micros"), F.max_by("value", "ts_micros").alias("value"))


def time_range(cells: DataFrame, start_micros: int, end_micros: int) -> DataFrame:
    """Versions with ``start <= ts < end``."""
    return cells.where((F.col("ts_micros") >= start_micros) & (F.col("ts_micros") < end_micros))


def matches(family: str | None = None, qualifier: str | None = None, value: str | None = None) -> Column:
    """Chained cell predicate: every given pattern must match its whole text."""
    condition = F.lit(True)
    for column, pattern in (("family", family), ("qualifier", qualifier), ("value", value)):
        if pattern is not None:
            condition = condition & full_match(F.col(column), pattern)
    return condition


def rows_with(cells: DataFrame, predicate: Column) -> DataFrame:
    """All cells of the rows in which some cell satisfies the predicate."""
    hits = cells.where(predicate).select(F.col("row_key").alias("_k")).distinct()
    return cells.join(hits, F.col("row_key") == F.col("_k"), "left_semi")


def rows_with_all(cells: DataFrame, *predicates: Column) -> DataFrame:
    """All cells of the rows in which every predicate is satisfied by some cell."""
    flags = [F.bool_or(p).alias(f"_p{i}") for i, p in enumerate(predicates)]
    keys = cells.groupBy(F.col("row_key").alias("_k")).agg(*flags)
    for i in range(len(predicates)):
        keys = keys.where(F.col(f"_p{i}"))
    return cells.join(keys, F.col("row_key") == F.col("_k"), "left_semi")


def label_rows(cells: DataFrame, predicates: dict[str, Column], label: Column) -> DataFrame:
    """Label whole rows by which predicates some cell of theirs satisfies.

    ``label`` is an expression over the boolean columns named in ``predicates``; rows it is
    NULL for are dropped.
    """
    whole_row = Window.partitionBy("row_key")
    flagged = cells.withColumns({name: F.bool_or(p).over(whole_row) for name, p in predicates.items()})
    return flagged.withColumn("label", label).where(F.col("label").isNotNull()).select(*cells.columns, "label")


def render_rows(cells: DataFrame, name: str = "text") -> DataFrame:
    """A row as ``prefix#... family:col=v,col=v|family:...``; versions are joined by ``;``.

    Meant for cells already cut down to a fixed set of columns.
    """
    columns = cells.groupBy("row_key", "family", "qualifier").agg(
        F.array_join(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("ts_micros", "value")))),
                                 lambda v: v["value"]), ";").alias("_v"))
    families = columns.groupBy("row_key", "family").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "qualifier", "_v"))), ",").alias("_f"))
    rows = families.groupBy("row_key").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "family", "_f"))), "|").alias("_r"))
    prefix = F.substring_index("row_key", "#", 1)
    return rows.select("row_key", F.concat(prefix, F.lit("#... "), F.col("_r")).alias(name))


def write_sorted(cells: DataFrame, path: str) -> None:
    """Store cells in key order: file and row-group statistics then serve key ranges."""
    ordered = cells.repartitionByRange("row_key").sortWithinPartitions("row_key", "family", "qualifier")
    ordered.write.mode("append").parquet(path)
