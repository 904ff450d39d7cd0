"""Exact ranks and bounded lists that stay parallel inside one hot key.

A plain ``row_number`` sorts a whole key in one task, and ``collect_list`` puts a
whole key into one row. Here a key is cut into blocks of a unique, ordered number:
rows are ranked inside their block, and a running sum of the (few) block counts
gives the rank of the block's first row. The cuts are quantiles of that number, so
they follow the data and not the spacing of its ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import stored

MOST_BLOCKS = 512


def cuts_of(df: DataFrame, seq: str, blocks: int | None = None) -> list[int]:
    """Values of ``seq`` that cut ``df`` into about equal parts, as many as there are shuffle partitions (at most ``MOST_BLOCKS``).

    One pass with a mergeable sketch; one row comes to the driver.
    """
    blocks = blocks or min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_BLOCKS)
    shares = [i / blocks for i in range(1, blocks)]
    if not shares:
        return []
    return sorted(set(df.agg(F.percentile_approx(seq, shares, 10 * blocks)).first()[0] or []))


def block_of(value: Column, cuts: list[int], first: int = 0) -> Column:
    """How many cuts are at or below the value, by halving."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(value < cuts[mid], block_of(value, cuts[:mid], first)).otherwise(block_of(value, cuts[mid + 1:], first + mid + 1))


def ranked(df: DataFrame, keys: list[str], seq: str, name: str = "rn", blocks: int | None = None) -> DataFrame:
    """Add the 1-based rank of each row within ``keys`` in the order of ``seq``, a unique integer column.

    A key has at most as many blocks as there are cuts and a block at most about that share of all rows, whatever the size
    of the key and the spacing of the numbers.
    """
    return _ranked_in_blocks(df, keys, seq, block_of(F.col(seq), cuts_of(df, seq, blocks)), name)


def _ranked_in_blocks(df: DataFrame, keys: list[str], order: str, block: Column, name: str) -> DataFrame:
    """Ranks within ``keys``, where a larger ``block`` holds larger values of ``order``."""
    # One struct column stands for key and block: window, counts and join then share a single
    # exchange of the rows, and NULL keys compare as equal.
    blocked = df.withColumn("_group", F.struct(*keys, block.alias("_block")))
    rows = blocked.withColumn("_in_block", F.row_number().over(W.partitionBy("_group").orderBy(order)))

    counts = blocked.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.partitionBy(*[f"_group.{k}" for k in keys]).orderBy("_group._block").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_group", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return rows.join(offsets, "_group", "inner").select(
        *df.columns, (F.col("_before") + F.col("_in_block")).alias(name))


def paged(df: DataFrame, keys: list[str], seq: str, size: int, name: str = "page", blocks: int | None = None) -> DataFrame:
    """Add the 0-based page of each row: ``size`` consecutive rows of a key share a page."""
    with_rank = ranked(df, keys, seq, "_rn", blocks)
    return with_rank.withColumn(name, F.expr(f"(_rn - 1) div {size}")).drop("_rn")


def in_order(value: Column, seq: str) -> Column:
    """Aggregate: the values of a group as an array in the order of ``seq``."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), value.alias("v"))))
    return F.transform(pairs, lambda p: p["v"])


def value_pages(df: DataFrame, keys: list[str], value: Column, seq: str, size: int = 1000,
                name: str = "values") -> DataFrame:
    """Group values by key as lists of at most ``size``: one row per key and page.

    A key with up to ``size`` values has exactly one row (page 0); a larger one
    has as many as it needs, so no value is lost and no row grows with the data.
    """
    narrow = df.select(*keys, F.col(seq).alias("_seq"), value.alias("_value"))
    pages = paged(narrow, keys, "_seq", size)
    return pages.groupBy(*keys, "page").agg(in_order(F.col("_value"), "_seq").alias(name))


def set_pages(df: DataFrame, keys: list[str], value: Column, size: int = 1000, name: str = "values") -> DataFrame:
    """The sorted distinct values of each key as lists of at most ``size``: one row per key and page.

    For groups of any size and values of any type with an order: values become distinct before they move, an exchange by ranges of
    key and value cuts large keys over tasks, and the counts of the ranges give the place of each. NULL is not a value.
    The ranges are drawn from a sample, so they are written once and read by both sides.
    """
    distinct = df.select(*keys, value.alias("_value")).where(F.col("_value").isNotNull()).distinct()
    ranges = distinct.repartitionByRange(*keys, "_value").withColumn("_range", F.spark_partition_id())
    placed = _ranked_in_blocks(stored(ranges, "set-ranges"), keys, "_value", F.col("_range"), "_rn")
    pages = placed.withColumn("page", F.expr(f"(_rn - 1) div {size}"))
    return pages.groupBy(*keys, "page").agg(F.sort_array(F.collect_list("_value")).alias(name))


def running_max(df: DataFrame, order: str, value: str, name: str, span: int) -> DataFrame:
    """Largest ``value`` of all rows with a strictly smaller ``order`` (NULL for the first).

    ``df`` holds one row per integer ``order``. Two levels (blocks of ``span``, then
    rows inside a block) keep the global order from running in a single task.
    """
    blocked = df.withColumn("_block", F.expr(f"{order} div {span}"))
    tops = blocked.groupBy("_block").agg(F.max(value).alias("_top"))
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    tops = tops.select(F.col("_block").alias("_b"), F.max("_top").over(earlier).alias("_before"))
    inside = W.partitionBy("_block").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    rows = blocked.withColumn("_inside", F.max(value).over(inside))
    joined = rows.join(tops, F.col("_block") == F.col("_b"), "inner")
    return joined.select(*df.columns, F.greatest("_before", "_inside").alias(name))
