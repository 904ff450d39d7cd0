"""Shards of near equal size by longest-processing-time scheduling; rows that belong together stay together.

Groups go in order of size, the largest first, each to the shard with the fewest bytes so far, which a heap keeps. What
passes the heap is bounded, whatever the table: a group of at least ``1 / HEAVY`` of all bytes goes by itself (at most
``HEAVY`` groups can be that large); all other groups are put by hash into ``COARSE + FINE`` bundles, of which the fine
ones share one sixteenth of the groups. Bundles are scheduled like groups; the fine ones come last and even out the rest.

Slots number a shard's rows from 0 without gaps: rows are dealt by hash into blocks of about ``ROWS_PER_BLOCK``, numbered
within the block and moved by the rows of the blocks before. A group of any size is spread over all blocks of its shard.

Defined cases: null texts are one group, apart from empty ones; a shard can be empty if there are fewer groups than
shards; repeated rows get a slot each, in any order among themselves. Groups whose 64-bit hashes agree would stay together.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import free_name, without
from millrace.session import stored

HEAVY = 1024
COARSE, FINE = 2048, 2048
ROWS_PER_BLOCK = 50_000


def group_hash(text: str) -> Column:
    return F.xxhash64(F.col(text).isNull(), text)


def bundle_of(group: Column) -> Column:
    """The bundle of a light group: one in sixteen goes to a fine one."""
    fine = F.pmod(F.xxhash64(group, F.lit(1)), F.lit(16)) == 0
    place = F.xxhash64(group, F.lit(2))
    return F.when(fine, COARSE + F.pmod(place, F.lit(FINE))).otherwise(F.pmod(place, F.lit(COARSE))).cast("int")


def longest_first(sizes: list[tuple[int, tuple]], shards: int) -> list[tuple[tuple, int]]:
    """``(size, name)`` in order of size, each to the least loaded shard; ties by name and by shard number."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for size, name in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        out.append((name, shard))
        heapq.heappush(heap, (load + size, shard))
    return out


def assignments(sizes: DataFrame, shards: int) -> DataFrame:
    """``sizes(group, size)`` as ``(heavy, bundle, shard)``: at most ``HEAVY`` heavy groups and all bundles, one of the two null.

    ``group`` is a hash and may come in several rows.
    """
    spark = sizes.sparkSession
    groups = stored(sizes.groupBy("group").agg(F.sum("size").alias("size")), "shard-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    heavy = F.col("size") * HEAVY >= total
    units = groups.groupBy(F.when(heavy, F.col("group")).alias("heavy"), F.when(~heavy, bundle_of(F.col("group"))).alias("bundle")) \
        .agg(F.sum("size").alias("size"))
    # bounded: HEAVY groups and COARSE + FINE bundles at most
    rows = [(r["size"], (r["heavy"] is None, r["heavy"] or 0, r["bundle"] or 0)) for r in units.collect()]
    placed = [(None if light else h, b if light else None, s) for (light, h, b), s in longest_first(rows, shards)]
    return spark.createDataFrame(placed, "heavy bigint, bundle int, shard int")


def shard(docs: DataFrame, shards: int = 8, text: str = "text", order: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot``; equal texts share a shard. Existing columns of these names are replaced."""
    docs = without(docs, ["shard", "slot"])
    names = {n: free_name(docs, n) for n in ("shard_group", "shard_bundle", "shard_block", "shard_rank", "shard_row", "shard_before", "shard_size")}
    group, bundle, block, rank, row = (names[n] for n in ("shard_group", "shard_bundle", "shard_block", "shard_rank", "shard_row"))
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1
    placed = assignments(docs.select(group_hash(text).alias("group"), size.alias("size")), shards)
    heavy = placed.filter("heavy is not null").select(F.col("heavy").alias("of_heavy"), F.col("shard").alias("shard_heavy"))
    light = placed.filter("heavy is null").select(F.col("bundle").alias("of_bundle"), F.col("shard").alias("shard_light"))
    keyed = docs.withColumn(group, group_hash(text)).withColumn(bundle, bundle_of(F.col(group)))
    # both tables are bounded by the constants above
    found = (keyed.join(F.broadcast(heavy), F.col(group) == F.col("of_heavy"), "left")
             .join(F.broadcast(light), F.col(bundle) == F.col("of_bundle"), "left")
             .withColumn("shard", F.coalesce("shard_heavy", "shard_light"))
             .drop("of_heavy", "of_bundle", "shard_heavy", "shard_light", bundle))
    return with_slots(found, F.col(group), order, block, rank).drop(group)


def with_slots(placed: DataFrame, group: Column, order: str, block: str = "shard_block", rank: str = "shard_rank") -> DataFrame:
    """``placed`` with a gapless ``slot`` within ``shard``."""
    dealt = F.xxhash64(F.col(order).isNull(), order, group)
    counted = placed.select("shard", dealt.alias("h"))
    total = counted.count()
    blocks = max(1, -(-total // ROWS_PER_BLOCK))
    of_block = F.pmod(dealt, F.lit(blocks)).cast("int")
    sizes = counted.groupBy("shard", F.pmod(F.col("h"), F.lit(blocks)).cast("int").alias(block)).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col("shard").alias("__shard"), F.col(block).alias("__block"), before.alias("__before"))
    numbered = placed.withColumn(block, of_block).withColumn(
        rank, F.row_number().over(Window.partitionBy("shard", block).orderBy(F.col(order), group)))
    return (numbered.join(offsets, (F.col("shard") == F.col("__shard")) & (F.col(block) == F.col("__block")))
            .withColumn("slot", (F.col("__before") + F.col(rank) - 1).cast("long")).drop("__shard", "__block", "__before", block, rank))
