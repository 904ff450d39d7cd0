"""Joins of the co-group, lookup and tiered-match kinds.

No side is hinted as broadcast: a lookup is broadcast when Spark measures it to be
below ``spark.sql.autoBroadcastJoinThreshold`` (at planning time or, by adaptive
execution, after its shuffle) and is shuffled, with skewed keys split, when it is not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import paged


def cogroup_sums(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str) -> DataFrame:
    """Sums of both sides per key, keys of either side kept.

    Both sides go through one aggregation instead of two and a full outer join.
    """
    both = left.select(key, F.col(left_value).alias("_l"), F.lit(None).alias("_r")).unionByName(
        right.select(key, F.lit(None).alias("_l"), F.col(right_value).alias("_r")))
    return both.groupBy(key).agg(
        (F.coalesce(F.sum("_l"), F.lit(0)) + F.coalesce(F.sum("_r"), F.lit(0))).alias("total"))


def cogroup_sum_times_first(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str,
                            right_order: str) -> DataFrame:
    """Sum of the left values times the first right value (1 if there is none; right-only keys give 0)."""
    order_type = right.schema[right_order].dataType
    value_type = right.schema[right_value].dataType
    both = left.select(
        key, F.col(left_value).alias("_l"), F.lit(None).cast(value_type).alias("_r"),
        F.lit(None).cast(order_type).alias("_o"),
    ).unionByName(right.select(
        key, F.lit(None).cast(left.schema[left_value].dataType).alias("_l"),
        F.col(right_value).alias("_r"), F.col(right_order).alias("_o")))
    return both.groupBy(key).agg(
        (F.coalesce(F.sum("_l"), F.lit(0)) * F.coalesce(F.min_by("_r", "_o"), F.lit(1))).alias("total"))


def cogroup_pages(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str,
                  seq: str, size: int = 1000) -> DataFrame:
    """Lists of both sides per key, cut into pages of at most ``size`` values a side.

    A side without values for a page has an empty list. ``seq`` must be unique in each side.
    """
    both = left.select(key, F.lit("l").alias("_side"), F.col(seq).alias("_seq"),
                       F.col(left_value).alias("_v")).unionByName(
        right.select(key, F.lit("r").alias("_side"), F.col(seq).alias("_seq"), F.col(right_value).alias("_v")))
    pages = paged(both, [key, "_side"], "_seq", size)

    def side(tag: str) -> Column:
        one = F.when(F.col("_side") == tag, F.struct(F.col("_seq").alias("s"), F.col("_v").alias("v")))
        return F.transform(F.array_sort(F.collect_list(one)), lambda p: p["v"])

    return pages.groupBy(key, "page").agg(side("l").alias("left_values"), side("r").alias("right_values"))


def unique_map(side: DataFrame, key: str, value: str) -> DataFrame:
    """Lookup side with one value per key; a second row for a key is an error, as in a map."""
    counted = side.groupBy(key).agg(F.any_value(value).alias(value), F.count(F.lit(1)).alias("_n"))
    checked = F.when(F.col("_n") == 1, F.col(value)).otherwise(
        F.raise_error(F.concat(F.lit("duplicate lookup key: "), F.col(key).cast("string"))).cast(
            side.schema[value].dataType))
    return counted.select(key, checked.alias(value))


def lookup_or_default(main: DataFrame, side: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """Left join with a lookup map; a missing key takes the default."""
    joined = main.join(unique_map(side, key, value), key, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), default))


def in_lookup(main: DataFrame, lookup: DataFrame, main_key: str, lookup_key: str, mode: str = "semi") -> DataFrame:
    """Membership in a lookup set: ``semi`` keeps members, ``anti`` drops them, ``flag`` marks them."""
    if mode in ("semi", "anti"):
        return main.join(lookup, main[main_key] == lookup[lookup_key], f"left_{mode}")
    if mode != "flag":
        raise ValueError(f"mode must be semi, anti or flag, not {mode}")
    keys = lookup.select(F.col(lookup_key).alias("_hit")).distinct()
    joined = main.join(keys, main[main_key] == F.col("_hit"), "left")
    return joined.withColumn("contained", F.col("_hit").isNotNull()).drop("_hit")


def with_singleton(main: DataFrame, single: DataFrame, name: str) -> DataFrame:
    """Add the one value of a one-row frame; none is an error, and so are several."""
    value = single.columns[0]
    checked = single.limit(2).agg(
        F.count(F.lit(1)).alias("_n"), F.max(value).alias("_v")).select(
        F.when(F.col("_n") == 1, F.col("_v")).otherwise(
            F.raise_error(F.lit("a singleton must have exactly one row")).cast(single.schema[value].dataType)))
    return main.withColumn(name, checked.scalar())


def with_side_set(main: DataFrame, side: DataFrame, value: str, name: str, max_values: int = 10_000) -> DataFrame:
    """Add the sorted distinct values of a small side to every row.

    At most ``max_values + 1`` values are ever gathered; a larger side is an error, never
    a shortened list. Test membership in a large side with :func:`in_lookup`.
    """
    some = side.select(value).distinct().limit(max_values + 1)
    listed = some.agg(F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list(value)).alias("_list")).select(
        F.when(F.col("_n") <= max_values, F.col("_list")).otherwise(
            F.raise_error(F.lit(f"side list has more than {max_values} values"))
            .cast(f"array<{side.schema[value].dataType.simpleString()}>")))
    return main.withColumn(name, listed.scalar())


def schema_join(left: DataFrame, right: DataFrame, using: list[str]) -> DataFrame:
    """Inner join on equal column names; the result nests both rows as ``lhs`` and ``rhs``."""
    l = left.select(*using, F.struct(*left.columns).alias("lhs"))
    r = right.select(*using, F.struct(*right.columns).alias("rhs"))
    return l.join(r, using, "inner").select("lhs", "rhs")


def tiered_match(left: DataFrame, right: DataFrame, partial_keys: list[str], tier_key: str, value: str) -> DataFrame:
    """Match on all keys, else on the partial keys, else not at all (tier 1, 2 or NULL).

    An exact match returns every matching right row; a partial one the right row with the
    largest tier key and then the largest value. The best partial row is found before the
    join, so rows sharing partial keys are never paired with each other.
    """
    exact = right.select(*partial_keys, tier_key, F.col(value).alias("_exact"), F.lit(1).alias("_one"))
    best = right.groupBy(*partial_keys).agg(
        F.max(F.struct(F.col(tier_key), F.col(value))).alias("_best"))
    joined = left.join(exact, [*partial_keys, tier_key], "left").join(best, partial_keys, "left")
    tier = F.when(F.col("_one") == 1, 1).when(F.col("_best").isNotNull(), 2)
    matched = F.when(F.col("_one") == 1, F.col("_exact")).otherwise(F.col(f"_best.{value}"))
    return joined.select(*left.columns, tier.alias("tier"), matched.alias(value))


def enrich_with_last(main: DataFrame, service: DataFrame, main_key: str, service_key: str, value: str, order: str,
                     unknown: str = "UNKNOWN") -> DataFrame:
    """Last value a lookup service holds for a key, or ``unknown``."""
    last = service.groupBy(F.col(service_key).alias("_k")).agg(F.max_by(value, order).alias("_last"))
    joined = main.join(last, main[main_key] == F.col("_k"), "left").drop("_k")
    return joined.withColumn(value, F.coalesce(F.col("_last"), F.lit(unknown))).drop("_last")


def call_in_batches(df: DataFrame, size: int, connect: Callable[[], Any], call: Callable[[Any, pd.DataFrame], pd.DataFrame],
                    schema: str) -> DataFrame:
    """Enrich rows by an outside service, asked for up to ``size`` rows at a time.

    The client is made once per task and closed at its end. For a service that is a table,
    use a join.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = connect()
        try:
            for batch in batches:
                for start in range(0, len(batch), size):
                    yield call(client, batch.iloc[start:start + size])
        finally:
            if hasattr(client, "close"):
                client.close()

    return df.mapInPandas(run, schema)
