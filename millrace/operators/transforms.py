"""Element-wise steps: mapping, exploding, keying, routing, dead letters, metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


# --- mapping ---------------------------------------------------------------

def map_partitions_with_setup(df: DataFrame, setup: Callable[[], object],
                              process: Callable[[object, pd.DataFrame], pd.DataFrame], schema: str,
                              teardown: Callable[[object], None] | None = None) -> DataFrame:
    """Run ``process(resource, batch)`` with the resource built once per task, and closed at its end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        try:
            for batch in batches:
                yield process(resource, batch)
        finally:
            if teardown is not None:
                teardown(resource)

    return df.mapInPandas(run, schema)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal narrow rows out by keys ahead of a step that makes and unpacks whole documents from them.

    A number of partitions is given, at least one for each core, since adaptive execution would merge partitions that are small
    in bytes and not in work.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *keys)


def flatten_lists(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per element of an array column; empty and NULL arrays give none."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(column).alias(name))


# --- keys ------------------------------------------------------------------

def bucket_key(value: Column, limits: list[tuple[int, str]], other: str) -> Column:
    """Name of the first limit the value is below, else ``other``."""
    chain = None
    for limit, name in limits:
        chain = F.when(value < limit, name) if chain is None else chain.when(value < limit, name)
    return chain.otherwise(other)


# The skewed key table, 70 % US.
COUNTRIES = ["US", "US", "PL", "US", "MT", "US", "US", "PL", "US", "US"]


def skewed_key(number: Column, table: list[str] = COUNTRIES) -> Column:
    """Key picked from a table by ``number`` modulo its size."""
    return F.element_at(F.array(*[F.lit(k) for k in table]), (number % len(table) + 1).cast("int"))


# --- several outputs -------------------------------------------------------

def route(df: DataFrame, rules: dict[str, Column]) -> dict[str, DataFrame]:
    """One DataFrame per name, holding the rows its condition is true for.

    A row may go to several outputs or to none. Conditions stay filters, so each
    output pushes its own down to the scan.
    """
    return {name: df.where(condition) for name, condition in rules.items()}


def tagged(df: DataFrame, rules: dict[str, Column], name: str = "output") -> DataFrame:
    """Every row once per output it belongs to, with the output's name: several outputs from one pass.

    For outputs that are aggregated or written together (``groupBy(name)``, ``partitionBy(name)``).
    """
    names = F.array_compact(F.array(*[F.when(condition, F.lit(output)) for output, condition in rules.items()]))
    return df.withColumn(name, F.explode(names))


def odd_even_rules(number: str) -> dict[str, Column]:
    """Even and odd numbers; the remainder keeps its sign, so negative odd numbers go nowhere."""
    return {"even": F.col(number) % 2 == 0, "odd": F.col(number) % 2 == 1}


def odd_even(df: DataFrame, number: str) -> dict[str, DataFrame]:
    """:func:`odd_even_rules` as two DataFrames."""
    return route(df, odd_even_rules(number))


def checked_index(index: Column, count: int) -> Column:
    """The index; one outside 0..count-1 is an error."""
    return F.when((index >= 0) & (index < count), index).otherwise(
        F.raise_error(F.concat(F.lit("partition index out of range: "), index.cast("string"))).cast("int"))


def partition_by_index(df: DataFrame, index: Column, count: int) -> list[DataFrame]:
    """``count`` DataFrames by an index expression."""
    indexed = df.withColumn("_part", checked_index(index, count))
    return [indexed.where(F.col("_part") == i).drop("_part") for i in range(count)]


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union of frames with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- dead letters ----------------------------------------------------------

def attempted(df: DataFrame, raw: Column, parsed: Column, name: str, reason: str, error: str = "error") -> DataFrame:
    """``df`` with the parsed value and, where there is none, an error message: good rows and dead letters in one pass.

    ``parsed`` must be NULL on failure (``try_`` functions); a NULL input is not a failure
    of parsing and is a dead letter too, with its own message.
    """
    message = F.when(raw.isNull(), F.lit("null input")).otherwise(F.concat(F.lit(reason), F.lit('"'), raw, F.lit('"')))
    return df.withColumn(name, parsed).withColumn(error, F.when(F.col(name).isNull(), message))


def with_dead_letters(df: DataFrame, raw: Column, parsed: Column, name: str,
                      reason: str) -> tuple[DataFrame, DataFrame]:
    """:func:`attempted` as two DataFrames, the rows that parsed and the dead letters ``(raw, error)``."""
    tried = attempted(df, raw, parsed, name, reason, "_error")
    good = tried.where(F.col("_error").isNull()).drop("_error")
    return good, tried.where(F.col("_error").isNotNull()).select(raw.alias("raw"), F.col("_error").alias("error"))


# --- metrics ---------------------------------------------------------------

def observed(df: DataFrame, name: str, value: str) -> tuple[DataFrame, Observation]:
    """Counter and distribution of ``value``, gathered while the frame is used."""
    observation = Observation(name)
    v = F.col(value)
    return df.observe(
        observation, F.count(F.lit(1)).alias("rows"), F.count(v).alias("count"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.sum(v).alias("sum")), observation


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition: how evenly the work is spread."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))
