"""Keyed and global aggregation."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def global_sum(df: DataFrame, value: Column, name: str = "total") -> DataFrame:
    """One row; an empty input sums to 0."""
    return df.agg(F.coalesce(F.sum(value), F.lit(0)).alias(name))


def global_combine(df: DataFrame, *aggregates: Column) -> DataFrame:
    """Global aggregates without defaults: an empty input gives no row."""
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *aggregates)
    return counted.where(F.col("_n") > 0).drop("_n")


def count_per(df: DataFrame, *keys: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_per(df: DataFrame, keys: list[str], value: Column, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def sum_of_list(values: Column) -> Column:
    """Sum of an already grouped list; an empty list sums to 0."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows; each task keeps ``n`` rows, so the sort is never global."""
    return df.orderBy(*order).limit(n)


def sorted_set(value: Column) -> Column:
    """Aggregate: distinct values in order (combined before the shuffle), for groups with few of them; see ``ranking.set_pages``."""
    return F.sort_array(F.collect_set(value))


def salted_sum(df: DataFrame, keys: list[str], value: Column, salt: Column, name: str = "total") -> DataFrame:
    """Sum in two levels: by key and salt, then by key.

    Batch plans combine before the shuffle anyway; the first level matters where
    that is not so, as in a stream whose hot key would meet a single state store.
    """
    first = df.groupBy(*keys, salt.alias("_salt")).agg(F.sum(value).alias("_part"))
    return first.groupBy(*keys).agg(F.sum("_part").alias(name))


class CombineFn:
    """A user-defined aggregate: an accumulator that can be filled and merged anywhere.

    Use it for work that has no built-in aggregate; built-ins are much faster.
    """

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, acc: Any, value: Any) -> Any:
        raise NotImplementedError

    def merge(self, left: Any, right: Any) -> Any:
        raise NotImplementedError

    def extract(self, acc: Any) -> Any:
        return acc


def combine_per_key(df: DataFrame, key: str, value: str, fn: CombineFn, result: str, name: str = "result",
                    max_open_keys: int = 50_000, fan_in: int = 32) -> DataFrame:
    """Apply a :class:`CombineFn` per key in three steps.

    Tasks fill accumulators before the shuffle, holding at most ``max_open_keys`` at a
    time; accumulators of a key are merged in ``fan_in`` groups and then once more, each
    time batch by batch, so a hot key is neither shuffled raw nor gathered whole.
    """
    key_type = df.schema[key].dataType.simpleString()
    partial_schema = f"`{key}` {key_type}, _acc binary"

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_keys: dict[Any, Any] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({key: list(open_keys), "_acc": [pickle.dumps(a) for a in open_keys.values()]})
            open_keys.clear()
            return out

        for batch in batches:
            for k, v in zip(batch[key], batch[value]):
                acc = open_keys[k] if k in open_keys else fn.create()
                open_keys[k] = fn.add(acc, v)
                if len(open_keys) >= max_open_keys:
                    yield flush()
        if open_keys:
            yield flush()

    def merged(batches: Iterator[pd.DataFrame]) -> Any:
        acc = fn.create()
        for batch in batches:
            for blob in batch["_acc"]:
                acc = fn.merge(acc, pickle.loads(blob))
        return acc

    def merge_some(group: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({key: [group[0]], "_acc": [pickle.dumps(merged(batches))]})

    def merge_all(group: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({key: [group[0]], name: [fn.extract(merged(batches))]})

    partial = df.select(key, value).mapInPandas(fill, partial_schema)
    spread = partial.withColumn("_group", F.pmod(F.xxhash64("_acc"), F.lit(fan_in)))
    some = spread.groupBy(key, "_group").applyInPandas(merge_some, partial_schema)
    return some.groupBy(key).applyInPandas(merge_all, f"`{key}` {key_type}, {name} {result}")
