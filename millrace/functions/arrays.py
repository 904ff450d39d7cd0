"""Array functions, as columns and as SQL functions for use in views."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def array_sum(values: Column) -> Column:
    """Sum of the elements; NULLs are skipped, and no elements give NULL."""
    present = F.filter(values, lambda x: x.isNotNull())
    return F.when(F.size(present) > 0, F.aggregate(present, F.lit(0).cast("bigint"), lambda acc, x: acc + x))


def even_numbers(values: Column) -> Column:
    """Even elements in order; none give NULL."""
    even = F.filter(values, lambda x: x % 2 == 0)
    return F.when(F.size(even) > 0, even)


def register_array_functions(spark: SparkSession) -> None:
    """The same two as temporary SQL functions ``my_sum`` and ``my_even_numbers``."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION my_sum(arr ARRAY<BIGINT>) RETURNS BIGINT
        RETURN CASE WHEN exists(arr, x -> x IS NOT NULL)
                    THEN aggregate(filter(arr, x -> x IS NOT NULL), 0L, (acc, x) -> acc + x) END""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION my_even_numbers(arr ARRAY<BIGINT>) RETURNS ARRAY<BIGINT>
        RETURN CASE WHEN exists(arr, x -> x % 2 = 0) THEN filter(arr, x -> x % 2 = 0) END""")
