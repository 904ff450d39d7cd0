"""Catalog tables: dispositions, routing, external tables, small DML."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.records import typed_record


def load_table(df: DataFrame, name: str, path: str, write: str = "append", create: bool = True,
               fmt: str = "parquet") -> None:
    """Load rows into a table: ``append`` or ``truncate``; without ``create`` it must exist."""
    spark = df.sparkSession
    if not create and not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist")
    mode = {"append": "append", "truncate": "overwrite"}[write]
    df.write.format(fmt).mode(mode).option("path", path).saveAsTable(name)


def write_routes(routes: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Append every routed frame to a location of its own below ``root``; returns the locations."""
    paths = {name: f"{root}/{name}" for name in routes}
    for name, rows in routes.items():
        rows.write.mode("append").parquet(paths[name])
    return paths


def write_by_type(df: DataFrame, type_column: str, json: str, schemas: dict[str, T.StructType], root: str) -> dict[str, DataFrame]:
    """Records routed by the type they name, parsed by its schema and written in one pass; one table per type comes back.

    Every type has a struct column of its own and a directory of its own; the columns of other types are NULL there and take no
    space. A type without a schema is an error.
    """
    known = F.when(F.col(type_column).isin(list(schemas)), F.col(type_column)).otherwise(
        F.raise_error(F.concat(F.lit("no schema for type "), F.coalesce(type_column, F.lit("NULL")))).cast("string"))
    records = [F.when(F.col("type") == name, typed_record(F.when(F.col("type") == name, F.col(json)), schema)).alias(name) for name, schema in schemas.items()]
    df.withColumn("type", known).select("type", *records).write.partitionBy("type").parquet(root)
    stored = df.sparkSession.read.schema(T.StructType([T.StructField(n, s) for n, s in schemas.items()] + [T.StructField("type", T.StringType())])).parquet(root)
    return {name: stored.where(F.col("type") == name).select(name) for name in schemas}


def external_table(spark: SparkSession, name: str, path: str, schema: str | None = None,
                   fmt: str = "parquet") -> DataFrame:
    """Table over existing files, with an explicit schema or that of the files."""
    columns = f"({schema})" if schema else ""
    spark.sql(f"CREATE TABLE {name} {columns} USING {fmt} LOCATION '{path}'")
    return spark.table(name)


def refresh(spark: SparkSession, name: str) -> DataFrame:
    """Forget the cached file listing and look again."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def delete_where(df: DataFrame, condition: Column, path: str) -> None:
    """Row delete on plain files: write what stays to a new place (NULL conditions stay)."""
    df.where(~F.coalesce(condition, F.lit(False))).write.mode("error").parquet(path)


DATE = r"\d{4}-\d{2}-\d{2}"


def checked(name: str, value: str, pattern: str) -> str:
    """A run-time parameter that must match a pattern as a whole."""
    if re.fullmatch(pattern, value) is None:
        raise ValueError(f"{name}={value!r} does not match {pattern}")
    return value


def sql_with_parameters(spark: SparkSession, sql: str, args: dict, **frames: DataFrame) -> DataFrame:
    """Query text with bound values (``:name``) and frames (``{name}``)."""
    return spark.sql(sql, args=args, **frames)
