"""File readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import base_name


# --- writing ---------------------------------------------------------------

def write_text(lines: DataFrame, path: str, shards: int | None = None, compression: str | None = None) -> None:
    """Text files: a fixed number of shards, or as many as the data fills well."""
    out = lines.repartition(shards) if shards else lines.hint("rebalance")
    writer = out.write.mode("error")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def write_records(df: DataFrame, path: str, fmt: str = "parquet", codec: str = "snappy", mode: str = "error") -> None:
    """Typed records in a columnar or record format (``avro`` needs its package on the cluster)."""
    df.write.format(fmt).option("compression", codec).mode(mode).save(path)


def write_by_destination(df: DataFrame, path: str, columns: list[str], fmt: str = "parquet",
                         mode: str = "error", rows_per_file: int = 0) -> None:
    """One directory per value of the destination columns.

    Rebalancing by the columns keeps small destinations in one file and splits a large one
    over many tasks, which a plain repartition by them would not.
    """
    writer = df.hint("rebalance", *columns).write.format(fmt).mode(mode).partitionBy(*columns)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.save(path)


# --- reading ---------------------------------------------------------------

def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text; ``.gz`` files are read whole by one task each, so write them in shards."""
    return spark.read.text(path)


def csv_line(*columns: Column) -> Column:
    """Values as one comma-separated line; NULL is an empty field."""
    fields = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.concat_ws(",", *fields)


def csv_records(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Positional comma-separated lines as typed records; empty and missing fields are NULL."""
    parts = F.split(F.col(column), ",", -1)
    return lines.select(*[F.nullif(F.get(parts, F.lit(i)), F.lit("")).cast(f.dataType).alias(f.name)
                          for i, f in enumerate(schema.fields)])


def whole_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Every file matching a glob as ``name, content``."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select(base_name(F.col("path")).alias("name"), "content")


def hive_partitioned(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Partitioned files under an explicit schema, so that partition columns keep the type it names."""
    return spark.read.schema(schema).parquet(path)


def merged_schema(spark: SparkSession, *paths: str) -> DataFrame:
    """Files written before and after columns were added; missing ones are NULL."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def wildcard(spark: SparkSession, root: str, glob: str, suffix: str, schema: T.StructType) -> DataFrame:
    """Tables ``root/<glob>`` whose suffix after the last ``_`` matches a pattern.

    The glob limits what is listed; the pattern is applied to the file path.
    """
    rows = spark.read.schema(schema).parquet(f"{root}/{glob}").withColumn("_path", F.col("_metadata.file_path"))
    table = F.element_at(F.split(F.col("_path"), "/"), -2)
    return rows.withColumn("table_suffix", F.substring_index(table, "_", -1)).drop("_path").where(
        F.col("table_suffix").rlike(suffix))


def nested_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Newline-delimited JSON into a nested typed table.

    Values are read as text and converted: integers may be quoted, and timestamps come
    with or without a trailing zone.
    """
    wire = _text_schema(schema)
    raw = spark.read.schema(wire).json(path)
    return raw.select(*[_convert(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def _text_schema(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _text_schema(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_text_schema(dtype.elementType))
    return T.StringType()


def _convert(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        fields = F.struct(*[_convert(value[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(value.isNotNull(), fields)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _convert(x, dtype.elementType))
    if isinstance(dtype, T.TimeType):
        return F.to_time(value)
    if isinstance(dtype, T.TimestampType):
        return F.to_timestamp(F.regexp_replace(value, " UTC$", "Z"))
    return value.cast(dtype)
