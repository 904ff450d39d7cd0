"""Registry of queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.temporal import event_time
from millrace.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @property
    def events(self) -> DataFrame:
        """Events with ``ts`` as an instant."""
        return self("events").withColumn("ts", event_time(F.col("ts")))


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under a name."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(prepare(spark), sf_dir.rstrip("/")))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def money(column: str):
    """Two-decimal amounts as exact numbers, so that sums do not depend on their order."""
    return F.col(column).cast("decimal(18,2)")


def cents(column: str):
    return (money(column) * 100).cast("bigint")


def stamp(column):
    """Timestamps as text, to the second."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
