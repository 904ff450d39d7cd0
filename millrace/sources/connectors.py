"""Options of external connectors; their jars come with the cluster, so formats are only named here."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def kafka_options(servers: str, topics: str | None = None, partitions: dict[str, list[int]] | None = None,
                  group_id: str | None = None, read_committed: bool = True, headers: bool = True,
                  security: dict[str, str] | None = None, **extra: str) -> dict[str, str]:
    """Source options: topics by name or explicit partitions, committed rows only, headers kept.

    ``security`` holds consumer properties such as ``security.protocol`` or
    ``sasl.jaas.config``; each is passed on with the connector's ``kafka.`` prefix.
    """
    if (topics is None) == (partitions is None):
        raise ValueError("give either topics or partitions")
    options = {"kafka.bootstrap.servers": servers, "includeHeaders": str(headers).lower()}
    if topics is not None:
        options["subscribe"] = topics
    else:
        options["assign"] = json.dumps(partitions)
    if group_id:
        options["kafka.group.id"] = group_id
    if read_committed:
        options["kafka.isolation.level"] = "read_committed"
    for key, value in (security or {}).items():
        options[f"kafka.{key}"] = value
    return {**options, **extra}


def kafka_stream(spark: SparkSession, options: dict[str, str], fmt: str = "kafka") -> DataFrame:
    return spark.readStream.format(fmt).options(**options).load()


def kafka_batch(spark: SparkSession, options: dict[str, str], max_records: int | None = None, fmt: str = "kafka") -> DataFrame:
    """Bounded read; ``max_records`` stops after that many."""
    rows = spark.read.format(fmt).options(**options).load()
    return rows if max_records is None else rows.limit(max_records)


def kafka_messages(records: DataFrame) -> DataFrame:
    """Records as messages; missing headers become an empty map."""
    headers = F.coalesce(F.col("headers"), F.array())
    return records.select(
        F.col("value").alias("payload"),
        F.map_from_entries(F.transform(headers, lambda h: F.struct(
            h["key"].alias("key"), F.decode(h["value"], "UTF-8").alias("value")))).alias("attrs"),
        F.concat_ws("-", "topic", "partition", "offset").alias("msg_id"))


def bus_writer(messages: DataFrame, fmt: str, checkpoint: str, **options: str) -> DataStreamWriter:
    """Unstarted writer of messages to a bus: value and headers, and key, topic and partition where there are such columns."""
    entries = F.transform(F.map_entries("attrs"), lambda e: F.struct(
        e["key"].alias("key"), F.encode(e["value"], "UTF-8").alias("value")))
    more = [c for c in ("key", "topic", "partition") if c in messages.columns]
    rows = messages.select(F.col("payload").alias("value"), entries.alias("headers"), *more)
    return rows.writeStream.format(fmt).option("checkpointLocation", checkpoint).options(**options)


def console_writer(rows: DataFrame, lines: int = 20) -> DataStreamWriter:
    return rows.writeStream.format("console").option("numRows", lines).option("truncate", "false")
