"""From raw documents to training shards.

``STAGES`` lists what happens in order; each stage takes the documents that the one before has kept and all but the last
return documents in the same columns. Every stage is written to the shared folder and read again, so that a lost executor
costs at most one stage and no plan spans two of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, mixing, near, quality, sharding
from millrace.llm.common import table
from millrace.session import prepare, stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the policy. The ledger is stored first: the rules are evaluated once, the policy reads their bits."""
    entries = stored(quality.ledger(docs, policy="v2"), "ledger")
    judged = quality.apply_policy(entries, "v2")
    return judged.filter("kept").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near.deduplicate(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, not even with other numbers, names or units."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it."""
    return sharding.shard(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("mix", mix_sources),
    ("shards", into_shards),
]

# the stages use seeded hashes, sketches and a heap: tests compare them with plain versions instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
