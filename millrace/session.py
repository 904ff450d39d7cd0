"""Session settings and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Executors get our functions by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules["millrace"])

# Settings the results depend on; all of them can be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows may carry whole documents: ten thousand of them in one batch would fill a worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # ship state deltas instead of whole snapshots on every commit
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_scratch: dict[str, str] = {}
_made: dict[str, tuple[list[str], list[str]]] = {}  # per application: scratch paths and catalog tables of this library


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_SETTINGS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def is_local(spark: SparkSession) -> bool:
    """One process runs everything; ``local-cluster`` has executors with folders of their own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings our results depend on to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if is_local(spark):
        # 200 state stores on one machine help nobody; clusters keep their own setting.
        if not spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
            spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own;
    a cluster without it is an error, since executors do not see the driver's disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(_local_scratch[app] + "/checkpoints")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; every call gives another one."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, ([], []))[0].append(path)
    return path


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new catalog table name."""
    table = f"millrace_{name}_{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, ([], []))[1].append(table)
    return table


def release_scratch(spark: SparkSession) -> int:
    """Drop the tables and intermediate results this application has made; returns how many paths were deleted.

    To be called when their results have been used: frames that read them stop working.
    """
    paths, names = _made.pop(spark.sparkContext.applicationId, ([], []))
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    deleted = 0
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        deleted += place.getFileSystem(conf).delete(place, True)
    return deleted


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a small intermediate result to the shared folder and go on from the files.

    For results that are used several times: they are computed once, survive the loss of
    executors, and bring exact sizes to the planner.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
