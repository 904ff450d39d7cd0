"""Reading files as a stream and running a stream to its end."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.query import StreamingQuery

from millrace.session import scratch_path

END_OF_TIME = "2999-12-31 00:00:00"


def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_step: int | None = None) -> DataFrame:
    """A parquet file or folder as a stream."""
    # a file stream lists globs; one that matches only the path itself covers file and folder alike
    pattern = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if files_per_step:
        reader = reader.option("maxFilesPerTrigger", files_per_step)
    return reader.parquet(pattern)


def closing_heartbeat(stream: DataFrame, ts: str) -> tuple[DataFrame, Callable[[], None]]:
    """A replay that can be closed: the stream with a second, still empty source, and what lands the closing row there.

    The row lies far in the future and is NULL in all columns but the event time. It must come when all input has been
    processed, in however many micro-batches; ``run_to_table(..., close=...)`` does that. A live stream needs none.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, "heartbeat")
    row = heartbeat(stream, ts)
    pattern = f"{path[:-1]}[{path[-1]}]"  # a glob may match nothing yet
    return stream.unionByName(spark.readStream.schema(row.schema).parquet(pattern)), lambda: row.write.parquet(path)


def run_to_table(stream: DataFrame, name: str, partition_by: list[str] | None = None,
                 mode: str = "append", close: Callable[[], None] | None = None) -> DataFrame:
    """Process all available input into files with exactly-once commits, and read them back.

    With ``close`` the input is drained first; then the closing row lands and the flow runs once more on its state.
    """
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    writer = (stream.writeStream.format("parquet").outputMode(mode).option("path", out)
              .option("checkpointLocation", scratch_path(spark, f"{name}-progress")).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()
    if close:
        close()
        writer.start().awaitTermination()
    return spark.read.schema(_nullable(stream.schema)).parquet(out)


def run_some_batches(stream: DataFrame, name: str, batches: int, seconds: float | None = None) -> DataFrame:
    """Run an endless stream until that many micro-batches are committed, and read the files back.

    ``seconds`` is a stop condition of the caller's; without one the stream runs as long as its batches take.
    """
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    _until_batch(spark, stream.writeStream.format("parquet").option("path", out), name, batches, seconds)
    return spark.read.schema(_nullable(stream.schema)).parquet(out)


def draw_some_batches(stream: DataFrame, draw: Callable[[DataFrame], DataFrame], name: str, batches: int, seconds: float | None = None) -> DataFrame:
    """``run_some_batches`` for a stream that draws from tables: what ``draw`` makes of each micro-batch is kept.

    ``draw`` gets an ordinary frame, so it can look at the rows at hand and read no more of a table than they need. A
    micro-batch that is repeated replaces its first try.
    """
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    _until_batch(spark, stream.writeStream.foreachBatch(
        lambda rows, batch: draw(rows).write.mode("overwrite").parquet(f"{out}/batch={batch}")), name, batches, seconds)
    # a micro-batch that was under way at the stop does not count
    return spark.read.option("basePath", out).parquet(*[f"{out}/batch={n}" for n in range(batches)]).drop("batch")


def _until_batch(spark: SparkSession, writer: DataStreamWriter, name: str, batches: int, seconds: float | None) -> None:
    """Run until that many micro-batches are committed."""
    query = (writer.option("checkpointLocation", scratch_path(spark, f"{name}-progress"))
             .trigger(processingTime="0 seconds").start())
    deadline = time.monotonic() + seconds if seconds else None
    try:
        while (query.lastProgress or {}).get("batchId", -1) < batches - 1:
            if deadline and time.monotonic() > deadline:
                raise TimeoutError(f"{name}: fewer than {batches} batches in {seconds} s")
            if query.awaitTermination(0.1):
                break
    finally:
        query.stop()


def run_in_steps(steps: list[DataFrame], flow: Callable[[DataFrame], DataFrame], name: str,
                 ended: Callable[[str], None] | None = None) -> DataFrame:
    """Deliver frames one after the other to a flow that remembers its state in between.

    Each step is written to the landing folder and processed as one micro-batch, the way a
    job does that is started every so often for what has come in since. ``ended`` is told the id of each run that has ended.
    """
    spark = steps[0].sparkSession
    landing, out, progress = (scratch_path(spark, f"{name}-{part}") for part in ("landing", "out", "progress"))
    schema = _nullable(steps[0].schema)
    for rows in steps:
        rows.write.mode("append").parquet(landing)
        result = flow(spark.readStream.schema(schema).parquet(landing))
        query = (result.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        if ended:
            ended(query.runId)
    return spark.read.schema(_nullable(result.schema)).parquet(out)


def run_on_the_clock(steps: list[DataFrame], flow: Callable[[DataFrame], DataFrame], name: str, settle_ms: int,
                     seconds: float = 300) -> DataFrame:
    """Deliver frames one after the other to a flow with processing-time timers.

    The query runs on its own clock. A delivery is one micro-batch; the next one comes when the query has gone on for
    ``settle_ms`` of processing time, so that timers of less than half of that have fired. A delivery that is not processed
    within ``seconds`` is an error. Empty deliveries are left out.
    """
    spark = steps[0].sparkSession
    landing, out, progress = (scratch_path(spark, f"{name}-{part}") for part in ("landing", "out", "progress"))
    schema, result = _nullable(steps[0].schema), None
    for rows in steps:
        if rows.isEmpty():
            continue
        # the query is down while files land: it never sees a part of a delivery
        rows.write.mode("append").parquet(landing)
        result = flow(spark.readStream.schema(schema).parquet(landing))
        query = (result.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
                 .trigger(processingTime="0 seconds").start())
        deadline, settled = time.monotonic() + seconds, None
        try:
            while True:
                last = query.lastProgress
                if last and settled is None and any(p["numInputRows"] for p in query.recentProgress):
                    settled = time.time() + settle_ms / 1000
                if last and settled and _started(last) > settled:
                    break
                if time.monotonic() > deadline:
                    raise TimeoutError(f"{name}: a delivery was not processed in {seconds} s")
                if query.awaitTermination(0.05):
                    break
        finally:
            query.stop()
    if result is None:  # nothing came at all
        steps[0].write.mode("append").parquet(landing)
        return spark.createDataFrame([], flow(spark.readStream.schema(schema).parquet(landing)).schema)
    return spark.read.schema(_nullable(result.schema)).parquet(out)


def _started(progress) -> float:
    """The processing time at which a micro-batch began."""
    return datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")).timestamp()


def heartbeat(like: DataFrame, ts: str) -> DataFrame:
    """One row far in the future, NULL but for the event time."""
    return like.sparkSession.range(1).select(*[
        (F.lit(END_OF_TIME) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in like.schema.fields])


def run_each_batch(stream: DataFrame, name: str, write: Callable[[DataFrame, int], None],
                   every: str | None = None) -> StreamingQuery:
    """Hand every micro-batch to ``write(rows, batch_id)``; ``write`` must allow a batch to be repeated.

    Without ``every`` the available input is processed and the call returns; with it
    (such as ``"1 minute"``) the query returned keeps loading periodically until the caller stops it.
    """
    spark = stream.sparkSession
    writer = stream.writeStream.foreachBatch(write).option(
        "checkpointLocation", scratch_path(spark, f"{name}-progress"))
    if every:
        return writer.trigger(processingTime=every).queryName(name).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
