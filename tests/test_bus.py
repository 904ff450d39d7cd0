"""The file-backed bus: offsets, replay of micro-batches, slices, refusals."""

import json
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.sources import bus
from millrace.sources.connectors import bus_writer, kafka_batch, kafka_messages


def batch(*rows):
    return pa.RecordBatch.from_pylist([{"key": k, "value": v} for k, v in rows], pa.schema([("key", pa.binary()), ("value", pa.binary())]))


def values(path, topic="t"):
    """Values by partition, in order of their offsets."""
    reader, out = bus.BusReader({"path": path, "subscribe": topic}), {}
    for part in reader.partitions():
        for rows in reader.read(part):
            for r in rows.to_pylist():
                out.setdefault(r["partition"], []).append((r["offset"], r["value"]))
    assert all([o for o, _ in v] == list(range(len(v))) for v in out.values())
    return {p: [x for _, x in v] for p, v in out.items()}


def test_a_batch_that_is_repeated_is_there_once(tmp_path):
    path = str(tmp_path / "bus")
    writer = bus.Writer({"path": path, "topic": "t", "partitions": "2"})
    writer.publish([writer.write(iter([batch((None, b"a"), (None, b"b"))]))], "0")
    # the commit of batch 1 dies after its moves are written down and one of them is made
    first = writer.write(iter([batch((None, b"c"), (None, b"d"))]))
    move, calls = bus.pafs.LocalFileSystem.move, []

    class Dying(bus.Store):
        def __init__(self, where):
            super().__init__(where)
            fs = self.fs

            class Files:
                def __getattr__(self, name):
                    return getattr(fs, name)

                def move(self, a, b):
                    calls.append(b)
                    if "_staged" in a and sum("/t/" in c for c in calls) == 2:
                        raise OSError("lost")
                    move(fs, a, b)
            self.fs = Files()

    real, bus.Store = bus.Store, Dying
    try:
        with pytest.raises(OSError):
            writer.publish([first], "1")
    finally:
        bus.Store = real
    assert sum(len(v) for v in values(path).values()) == 3
    again = writer.write(iter([batch((None, b"c"), (None, b"d"))]))
    writer.publish([again, None], "1")
    writer.publish([], "1")
    assert values(path) == {0: [b"a", b"c"], 1: [b"b", b"d"]}
    assert bus.Store(path).names("_staged") == []
    lost = writer.write(iter([batch((None, b"x"))]))
    writer.discard([lost])
    assert bus.Store(path).names("_staged") == []


def test_keys_partitions_and_topics(tmp_path):
    writer = bus.Writer({"path": str(tmp_path), "topic": "t", "partitions": "8"})
    for n in range(3):
        writer.publish([writer.write(iter([batch((b"k", b"%d" % n), (b"other", b"x"))]))], str(n))
    place = zlib.crc32(b"k") % 8
    assert [v for v in values(str(tmp_path))[place] if v != b"x"] == [b"0", b"1", b"2"]
    with pytest.raises(ValueError):
        bus.Writer({"path": str(tmp_path)}).write(iter([batch((None, b"no topic"))]))
    with pytest.raises(ValueError):
        bus.BusReader({"path": str(tmp_path)})
    with pytest.raises(ValueError):
        bus.BusReader({"path": str(tmp_path), "subscribe": "t", "assign": "{}"})


def test_slices_start_and_end_where_they_are_told(tmp_path):
    path = str(tmp_path)
    writer = bus.Writer({"path": path, "topic": "t"})
    for n in range(4):
        writer.publish([writer.write(iter([batch(*[(b"", b"%d" % (10 * n + i)) for i in range(10)])]))], str(n))

    def read(**options):
        reader = bus.BusReader({"path": path, "subscribe": "t", "rowsPerTask": "7", **options})
        return [int(r["value"]) for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]

    assert read() == list(range(40)) and len(bus.BusReader({"path": path, "subscribe": "t", "rowsPerTask": "7"}).partitions()) == 6
    assert read(startingOffsets='{"t/0": 12}', endingOffsets='{"t/0": 31}') == list(range(12, 31))
    assert read(startingOffsets="latest") == [] and read(subscribe="missing") == []
    store = bus.Store(path)
    store.fs.delete_file(f"{store.root}/{store.segments('t', 0)[1][2]}")
    with pytest.raises(RuntimeError):
        read()


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    fmt, path = bus.register(spark), str(tmp_path / "bus")
    source, sent, read, out = (str(tmp_path / n) for n in ("source", "sent", "read", "out"))
    schema = "payload BINARY, attrs MAP<STRING,STRING>, key BINARY"

    def step(lo, hi):
        rows = spark.range(lo, hi).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("payload"),
                                          F.create_map(F.lit("n"), F.col("id").cast("string")).alias("attrs"), F.lit(b"k").alias("key"))
        rows.write.mode("append").parquet(source)
        writer = bus_writer(spark.readStream.schema(schema).parquet(source), fmt, sent, path=path, topic="t", partitions="3")
        writer.trigger(availableNow=True).start().awaitTermination()
        stream = kafka_messages(spark.readStream.format(fmt).options(path=path, subscribe="t", group="g", rowsPerTask="4").load())
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", read).trigger(availableNow=True).start().awaitTermination()
        return sorted((int(r.payload), r.attrs["n"]) for r in spark.read.parquet(out).collect())

    assert step(0, 10) == [(n, str(n)) for n in range(10)]
    assert step(10, 15) == [(n, str(n)) for n in range(15)]
    committed = json.loads(bus.Store(path).get("_groups/g.json"))
    assert sum(committed.values()) in (10, 15) and len({k for k, v in committed.items() if v}) == 1  # one key, one partition
    options = {"path": path, "subscribe": "t"}
    assert kafka_batch(spark, options, fmt=fmt).count() == 15 and kafka_batch(spark, options, max_records=2, fmt=fmt).count() == 2
    # batch writes append too
    kafka_batch(spark, options, fmt=fmt).select("key", "value", "headers").write.format(fmt).mode("append").options(path=path, topic="copy").save()
    copied = kafka_batch(spark, {"path": path, "subscribe": "copy"}, fmt=fmt)
    assert copied.select("value", "headers").exceptAll(kafka_batch(spark, options, fmt=fmt).select("value", "headers")).count() == 0 and copied.count() == 15
    with pytest.raises(Exception, match="appended"):
        copied.write.format(fmt).mode("overwrite").options(path=scratch_path(spark, "no"), topic="t").save()


def test_a_slice_reads_its_row_groups_only(tmp_path, monkeypatch):
    """Small batches make large row groups; a slice skips those of other slices."""
    options = {"path": str(tmp_path), "topic": "t", "subscribe": "t"}
    batches = [pa.RecordBatch.from_pydict({"value": [b"%d" % n for n in range(at, at + 100)], "partition": pa.array([n % 2 for n in range(100)], pa.int32())})
               for at in range(0, 24_000, 100)]
    writer = bus.BusWriter(options)
    writer.commit([writer.write(iter(batches))])
    store = bus.Store(str(tmp_path))
    assert store.ends({"t": None}) == {"t/0": 12_000, "t/1": 12_000}
    [(_, _, name)] = store.segments("t", 1)
    assert [pq.read_metadata(f"{tmp_path}/{name}").row_group(g).num_rows for g in range(3)] == [5000, 5000, 2000]
    read, one = [], bus.Reader._of_group
    monkeypatch.setattr(bus.Reader, "_of_group", lambda self, file, group, *rest: read.append(group) or one(self, file, group, *rest))
    out = pa.Table.from_batches(list(bus.BusReader(options).read(bus.Slice("t", 1, 4990, 5010))))
    assert read == [0, 1] and out["offset"].to_pylist() == list(range(4990, 5010))
    assert out["value"].to_pylist() == [b"%d" % (2 * n + 1) for n in range(4990, 5010)]
    assert pa.Table.from_batches(list(bus.BusReader(options).read(bus.Slice("t", 1, 10_000, 12_000))))["offset"].to_pylist() == list(range(10_000, 12_000))
    assert read == [0, 1, 2]
