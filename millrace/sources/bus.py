"""A message bus over files: topics with partitions and offsets, as a streaming and batch source and sink.

``spark.dataSource.register(LandingBus)`` (or ``register``) adds the format ``landing_bus``. Its rows have the columns of a Kafka
source (``key, value, headers, topic, partition, offset, timestamp``), so flows written for one run on the other.

Below ``path`` a topic is a folder, a partition a folder in it, and a segment one immutable Parquet file whose name says which
offsets it holds. A write stages files in its tasks; only the commit on the driver gives them offsets. It first writes down all
moves of its micro-batch, then makes them: a micro-batch that is repeated after a crash finishes the moves of its first try and throws
its own files away, so every message is there once. Readers see moved segments only. One writer at a time may write to a topic.

Offsets of a read are kept by Spark per partition; a hot partition is split into slices of ``rowsPerTask`` offsets. With ``group`` the
offsets a query has finished are also written below ``path`` for others to see. Any path that pyarrow can reach from all executors will do.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage,
)

FORMAT = "landing_bus"
SCHEMA = ("key BINARY, value BINARY, headers ARRAY<STRUCT<key: STRING, value: BINARY>>, topic STRING, partition INT, offset BIGINT, "
          "timestamp TIMESTAMP")
STORED = pa.schema([("key", pa.binary()), ("value", pa.binary()),
                    ("headers", pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())]))), ("timestamp", pa.timestamp("us", tz="UTC"))])
ROWS_PER_TASK = 100_000
GROUP_ROWS, GROUP_BYTES = 5_000, 8 << 20  # a row group ends when it has that many rows or bytes


def register(spark: SparkSession) -> str:
    """Make the format known to a session; returns its name."""
    spark.dataSource.register(LandingBus)
    return FORMAT


class Store:
    """The files of a bus."""

    def __init__(self, path: str):
        self.fs, self.root = pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)

    def names(self, folder: str) -> list[str]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{folder}", allow_not_found=True))
        return sorted(i.base_name for i in found)

    def exists(self, name: str) -> bool:
        return self.fs.get_file_info(f"{self.root}/{name}").type == pafs.FileType.File

    def put(self, name: str, text: str) -> None:
        """A small file that is there as a whole or not at all."""
        self.fs.create_dir(f"{self.root}/{name.rpartition('/')[0]}", recursive=True)
        hidden = f"{self.root}/{name}.{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(hidden) as out:
            out.write(text.encode())
        self.fs.move(hidden, f"{self.root}/{name}")

    def get(self, name: str) -> str:
        with self.fs.open_input_stream(f"{self.root}/{name}") as f:
            return f.read().decode()

    def topics(self) -> list[str]:
        return [n for n in self.names("") if not n.startswith("_")]

    def partitions(self, topic: str) -> list[int]:
        return sorted(int(n) for n in self.names(topic))

    def segments(self, topic: str, partition: int) -> list[tuple[int, int, str]]:
        """First offset, offset after the last, name; in order."""
        out = []
        for name in self.names(f"{topic}/{partition}"):
            if name.endswith(".parquet"):
                first, after = name.split(".")[0].split("-")[:2]
                out.append((int(first), int(after), f"{topic}/{partition}/{name}"))
        return sorted(out)

    def end(self, topic: str, partition: int) -> int:
        return max((after for _, after, _ in self.segments(topic, partition)), default=0)

    def ends(self, wanted: dict[str, list[int] | None]) -> dict[str, int]:
        """The end of every partition wanted, by ``topic/partition``; all partitions where none are named."""
        return {f"{topic}/{p}": self.end(topic, p) for topic, chosen in wanted.items()
                for p in (self.partitions(topic) if chosen is None else chosen)}


class Slice(InputPartition):
    """A range of offsets of one partition."""

    def __init__(self, topic: str, partition: int, first: int, after: int):
        super().__init__((topic, partition, first, after))
        self.topic, self.partition, self.first, self.after = topic, partition, first, after


def slices(start: dict[str, int], end: dict[str, int], rows: int) -> list[Slice]:
    out = []
    for name, after in sorted(end.items()):
        topic, _, partition = name.rpartition("/")
        for first in range(start.get(name, 0), after, rows):
            out.append(Slice(topic, int(partition), first, min(first + rows, after)))
    return out


class Reader:
    """What the batch and the streaming reader share."""

    def __init__(self, options):
        self.path, self.rows = options["path"], int(options.get("rowsPerTask", ROWS_PER_TASK))
        subscribe, assign = options.get("subscribe"), options.get("assign")
        if (subscribe is None) == (assign is None):
            raise ValueError("give either subscribe or assign")
        self.wanted = json.loads(assign) if assign else {t.strip(): None for t in subscribe.split(",")}
        self.starting, self.group = options.get("startingOffsets", "earliest"), options.get("group")

    def first(self) -> dict[str, int]:
        ends = Store(self.path).ends(self.wanted)
        if self.starting == "latest":
            return ends
        if self.starting == "earliest":
            return dict.fromkeys(ends, 0)
        return {**dict.fromkeys(ends, 0), **json.loads(self.starting)}

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        store = Store(self.path)
        at = partition.first
        for first, after, name in store.segments(partition.topic, partition.partition):
            if after <= partition.first or first >= partition.after:
                continue
            if first > at:
                break
            with store.fs.open_input_file(f"{store.root}/{name}") as f:
                file = pq.ParquetFile(f)
                for group in range(file.num_row_groups):
                    rows = file.metadata.row_group(group).num_rows
                    if first < partition.after and first + rows > partition.first:  # others are not read
                        yield from self._of_group(file, group, first, partition)
                    first += rows
            at = after
        if at < partition.after:
            raise RuntimeError(f"offsets {at} to {partition.after} of {partition.topic}/{partition.partition} are gone")

    def _of_group(self, file: pq.ParquetFile, group: int, first: int, partition: Slice) -> Iterator[pa.RecordBatch]:
        """What a slice wants of a row group that begins at offset ``first``."""
        for batch in file.iter_batches(batch_size=10_000, row_groups=[group]):
            lo, hi = max(partition.first - first, 0), min(partition.after - first, len(batch))
            if lo < hi:
                part, n = batch.slice(lo, hi - lo), hi - lo
                yield pa.RecordBatch.from_arrays(
                    [part["key"], part["value"], part["headers"], pa.array([partition.topic] * n), pa.array([partition.partition] * n, pa.int32()),
                     pa.array(range(first + lo, first + hi), pa.int64()), part["timestamp"]],
                    names=["key", "value", "headers", "topic", "partition", "offset", "timestamp"])
            first += len(batch)


class BusReader(Reader, DataSourceReader):
    """All offsets there are when the read is planned, or up to ``endingOffsets``."""

    def __init__(self, options):
        super().__init__(options)
        self.ending = options.get("endingOffsets", "latest")

    def partitions(self) -> list[Slice]:
        ends = Store(self.path).ends(self.wanted)
        if self.ending != "latest":
            limits = json.loads(self.ending)
            ends = {n: min(e, limits.get(n, e)) for n, e in ends.items()}
        return slices(self.first(), ends, self.rows) or [Slice(next(iter(self.wanted), ""), 0, 0, 0)]


class BusStreamReader(Reader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return self.first()

    def latestOffset(self) -> dict:
        return Store(self.path).ends(self.wanted)

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return slices(start, end, self.rows)

    def commit(self, end: dict) -> None:
        if self.group:
            store, name = Store(self.path), f"_groups/{self.group}.json"
            if store.exists(name):
                store.fs.delete_file(f"{store.root}/{name}")
            store.put(name, json.dumps(end))


class Staged(WriterCommitMessage):
    """Files of one task: ``(topic, partition, staged name, rows)``."""

    def __init__(self, files: list[tuple[str, int, str, int]]):
        self.files = files


class Segment:
    """A staged file. Rows are gathered into row groups large enough to read well and small enough for a slice to skip the others."""

    def __init__(self, store: Store, name: str):
        self.name, self.rows, self.held = name, 0, []
        self.writer = pq.ParquetWriter(store.fs.open_output_stream(f"{store.root}/{name}"), STORED)

    def add(self, rows: pa.Table) -> None:
        self.held.append(rows)
        self.rows += len(rows)
        if sum(map(len, self.held)) >= GROUP_ROWS or sum(t.nbytes for t in self.held) >= GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.writer.write_table(pa.concat_tables(self.held))
            self.held = []

    def close(self) -> None:
        self.flush()
        self.writer.close()


class Writer:
    """What the batch and the streaming writer share."""

    def __init__(self, options):
        self.path, self.topic, self.count = options["path"], options.get("topic"), int(options.get("partitions", 1))
        self.name = options.get("writer", "writer")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, open_, token = Store(self.path), {}, uuid.uuid4().hex
        store.fs.create_dir(f"{store.root}/_staged", recursive=True)
        now = int(time.time() * 1e6)
        for batch in iterator:
            n, have = len(batch), batch.schema.names
            keys = (batch["key"] if "key" in have else pa.nulls(n, pa.binary())).cast(pa.binary())
            topics = (batch["topic"] if "topic" in have else pa.array([self.topic] * n, pa.string())).dictionary_encode()
            rows = pa.Table.from_arrays([
                keys, batch["value"].cast(pa.binary()),
                batch["headers"].cast(STORED.field("headers").type) if "headers" in have else pa.nulls(n, STORED.field("headers").type),
                batch["timestamp"].cast(STORED.field("timestamp").type) if "timestamp" in have else pa.array([now] * n, STORED.field("timestamp").type)],
                schema=STORED)
            codes = topics.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            target = self._target(batch["partition"] if "partition" in have else pa.nulls(n, pa.int32()), keys)
            pairs, which = np.unique(np.stack([codes, target]), axis=1, return_inverse=True)
            for i, (code, to) in enumerate(pairs.T.tolist()):
                place = (topics.dictionary[code].as_py() if code >= 0 else None, to)
                if place[0] is None or "/" in place[0] or place[0].startswith("_"):
                    raise ValueError(f"{place[0]!r} is no topic")
                if place not in open_:
                    open_[place] = Segment(store, f"_staged/{token}-{len(open_)}.parquet")
                open_[place].add(rows.take(np.flatnonzero(which.ravel() == i)))
        for segment in open_.values():
            segment.close()
        return Staged([(*place, segment.name, segment.rows) for place, segment in open_.items()])

    def _target(self, given: pa.Array, keys: pa.Array) -> np.ndarray:
        """The partition of each row: as given, or by its key; without both a task deals its rows in turn."""
        if given.null_count == 0:
            return given.to_numpy(zero_copy_only=False).astype(np.int64)
        return np.array([p if p is not None else (zlib.crc32(k) if k is not None else i) % self.count
                         for i, (p, k) in enumerate(zip(given.to_pylist(), keys.to_pylist(), strict=True))], np.int64)

    def publish(self, messages: list[Staged | None], batch: str) -> None:
        store, manifest = Store(self.path), f"_commits/{self.name}/{batch}.json"
        staged = sorted(f for m in messages if m is not None for f in m.files)
        if store.exists(manifest):  # this batch was being published before: that try counts
            moves = json.loads(store.get(manifest))
            self.discard(messages)
        else:
            moves, ends = [], {}
            for topic, partition, name, rows in staged:
                place = (topic, partition)
                first = ends[place] if place in ends else store.end(*place)
                ends[place] = first + rows
                moves.append([name, f"{topic}/{partition}/{first:020d}-{first + rows:020d}-{self.name}-{batch}.parquet"])
            store.put(manifest, json.dumps(moves))
        for name, place in moves:
            if store.exists(name):
                store.fs.create_dir(f"{store.root}/{place.rpartition('/')[0]}", recursive=True)
                store.fs.move(f"{store.root}/{name}", f"{store.root}/{place}")

    def discard(self, messages: list[Staged | None]) -> None:
        store = Store(self.path)
        for m in messages:
            for _, _, name, _ in m.files if m is not None else []:
                if store.exists(name):
                    store.fs.delete_file(f"{store.root}/{name}")


class BusWriter(Writer, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self.publish(messages, uuid.uuid4().hex)

    def abort(self, messages) -> None:
        self.discard(messages)


class BusStreamWriter(Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self.publish(messages, f"{batchId:020d}")

    def abort(self, messages, batchId: int) -> None:
        self.discard(messages)


class LandingBus(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BusReader:
        return BusReader(self.options)

    def streamReader(self, schema) -> BusStreamReader:
        return BusStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> BusWriter:
        if overwrite:
            raise ValueError("messages can only be appended")
        return BusWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> BusStreamWriter:
        return BusStreamWriter(self.options)
