"""Asking outside services: one call per batch of requests, several calls under way in a task, retries and time limits."""

from __future__ import annotations

import time
from bisect import bisect_left, bisect_right
from collections import OrderedDict, deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from concurrent.futures import TimeoutError as Overdue
from threading import Lock
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Call = Callable[[Any, list[dict]], list[Any]]
ROW_GROUP = 256 << 10  # bytes of a row group in files that are looked up by key
ROWS_OUT = 1000        # answers that leave a task together, of however many calls


class Caller:
    """Calls of one task. At most ``in_flight`` batches are under way; their answers come in the order of the batches."""

    def __init__(self, connect: Callable[[], Any], call: Call, in_flight: int, attempts: int, seconds: float, pause: float):
        self.client, self.call = connect(), call
        self.in_flight, self.attempts, self.seconds, self.pause = in_flight, attempts, seconds, pause
        # a call that is overdue keeps its thread until it returns, so every attempt may need one of its own
        self.pool = ThreadPoolExecutor(in_flight * attempts)

    def _begin(self, requests: list[dict], wait: float = 0) -> Future:
        def work():
            if wait:
                time.sleep(wait)
            return self.call(self.client, requests)
        return self.pool.submit(work)

    def _end(self, requests: list[dict], future: Future) -> tuple[list[Any], str | None, int]:
        """Answers or an error, and how many attempts it took."""
        error = ""
        for attempt in range(1, self.attempts + 1):
            wait = 0.0 if attempt == 1 else self.pause * 2 ** (attempt - 2)
            try:
                answers = future.result(self.seconds + wait)
                if len(answers) != len(requests):
                    raise ValueError(f"{len(answers)} answers to {len(requests)} requests")
                return list(answers), None, attempt
            except Overdue:
                error = f"no answer in {self.seconds} s"
            except Exception as problem:  # whatever a service says is data of the dead letter
                error = f"{type(problem).__name__}: {problem}"
            if attempt < self.attempts:
                future = self._begin(requests, self.pause * 2 ** (attempt - 1))
        return [None] * len(requests), error, self.attempts

    def run(self, batches: Iterator[list[dict]]) -> Iterator[tuple[list[dict], list[Any], str | None, int]]:
        waiting: deque[tuple[list[dict], Future]] = deque()
        for requests in batches:
            if len(waiting) >= self.in_flight:
                first, future = waiting.popleft()
                yield (first, *self._end(first, future))
            waiting.append((requests, self._begin(requests)))
        while waiting:
            first, future = waiting.popleft()
            yield (first, *self._end(first, future))

    def close(self) -> None:
        self.pool.shutdown(wait=False, cancel_futures=True)
        if hasattr(self.client, "close"):
            self.client.close()


def call_per_batch(batches: DataFrame, requests: str, connect: Callable[[], Any], call: Call, answer: T.DataType, in_flight: int = 4, attempts: int = 3,
                   seconds: float = 30, pause: float = 0.1) -> DataFrame:
    """Ask a service once for every row of ``batches``, whose column ``requests`` is a list of structs.

    Returns a row per request: its fields, ``answer``, ``error`` (null if answered) and ``attempts`` of its call. A call that fails or takes more
    than ``seconds`` is repeated after a growing pause; what fails to the last comes with its error, so nothing is lost and no batch stops
    the others. The client is made once per task and used by several threads. A task that runs again asks again: calls must be
    repeatable. Works on streams too. For a service that is a table, use a join.
    """
    item = batches.schema[requests].dataType.elementType
    output = T.StructType([*item.fields, T.StructField("answer", answer), T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType())])
    names = item.names

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caller, done = None, []

        def rows(kinds: pa.StructType) -> pa.RecordBatch:
            asked = [r for requests, *_ in done for r in requests]
            columns = [pa.array([r[n] for r in asked], kinds.field(n).type) for n in names]
            answers = pa.array([a for _, given, _, _ in done for a in given], reply)
            errors = pa.array([error for requests, _, error, _ in done for _ in requests], pa.string())
            tries = pa.array([tries for requests, _, _, tries in done for _ in requests], pa.int32())
            return pa.RecordBatch.from_arrays([*columns, answers, errors, tries], names=output.names)

        try:
            for part in parts:
                caller = caller or Caller(connect, call, in_flight, attempts, seconds, pause)
                given, kinds = part.column(0), part.schema.field(0).type.value_type
                lists, held = _requests(given), 0
                for ended in caller.run(lists):
                    done.append(ended)
                    held += len(ended[0])
                    if held >= ROWS_OUT:
                        yield rows(kinds)
                        done, held = [], 0
                if done:
                    yield rows(kinds)
                    done = []
        finally:
            if caller:
                caller.close()

    from pyspark.sql.pandas.types import to_arrow_type
    reply = to_arrow_type(answer)
    return batches.select(requests).mapInArrow(work, output)


def _requests(given: pa.ListArray) -> Iterator[list[dict]]:
    """The lists that are neither null nor empty, taken apart column by column."""
    items = given.flatten()
    if items.null_count:
        rows = items.to_pylist()
    else:
        names = [f.name for f in items.type]
        rows = [dict(zip(names, values, strict=True)) for values in zip(*(c.to_pylist() for c in items.flatten()), strict=True)]
    end = 0
    for n in pc.list_value_length(given).to_pylist():
        if n:
            end += n
            yield rows[end - n:end]


class KeyedFiles:
    """A look-up service over Parquet files that are sorted by key, in small row groups (:func:`write_keyed_files`).

    The footers are read once. A call reads the row groups that hold its keys, at most one per key whatever the size of the files; those
    used last stay in memory, up to ``held`` bytes.
    """

    def __init__(self, path: str, key: str, value: str, held: int = 64 << 20):
        self.fs, root = pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)
        self.key, self.value, self.most = key, value, held
        self.files: dict[str, pq.ParquetFile] = {}
        self.kept: OrderedDict[int, tuple[Any, pa.Array, int]] = OrderedDict()  # keys, values and bytes of row groups
        self.size, self.lock = 0, Lock()
        groups = [g for i in self.fs.get_file_info(pafs.FileSelector(root)) if i.base_name.endswith(".parquet") for g in self._groups(i.path)]
        self.groups = sorted(groups, key=lambda g: g[0])
        self.firsts = [g[0] for g in self.groups]
        self.kind = next((f.schema_arrow.field(key).type for f in self.files.values()), None)

    def _file(self, path: str) -> pq.ParquetFile:
        if path not in self.files:
            self.files[path] = pq.ParquetFile(self.fs.open_input_file(path))
        return self.files[path]

    def _groups(self, path: str) -> Iterator[tuple[Any, Any, str, int]]:
        """First and last key, file and number of each row group."""
        file = self._file(path)
        column = file.schema_arrow.get_field_index(self.key)
        for n in range(file.num_row_groups):
            known = file.metadata.row_group(n).column(column).statistics
            if known is not None and known.has_min_max:
                yield known.min, known.max, path, n
            else:
                keys = file.read_row_group(n, [self.key])[self.key]
                yield keys[0].as_py(), keys[-1].as_py(), path, n

    def _rows(self, n: int) -> tuple[Any, pa.Array, int]:
        """Keys and values of a row group, and its bytes."""
        found = self.kept.get(n)
        if found is None:
            with self.lock:
                found = self.kept.get(n) or self._read(n)
        return found

    def _read(self, n: int) -> tuple[Any, pa.Array, int]:
        _, _, path, group = self.groups[n]
        rows = self._file(path).read_row_group(group, [self.key, self.value])
        found = self.kept[n] = rows[self.key].to_numpy(), rows[self.value].combine_chunks(), rows.nbytes
        self.size += rows.nbytes
        while self.size > self.most and len(self.kept) > 1:
            self.size -= self.kept.popitem(last=False)[1][2]
        return found

    def ask(self, keys: list[Any]) -> list[Any]:
        """The value of each key, None for unknown ones."""
        wanted = sorted({k for k in keys if k is not None})
        if not wanted or not self.groups:
            return [None] * len(keys)
        # every step outside the interpreter would hand it to another call under way, so only keys that need it are converted
        alike = pa.array(wanted, self.kind).to_numpy(zero_copy_only=False) if pa.types.is_temporal(self.kind) else wanted
        values, used, have, given = {}, [-1], None, None
        for k, typed in zip(wanted, alike, strict=True):
            n = bisect_right(self.firsts, k) - 1
            if n < 0 or k > self.groups[n][1]:
                continue
            if n != used[-1]:  # in order of the keys, so a row group comes once
                used.append(n)
                have, given, _ = self._rows(n)
            at = bisect_left(have, typed)
            if have[at] == typed:
                values[k] = given[at].as_py()
        with self.lock:  # once a call, not at each key: calls of several threads would wait for each other
            for n in used:
                if n in self.kept:
                    self.kept.move_to_end(n)
        return [values.get(k) for k in keys]

    def close(self) -> None:
        """Not the files: a call that is overdue may still read them."""
        self.kept = OrderedDict()


def write_keyed_files(df: DataFrame, key: str, value: str, path: str) -> None:
    """One value per key (an error otherwise), sorted by key, in row groups small enough to be read for a single key."""
    once = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first(value).alias(value))
    checked = F.when(F.col("n") == 1, F.col(value)).otherwise(F.raise_error(F.lit("a key has several values")).cast(df.schema[value].dataType))
    once.select(key, checked.alias(value)).repartitionByRange(key).sortWithinPartitions(key).write.option("parquet.block.size", ROW_GROUP).parquet(path)
