"""Keyed state and timers: batches per key and window, and panes with triggers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

LIST_ROWS, LIST_BYTES = 256, 64 << 10         # values that reach a state in one row; a single larger value goes alone
CHUNK_ROWS, CHUNK_BYTES = 16 << 10, 4 << 20   # rows of a task that are looked through together


def keyed_windows(stream: DataFrame, ts: str, duration: str, lateness: str = "0 seconds") -> DataFrame:
    """Watermark the stream and add the end of each row's window (epoch millis).

    The watermark lags by the allowed lateness, so that it passes a window's end only when
    the window's lateness is over.
    """
    marked = stream.withWatermark(ts, lateness)
    return marked.withColumn("window_end_ms", F.unix_millis(F.window(F.col(ts), duration)["end"]))


class BatchBuffer(StatefulProcessor):
    """Collect the values of a key and window; emit at ``size``, and the rest when the window ends.

    ``act`` turns a full or final batch into output tuples. The buffer never holds more
    than ``size`` values. Values can be structs. With ``order`` the values that come in one micro-batch are
    put in that order first. Rows of a window that is over are dropped.
    """

    def __init__(self, size: int, act: Callable[[tuple, list[Any], str], Iterator[tuple]], value_type: str,
                 columns: list[str], order: Callable[[Any], Any] | None = None):
        self.size, self.act, self.value_type, self.columns, self.order = size, act, value_type, columns, order

    def _rows(self, key, values, why) -> Iterator[Row]:
        row = Row(*self.columns)
        for fields in self.act(tuple(key), values, why):
            yield row(*fields)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", f"value {self.value_type}")
        self.count = handle.getValueState("count", "n int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if timerValues.getCurrentWatermarkInMs() >= key[-1]:
            return
        known = self.count.get()
        held = [r[0] for r in self.buffer.get()] if known is not None and known[0] else []
        if known is None:
            self.handle.registerTimer(key[-1])
        values = (value for row in rows for value in row["values"])
        for value in sorted(values, key=self.order) if self.order else values:
            held.append(value)
            if len(held) >= self.size:
                yield from self._rows(key, held, "FULL")
                held = []
        self.count.update((len(held),))
        if held:
            self.buffer.put([(v,) for v in held])
        else:
            self.buffer.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = [r[0] for r in self.buffer.get()]
        if held:
            yield from self._rows(key, held, "REST")
        self.buffer.clear()
        self.count.clear()

    def close(self) -> None:
        pass


def stateful_batches(stream: DataFrame, keys: list[str], value: str, size: int,
                     act: Callable[[tuple, list[Any], str], Iterator[tuple]], output: T.StructType,
                     order: Callable[[Any], Any] | None = None) -> DataFrame:
    """Apply :class:`BatchBuffer` per key and window; ``stream`` comes from :func:`keyed_windows`.

    All rows of a key and window pass one state, one after the other. A key that can be hot gets a shard number among ``keys``:
    the hash or remainder of something that differs between its rows, over as many shards as tasks shall share it.
    The values go to the state in lists, since a state takes its rows one by one.
    """
    value_type = stream.schema[value].dataType
    narrow = stream.select(*keys, "window_end_ms", F.col(value).alias("values"))
    fields = [*narrow.schema.fields[:-1], T.StructField("values", T.ArrayType(value_type))]
    return narrow.mapInArrow(listed, T.StructType(fields)).groupBy(*keys, "window_end_ms").transformWithState(
        statefulProcessor=BatchBuffer(size, act, value_type.simpleString(), output.names, order), outputStructType=output,
        outputMode="Append", timeMode="EventTime")


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys and a value, as rows of keys and a list of values in their order; lists and memory are bounded."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK_ROWS or sum(b.nbytes for b in held) >= CHUNK_BYTES:
            yield _lists(pa.Table.from_batches(held).combine_chunks())
            held = []
    if any(b.num_rows for b in held):
        yield _lists(pa.Table.from_batches(held).combine_chunks())


def _lists(rows: pa.Table) -> pa.RecordBatch:
    *keys, values = (c.chunk(0) for c in rows.columns)
    group = np.zeros(rows.num_rows, np.int64)
    for key in keys:
        try:
            coded = key.dictionary_encode("encode")
        except pa.ArrowNotImplementedError:  # nested keys: every row goes by itself
            group = np.arange(rows.num_rows)
            break
        group = np.unique(group * len(coded.dictionary) + coded.indices.to_numpy(), return_inverse=True)[1]
    order = np.argsort(group, kind="stable")
    values = values.take(pa.array(order))
    ends = [0, *(np.flatnonzero(np.diff(group[order])) + 1).tolist(), rows.num_rows]
    cuts = [0]
    for first, after in zip(ends, ends[1:], strict=False):
        cuts.extend(_cuts(values, first, after))
    starts = pa.array(order[cuts[:-1]])
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)
    return pa.RecordBatch.from_arrays([*(k.take(starts) for k in keys), lists], names=rows.column_names)


def _cuts(values: pa.Array, first: int, after: int) -> Iterator[int]:
    """Where the lists of a key's values end."""
    n = after - first
    if n == 1 or n <= LIST_ROWS and values.slice(first, n).nbytes <= LIST_BYTES:
        yield after
    else:
        yield from _cuts(values, first, first + n // 2)
        yield from _cuts(values, first + n // 2, after)


class PaneProcessor(StatefulProcessor):
    """Sums per key and window, fired as EARLY, ON_TIME and LATE panes.

    The input's watermark lags by ``lateness_ms``: at ``window_end - lateness`` (as the
    state sees it) the window closes, at ``window_end`` its lateness is over. Rows of a
    micro-batch are handled before its timers, so every call first fires what is due.
    """

    def __init__(self, columns: list[str], lateness_ms: int, accumulate: bool = False, count: int | None = None,
                 delay_ms: int | None = None):
        self.columns = columns
        self.lateness_ms, self.accumulate, self.count, self.delay_ms = lateness_ms, accumulate, count, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pane = handle.getValueState(
            "pane", "total long, fresh long, closed boolean, first_ms long, latest_us long, number int")

    # state tuple: total, fresh (rows since the last firing), closed, first_ms, latest_us, number of the next pane

    def _fire(self, key, state, timing):
        total, _, closed, _, latest, number = state
        out = Row(*self.columns)(*key, number, timing, total, latest)
        kept = (total if self.accumulate else 0, 0, closed, None, None if not self.accumulate else latest, number + 1)
        return out, kept

    def _due(self, key, state, watermark, now):
        """Fire what became due before the rows at hand."""
        end = key[-1]
        closing = watermark >= end - self.lateness_ms
        if state[1] > 0 and self.delay_ms is not None and now > state[3] + self.delay_ms and not (
                closing and not state[2]):
            out, state = self._fire(key, state, "LATE" if state[2] else "EARLY")
            yield out
        if closing and not state[2]:
            state = (*state[:2], True, *state[3:])
            if state[1] > 0:
                out, state = self._fire(key, state, "ON_TIME")
                yield out
        return state

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        now = timerValues.getCurrentProcessingTimeInMs() if self.delay_ms is not None else 0
        end = key[-1]
        if watermark >= end:
            return
        known = self.pane.get()
        state = (0, 0, False, None, None, 0) if known is None else tuple(known)
        if known is None:
            self._schedule(end, now)
        state = yield from self._due(key, state, watermark, now)
        total, fresh, closed, first, latest, number = state
        for row in rows:
            total += row["value"]
            fresh += row["n"]
            latest = row["ts_us"] if latest is None else max(latest, row["ts_us"])
        first = now if first is None else first
        state = (total, fresh, closed, first, latest, number)
        by_rule = self.count is not None and fresh >= self.count
        default_late = closed and self.count is None and self.delay_ms is None
        if by_rule or default_late:
            out, state = self._fire(key, state, "LATE" if closed else "EARLY")
            yield out
        self.pane.update(state)

    def _schedule(self, end: int, now: int) -> None:
        if self.delay_ms is None:
            self.handle.registerTimer(end - self.lateness_ms)
        else:
            self.handle.registerTimer(now + self.delay_ms + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.pane.get()
        if known is None:
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        now = timerValues.getCurrentProcessingTimeInMs() if self.delay_ms is not None else 0
        state = yield from self._due(key, tuple(known), watermark, now)
        if watermark >= key[-1]:
            if state[1] > 0:
                out, state = self._fire(key, state, "LATE")
                yield out
            self.pane.clear()
            return
        self.pane.update(state)
        if self.delay_ms is None:
            self.handle.registerTimer(key[-1])
        else:
            # one timer stays alive per open window; it also watches the watermark
            self.handle.registerTimer(now + max(self.delay_ms, 100))

    def close(self) -> None:
        pass


def streaming_panes(stream: DataFrame, keys: list[str], value: str, ts: str, duration: str, lateness_ms: int = 0,
                    accumulate: bool = False, count: int | None = None, delay_ms: int | None = None) -> DataFrame:
    """Panes of a stream: ``keys, window_end_ms, pane, timing, total, latest_us``.

    With a processing-time delay the query must run on a processing-time trigger.
    """
    windows = keyed_windows(stream, ts, duration, f"{lateness_ms} milliseconds")
    narrow = windows.select(*keys, "window_end_ms", F.coalesce(F.col(value).cast("bigint"), F.lit(0)).alias("value"),
                            F.unix_micros(ts).alias("ts_us"), F.lit(1).cast("bigint").alias("n"))
    group = [*keys, "window_end_ms"]

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # triggers look at a key once per micro-batch, so its rows can be added up before the shuffle
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by(group).aggregate([("value", "sum"), ("ts_us", "max"), ("n", "sum")])
            named = sums.select([*group, "value_sum", "ts_us_max", "n_sum"]).rename_columns([*group, "value", "ts_us", "n"])
            yield from named.select(batch.schema.names).to_batches()

    narrow = narrow.mapInArrow(combine, narrow.schema)
    key_fields = [T.StructField(k, stream.schema[k].dataType) for k in keys]
    output = T.StructType([
        *key_fields, T.StructField("window_end_ms", T.LongType()), T.StructField("pane", T.IntegerType()),
        T.StructField("timing", T.StringType()), T.StructField("total", T.LongType()),
        T.StructField("latest_us", T.LongType())])
    return narrow.groupBy(*keys, "window_end_ms").transformWithState(
        statefulProcessor=PaneProcessor(output.names, lateness_ms, accumulate, count, delay_ms), outputStructType=output,
        outputMode="Append", timeMode="EventTime" if delay_ms is None else "ProcessingTime")
