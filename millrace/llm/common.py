"""What several operators share: words, word hashes, local bindings in column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text, runs of anything but ASCII white space; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, names) -> DataFrame:
    """``df`` without columns that an operator is about to write (compared without regard to case)."""
    lost = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lost])


def if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` marked for broadcasting if it has at most ``rows`` (narrow) rows; otherwise the planner shuffles it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    z = values + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash per window of ``size`` consecutive word hashes: a polynomial, put together from halves."""
    if len(hashes) < size:
        return np.empty(0, dtype=np.uint64)
    base = 0x9E3779B97F4A7C15
    part, length = hashes, 1                  # polynomials of `length` words
    total, have = None, 0                     # the same of the first `have` words of each window
    rest = size
    while rest:
        if rest & 1:
            if total is None:
                total = part
            else:
                n = len(hashes) - have - length + 1
                total = total[:n] * np.uint64(pow(base, length, 2**64)) + part[have:have + n]
            have += length
        rest >>= 1
        if rest:
            part = part[:-length] * np.uint64(pow(base, length, 2**64)) + part[length:]
            length *= 2
    return mixed(total)


BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_tables: dict[str, np.ndarray] = {}


def powers(inverse: bool = False) -> np.ndarray:
    """The powers of the base of the words' polynomials, or of its inverse, for every place of a block."""
    name = "inverse" if inverse else "powers"
    if name not in _tables:
        out = np.empty(BLOCK_BYTES + 1, dtype=np.uint64)
        out[0], n = 1, 1
        base = pow(_BASE, -1, 2**64) if inverse else _BASE
        while n < len(out):
            step = min(n, len(out) - n)
            out[n:n + step] = out[:step] * np.uint64(pow(base, n, 2**64))
            n += step
        _tables[name] = out
    return _tables[name]


def _is_space() -> np.ndarray:
    if "space" not in _tables:
        _tables["space"] = np.isin(np.arange(256), list(SPACE_CHARS.encode()))
    return _tables["space"]


def spans_of(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes; no word goes over a cut."""
    inside = ~_is_space()[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges of a block: differences of one running polynomial."""
    if len(data) > BLOCK_BYTES:  # one word longer than a block
        import xxhash
        return np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype=np.uint64)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers()[:len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * powers(inverse=True)[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int, bool]]:
    """Pieces ``(bytes, cuts, first row, goes on)`` of a text column: whole rows up to a block, or a part of one long row
    that ends with white space. ``cuts`` are the ends of the rows in the piece."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, side="right")) - 1
        if end > row:
            yield data[offsets[row]:offsets[end]], offsets[row + 1:end + 1] - offsets[row], row, False
            row = end
            continue
        at, stop = int(offsets[row]), int(offsets[row + 1])
        while at < stop:
            cut = min(at + BLOCK_BYTES, stop)
            if cut < stop:
                white = np.flatnonzero(_is_space()[data[at:cut]])
                size = BLOCK_BYTES
                while not len(white) and cut < stop:  # a word longer than a block
                    size *= 2
                    cut = min(at + size, stop)
                    white = np.flatnonzero(_is_space()[data[at:cut]])
                if cut < stop:
                    cut = at + int(white[-1]) + 1
            yield data[at:cut], np.array([cut - at]), row, cut < stop
            at = cut
        row += 1


def word_hashes(texts: pa.Array, function=None) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, hashes of its words)`` for every row of a text column without nulls.

    ``function(data, starts, ends)`` gives the value of each word, by default its hash.
    """
    function = function or span_hashes
    held: list[np.ndarray] = []
    for data, cuts, row, goes_on in blocks(texts):
        starts, ends = spans_of(data, cuts)
        values = function(data, starts, ends)
        if goes_on or held:
            held.append(values)
            if not goes_on:
                yield row, np.concatenate(held)
                held = []
            continue
        edges = np.r_[0, np.searchsorted(starts, cuts)]
        for i in range(len(cuts)):
            yield row + i, values[edges[i]:edges[i + 1]]
