"""Periodic runs of words, by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) of at least ``max(least, times * q)``
words that no neighbouring word extends. The words of some documents stand in one array of numbers, with a number of its
own after each document.

Candidates come from harmonic grids: for every period p only the places at multiples of p are looked at. A run of
``times`` periods covers ``times`` such places in a row, all with the same word; n/p places for each p are n log n in all.

What a candidate extends to is told exactly by a grammar. ``Grammar`` alternately puts blocks of one symbol together and
pairs of a left with a right symbol (letters fall to a side by a hash of symbol and level), so that each level is shorter
by a constant part and equal stretches are parsed alike but for their borders. A longest common extension climbs the levels
while both places are borders of symbols and comes down where the symbols differ: a few steps a level, for all candidates
at once. The same levels read backwards give the extension to the left. Symbols are named by sorting, so nothing depends on
hashes but the sides.

Only documents with candidates get a grammar. Memory and work of a document are n and n log n; there are no suffix arrays.

Defined cases: null or blank texts have no words and no runs; repeated rows are treated one by one; an empty table gives an
empty table; columns of the input with the name of a result are replaced, all others are kept. Equal stretches with several
periods count once, with the smallest. Long texts are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from millrace.llm.common import free_name, mixed, without

GROUP_WORDS = 400_000  # words of several documents that share a grammar
LEAST, TIMES = 6, 4


class Level:
    """The symbols of one level and, for each, where it begins on the level below."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, block: bool):
        self.symbols, self.first, self.block = symbols, first, block
        self.parent: np.ndarray | None = None      # number of the symbol above
        self.border: np.ndarray | None = None      # whether a symbol above begins here

    def mirrored(self, below: int) -> Level:
        """The same level read from the right; ``below`` is the size of the level below."""
        ends = np.r_[self.first[1:], below]
        return Level(self.symbols[::-1], (below - ends)[::-1], self.block)


def linked(levels: list[Level]) -> list[Level]:
    """Tell every level how its symbols are put together above."""
    for low, high in zip(levels, levels[1:], strict=False):
        low.border = np.zeros(len(low.symbols) + 1, dtype=bool)
        low.border[high.first] = True
        low.border[-1] = True
        low.parent = np.cumsum(low.border[:-1]) - 1
    return levels


class Grammar:
    """A run-length grammar of an array of numbers; numbers below ``barriers`` are barriers that stay as they are."""

    def __init__(self, values: np.ndarray, barriers: int):
        size = len(values)
        levels = [Level(values, np.arange(size), False)]
        named = int(values.max(initial=0)) + 1
        idle = 0
        while idle < 8:
            symbols = levels[-1].symbols
            if len(symbols) <= 2 * barriers:
                break
            level, named = self.blocks(symbols, named)
            if level is not None:
                levels.append(level)
                symbols = level.symbols
            level, named = self.pairs(symbols, named, barriers, len(levels) + idle)
            if level is None:
                idle += 1
                continue
            idle = 0
            levels.append(level)
        mirror = [lv.mirrored(len(levels[max(k - 1, 0)].symbols)) for k, lv in enumerate(levels)]
        self.size = size
        self.forward, self.backward = linked(levels), linked(mirror)

    @staticmethod
    def blocks(symbols: np.ndarray, named: int) -> tuple[Level | None, int]:
        """One symbol for each block of two or more of a symbol."""
        first = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        counts = np.diff(np.r_[first, len(symbols)])
        many = counts > 1
        if not many.any():
            return None, named
        out = symbols[first]
        _, names = np.unique(out[many] * np.int64(len(symbols) + 1) + counts[many], return_inverse=True)
        out[many] = named + names
        return Level(out, first, True), named + int(names.max()) + 1

    @staticmethod
    def pairs(symbols: np.ndarray, named: int, barriers: int, level: int) -> tuple[Level | None, int]:
        """One symbol for each left symbol that is followed by a right one; of the two ways, the one with more pairs."""
        side = (mixed(symbols.astype(np.uint64), level) & np.uint64(1)).astype(bool)
        inner = (symbols[:-1] >= barriers) & (symbols[1:] >= barriers)
        best = max((~side[:-1] & side[1:] & inner, side[:-1] & ~side[1:] & inner), key=np.count_nonzero)
        at = np.flatnonzero(best)
        if not len(at):
            return None, named
        _, names = np.unique(symbols[at] * np.int64(named) + symbols[at + 1], return_inverse=True)
        kept = np.ones(len(symbols), dtype=bool)
        kept[at + 1] = False
        out = symbols.copy()
        out[at] = named + names
        return Level(out[kept], np.flatnonzero(kept), False), named + int(names.max()) + 1

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values are equal from i and from j on."""
        return common_extension(self.forward, i, j)

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values are equal before i and before j (both excluded)."""
        return common_extension(self.backward, self.size - i, self.size - j)


def common_extension(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The longest common extensions of places i < size and j < size, or the like with an end of the array (nothing)."""
    start = i.astype(np.int64)
    a, b = start.copy(), j.astype(np.int64)
    top = np.zeros(len(a), dtype=np.int64)        # the level where a query has met its difference
    moving = np.arange(len(a))
    for k, (low, high) in enumerate(zip(levels, levels[1:], strict=False)):
        x, y, size = a[moving], b[moving], len(low.symbols)
        # move on to where a symbol above begins for both
        off = ~(low.border[x] & low.border[y])
        at = np.flatnonzero(off)
        if len(at):
            u, v = x[at], y[at]
            same = (u < size) & (v < size)
            same[same] = low.symbols[u[same]] == low.symbols[v[same]]
            step = np.zeros(len(at), dtype=np.int64)
            differ = ~same
            if high.block:
                ends = np.r_[high.first[1:], size]
                to_u, to_v = ends[low.parent[u[same]]] - u[same], ends[low.parent[v[same]]] - v[same]
                step[same] = np.minimum(to_u, to_v)
                differ[same] = to_u != to_v
            else:
                step[same] = 1
            x[at], y[at] = u + step, v + step
        else:
            differ = np.empty(0, dtype=bool)
        a[moving], b[moving] = x, y
        going = np.ones(len(moving), dtype=bool)
        going[at[differ]] = False
        top[moving[~going]] = k
        moving = moving[going]
        if not len(moving):
            break
        parent = np.r_[low.parent, len(high.symbols)]
        a[moving], b[moving] = parent[a[moving]], parent[b[moving]]
    if len(moving):  # at the top only whole documents and barriers are left
        last = len(levels) - 1
        top[moving] = last
        open_, symbols = moving, levels[-1].symbols
        while len(open_):
            x, y = a[open_], b[open_]
            same = (x < len(symbols)) & (y < len(symbols))
            same[same] = symbols[x[same]] == symbols[y[same]]
            open_ = open_[same]
            a[open_] += 1
            b[open_] += 1
    for k in range(len(levels) - 1, 0, -1):
        at = np.flatnonzero(top >= k)
        if not len(at):
            continue
        low, high = levels[k - 1], levels[k]
        size = len(low.symbols)
        first = np.r_[high.first, size]
        x, y = first[a[at]], first[b[at]]
        # the symbols above differ: their first parts may still be equal
        same = (x < size) & (y < size)
        same[same] = low.symbols[x[same]] == low.symbols[y[same]]
        if high.block:
            step = np.minimum(first[a[at[same]] + 1] - x[same], first[b[at[same]] + 1] - y[same])
        else:
            step = 1
        x[same] += step
        y[same] += step
        a[at], b[at] = x, y
    return a - start


def candidates(values: np.ndarray, lengths: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods where words at ``times`` grid places in a row are the same. Documents stand in ``values`` from long
    to short, each with its barrier behind."""
    places, periods = [], []
    ends = np.cumsum(lengths + 1)
    longest = int(lengths[0]) if len(lengths) else 0
    for p in range(1, longest // times + 1):
        # documents too short for this period are left out
        until = ends[np.searchsorted(-lengths, -max(least, times * p), side="right") - 1]
        grid = values[:until:p]
        if len(grid) < times:
            continue
        same = grid[1:] == grid[:-1]
        row = same[:len(same) - times + 2]
        for k in range(1, times - 1):
            row = row & same[k:len(same) - times + 2 + k]
        at = np.flatnonzero(row)
        if len(at):
            places.append(at * p)
            periods.append(np.full(len(at), p))
    if not places:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs_of(documents: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """For each document, an array of numbers from 0 on, its runs as rows ``start, length, period`` by start and period."""
    out = [np.empty((0, 3), dtype=np.int64)] * len(documents)
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] >= least]
    if not len(order):
        return out

    def joined(rows: np.ndarray) -> np.ndarray:
        # barriers take the first numbers, words come after them
        values = np.empty(int(lengths[rows].sum()) + len(rows), dtype=np.int64)
        at = 0
        for n, row in enumerate(rows.tolist()):
            values[at:at + lengths[row]] = documents[row] + len(rows)
            at += int(lengths[row]) + 1
            values[at - 1] = n
        return values

    places, _ = candidates(joined(order), lengths[order], least, times)
    if not len(places):
        return out
    order = order[np.unique(np.searchsorted(np.cumsum(lengths[order] + 1), places, side="right"))]
    values = joined(order)
    places, periods = candidates(values, lengths[order], least, times)
    grammar = Grammar(values, len(order))
    ends = places + periods + grammar.right(places, places + periods)
    starts = places - grammar.left(places, places + periods)
    enough = ends - starts >= np.maximum(least, times * periods)
    found = np.stack([starts, ends, periods])[:, enough]
    found = found[:, np.lexsort(found[::-1])]  # by start, end, period
    found = found[:, np.r_[True, (found[:2, 1:] != found[:2, :-1]).any(axis=0)]] if found.shape[1] else found
    borders = np.cumsum(lengths[order] + 1)
    document = np.searchsorted(borders, found[0], side="right")
    begin = np.r_[0, borders][document]
    rows = np.stack([found[0] - begin, found[1] - found[0], found[2]], axis=1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0], document))]
    cuts = np.searchsorted(document, np.arange(len(order) + 1))
    for n, row in enumerate(order.tolist()):
        out[row] = rows[cuts[n]:cuts[n + 1]]
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words are left when every run keeps its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


RESULT = pa.struct([("n_words", pa.int64()),
                    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                    ("collapsed_text", pa.string())])
SCHEMA = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed_text:string>"


class Numbers(dict):
    """Word -> number in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def numbered(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(Numbers().__getitem__, words), dtype=np.int64, count=len(words))


def judged(texts: list[bytes], least: int, times: int) -> pa.Array:
    split = [t.split() for t in texts]  # bytes are split at ASCII white space
    out = []
    for words, runs in zip(split, runs_of([numbered(w) for w in split], least, times), strict=True):
        if len(runs):
            left = kept_words(len(words), runs)
            words_left = [w for w, keep in zip(words, left.tolist(), strict=True) if keep]
        else:
            words_left = words
        out.append({"n_words": len(words), "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()],
                    "collapsed_text": b" ".join(words_left).decode("utf-8", "replace")})
    return pa.array(out, RESULT)


def collapse_runs(docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (structs by start and period) and ``collapsed_text``, in which each run keeps its first period."""
    if least < 1 or times < 2:
        raise ValueError("a run has at least one word and two periods")

    @arrow_udf(SCHEMA)
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            done, held, size = [], [], 0
            for t in part.cast(pa.binary()):
                held.append(t.as_py() or b"")
                size += len(held[-1])
                if size >= 6 * GROUP_WORDS:
                    done.append(judged(held, least, times))
                    held, size = [], 0
            done.append(judged(held, least, times))
            yield pa.concat_arrays(done)

    names = ["n_words", "runs", "collapsed_text"]
    kept = without(docs, [n for n in names if n.lower() != text.lower()])
    cell = free_name(kept, "judged")
    judged_docs = kept.withColumn(cell, run(F.coalesce(F.col(text), F.lit(""))))
    kept = without(judged_docs, [cell, *(n for n in names if n.lower() == text.lower())])
    return judged_docs.select(*[F.col(f"`{c}`") for c in kept.columns], *[F.col(f"`{cell}`.{n}").alias(n) for n in names])
