"""Removing word sequences that came before, by suffix trees over prefix groups.

A window is ``WINDOW`` consecutive words; a window whose words also start earlier (smaller ``doc_id``, or same document and
earlier place) is a repeat, and every word under a repeat is removed. All windows are judged on the input.

1. *Which suffixes.* Each window is represented by the one of its ``PREFIX``-word sequences with the smallest hash (the
   leftmost of equals), so equal windows are represented at the same place. About one word in seven starts such a suffix.
2. *Which prefixes.* The prefixes of these suffixes are counted over the whole corpus. One that comes once has a leaf for a
   tree and is dropped. What is known about the others goes to the tasks as two bitmaps of fixed size (``FILTER_BITS``): comes
   again, and comes more than ``GROUP`` times. Both are filters only: a bit set for another prefix costs work, not correctness.
3. *Trees.* Suffixes with the words around them are dealt by prefix. Per group the windows are put in the order of their
   words; neighbours' common prefixes are the inner nodes of the group's suffix tree, and a node of depth ``WINDOW`` or more has
   the places of one repeat as leaves, of which the earliest stays.
4. *Variable length.* A prefix that comes more than ``GROUP`` times is made longer until only one repeat is left below it,
   that is to a whole window. Such a group is a single deep node: its earliest place is a minimum. It is combined before the
   shuffle: of all places in one task only the earliest is compared with other tasks, the others are repeats of that one.

Defined cases: null and empty texts have no words; a text shorter than a window keeps all; rows with equal ``doc_id`` and
text are one document and get the same result; equal ``doc_id`` with different texts is ordered by text hash; a null
``doc_id`` comes after all others. ``doc_id`` must be an integer. Columns of the input pass through; result names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from millrace.llm.common import free_name, window_hashes, without, word_hashes
from millrace.session import stored

WINDOW = 20
PREFIX = 8
GROUP = 1000
FILTER_BITS = 27
BEFORE = WINDOW - PREFIX          # words before a suffix that its windows may reach back to
CHUNK = 1 << 20
ROWS = 20_000                     # rows of an Arrow batch on the way out, and of trees built at once
COMBINED = 400_000                # windows of long prefixes combined at once in a task


def suffixes(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(place, prefix hash, first window, last window)`` of the representing suffixes of a text, in pieces."""
    low = np.uint64(CHUNK - 1)
    for start in range(0, max(0, len(words) - WINDOW + 1), CHUNK - 2 * WINDOW):
        part = words[start:start + CHUNK - WINDOW - 1]
        prefixes = window_hashes(part, PREFIX)
        keys = (prefixes & ~low) | np.arange(len(prefixes), dtype=np.uint64)
        width, have = BEFORE + 1, 1
        least = keys
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        least = least[:CHUNK - 2 * WINDOW]
        places = (least & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        last = np.r_[first[1:], len(places)] - 1
        at = places[first]
        yield start + at, prefixes[at], start + first, start + last


def bitmap(prefixes: DataFrame) -> np.ndarray:
    """The bits of ``prefixes(prefix)``; at most ``2 ** (FILTER_BITS - 6)`` rows come to the driver."""
    place = F.shiftrightunsigned("prefix", 64 - FILTER_BITS)
    rows = (prefixes.groupBy(F.shiftrightunsigned(place, 6).cast("int").alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(prefix, {64 - FILTER_BITS}) & 63 as int))")).alias("bits"))).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def has(bits: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    place = prefixes >> np.uint64(64 - FILTER_BITS)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)).alias("doc"), F.xxhash64(text).alias("text_hash"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))


def prefix_counts(texts: DataFrame) -> DataFrame:
    """``(prefix, n)`` of the prefixes that come again."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in word_hashes(batch.column(0)):
                found = [p for _, p, _, _ in suffixes(words)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["prefix"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in work(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= ROWS:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    found = texts.select("text").mapInArrow(joined, "prefix bigint")
    return found.groupBy("prefix").agg(F.count("*").alias("n")).filter("n > 1")


CONTEXT = StructType([StructField("prefix", LongType()), StructField("doc", LongType()), StructField("text_hash", LongType()),
                      StructField("place", IntegerType()), StructField("first", IntegerType()), StructField("last", IntegerType()),
                      StructField("words", BinaryType())])
LONG = StructType([StructField("key", LongType()), StructField("key2", LongType()), StructField("doc", LongType()),
                   StructField("text_hash", LongType()), StructField("place", IntegerType()), StructField("n", IntegerType())])


def _repeated(texts: DataFrame, again, often, long: bool) -> DataFrame:
    """Suffixes of repeated prefixes in their context, or (``long``) every window of the prefixes that come often."""
    around = np.arange(-BEFORE, WINDOW)

    def rows(doc: int, text_hash: int, words: np.ndarray) -> Iterator[list]:
        short = words.astype(np.uint32)
        for place, prefix, first, last in suffixes(words):
            hot = has(often.value, prefix)
            kept = np.flatnonzero(hot if long else has(again.value, prefix) & ~hot)
            for some in np.array_split(kept, -(-len(kept) // ROWS)) if len(kept) else []:
                if long:
                    lengths = last[some] - first[some] + 1
                    starts = np.repeat(first[some], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                    lo, hi = starts.min(), starts.max()
                    part = words[lo:hi + WINDOW]
                    key = window_hashes(part, WINDOW)[starts - lo]
                    key2 = window_hashes(part ^ np.uint64(0x5851F42D4C957F2D), WINDOW)[starts - lo]
                    yield [key.view(np.int64), key2.view(np.int64), np.full(len(starts), doc), np.full(len(starts), text_hash), starts.astype(np.int32)]
                else:
                    at = place[some]
                    context = short[np.clip(at[:, None] + around, 0, len(short) - 1)]
                    yield [prefix[some].view(np.int64), np.full(len(at), doc), np.full(len(at), text_hash), at.astype(np.int32),
                           (at - last[some]).astype(np.int32), (at - first[some]).astype(np.int32), context]

    size = 4 * len(around)

    def contexts(held: list[list]) -> Iterator[pa.RecordBatch]:
        cols = [np.concatenate(c) for c in zip(*held, strict=True)]
        edges = np.arange(0, (len(cols[0]) + 1) * size, size, dtype=np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(cols[0]), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(cols[-1]))])
        yield pa.RecordBatch.from_arrays([*map(pa.array, cols[:-1]), words], names=CONTEXT.names)

    def combined(held: list[list]) -> Iterator[pa.RecordBatch]:
        key, key2, doc, text_hash, place = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((place, text_hash, doc, key2, key))
        again = np.r_[False, (key[order[1:]] == key[order[:-1]]) & (key2[order[1:]] == key2[order[:-1]])]
        first = order[np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))]
        one, other = order[~again], (doc[order] != doc[first]) | (text_hash[order] != text_hash[first]) | (place[order] != place[first])
        more = order[other]
        for some in np.array_split(one, -(-len(one) // ROWS)):
            yield pa.RecordBatch.from_arrays([*(pa.array(c[some]) for c in (key, key2, doc, text_hash, place)), pa.array(np.zeros(len(some), dtype=np.int32))],
                                             names=LONG.names)
        repeated = runs(doc[more], text_hash[more], place[more])
        none = pa.nulls(repeated.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, *repeated.columns], names=LONG.names)

    most = COMBINED if long else ROWS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            docs, text_hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, words in word_hashes(batch.column(2)):
                for part in rows(docs[row], text_hashes[row], words):
                    held.append(part)
                    n += len(part[0])
                    if n >= most:
                        yield from combined(held) if long else contexts(held)
                        held, n = [], 0
        if held:
            yield from combined(held) if long else contexts(held)

    return texts.mapInArrow(work, LONG if long else CONTEXT)


def runs(doc: np.ndarray, text_hash: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Repeats as ``(doc, text_hash, place, n)``: ``n`` consecutive windows from ``place`` on."""
    order = np.lexsort((start, text_hash, doc))
    doc, text_hash, start = doc[order], text_hash[order], start[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (text_hash[1:] != text_hash[:-1]) | (start[1:] != start[:-1] + 1)][:len(doc)]
    first = np.flatnonzero(new)
    return pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(text_hash[first]), pa.array(start[first].astype(np.int32)),
                                       pa.array(np.diff(np.r_[first, len(doc)]).astype(np.int32))], names=["doc", "text_hash", "place", "n"])


def deep_leaves(doc: np.ndarray, text_hash: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray,
                words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and starts of the windows that repeat an earlier one."""
    found = []
    for j in range(BEFORE + 1):
        rows = np.flatnonzero((first <= j) & (j <= last))
        if len(rows) < 2:
            continue
        strings = np.ascontiguousarray(words[rows, BEFORE - j:BEFORE - j + WINDOW])
        packed = strings.view(np.uint64)
        order = np.lexsort((place[rows], text_hash[rows], doc[rows], *packed.T[::-1]))  # leaves in the order of their words, then by place
        same = strings[order[1:]] == strings[order[:-1]]
        depth = np.where(same.all(axis=1), WINDOW, np.argmin(same, axis=1))             # of the node that joins two neighbours
        head = np.maximum.accumulate(np.where(np.r_[True, depth < WINDOW], np.arange(len(rows)), 0))  # the earliest leaf of each deep node
        later, earliest = rows[order], rows[order[head]]
        # a row that is there twice is one place
        later = later[(doc[later] != doc[earliest]) | (text_hash[later] != text_hash[earliest]) | (place[later] != place[earliest])]
        found.append((later, place[later] - j))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


FOUND = "doc bigint, text_hash bigint, place int, n int"


def trees(contexts: DataFrame) -> DataFrame:
    """Repeats ``(doc, text_hash, place, n)`` of suffixes dealt by prefix; a group has at most ``GROUP`` suffixes."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        cols = [table.column(i).to_numpy() for i in range(1, 6)]
        words = np.frombuffer(b"".join(table.column(6).to_pylist()), dtype=np.uint32).reshape(-1, BEFORE + WINDOW)
        rows, starts = deep_leaves(*cols, words)
        return runs(cols[0][rows], cols[1][rows], starts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < ROWS:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column(0).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last group may go on in the next batch
            if cut:
                yield solve(table.slice(0, cut))
                table = table.slice(cut)
            held, n = table.combine_chunks().to_batches(), table.num_rows
        if held:
            yield solve(pa.Table.from_batches(held))

    return contexts.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(work, FOUND)


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, text_hash, places)`` per document with repeats; ``places(place, n)``: ``n`` windows from ``place`` on."""
    spark = docs.sparkSession
    texts = _texts(docs, doc_id, text)
    counts = stored(prefix_counts(texts), "prefixes")
    hot_prefixes = counts.filter(F.col("n") > GROUP)
    again = spark.sparkContext.broadcast(bitmap(counts))
    often = spark.sparkContext.broadcast(bitmap(hot_prefixes))
    found = trees(_repeated(texts, again, often, long=False))
    if not hot_prefixes.isEmpty():
        places = stored(_repeated(texts, again, often, long=True), "long-prefixes")
        windows = places.filter("n = 0")  # the earliest of its task
        earliest = windows.groupBy("key", "key2").agg(F.min(F.struct("doc", "text_hash", "place")).alias("e"), F.count("*").alias("tasks")).filter("tasks > 1")
        later = windows.join(earliest, ["key", "key2"]).filter(F.struct("doc", "text_hash", "place") > F.col("e"))
        found = found.unionByName(later.select("doc", "text_hash", "place", F.lit(1).alias("n"))) \
            .unionByName(places.filter("n > 0").select("doc", "text_hash", "place", "n"))
    return found.groupBy("doc", "text_hash").agg(F.collect_set(F.struct("place", "n")).alias("places"))


@arrow_udf(StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", BinaryType())]))
def kept_words(text: pa.Array, places: pa.Array) -> pa.Array:
    starts, flat = places.offsets.to_numpy(), places.values
    at, lengths = flat.field(0).to_numpy(), flat.field(1).to_numpy()
    n_words, n_removed, kept = [], [], []
    for i, body in enumerate(text.cast(pa.binary()).to_pylist()):
        words = body.split()
        a, b = starts[i], starts[i + 1]
        if b > a:
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edge, at[a:b], 1)
            np.add.at(edge, at[a:b] + lengths[a:b] + (WINDOW - 1), -1)
            gone = np.cumsum(edge[:-1]) > 0
            left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        else:
            left = words
        n_words.append(len(words))
        n_removed.append(len(words) - len(left))
        kept.append(b" ".join(left))
    return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
                                      names=["n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (the words that stay, one space between them)."""
    names = ("n_words", "n_removed", "kept_text")
    base = without(docs, [n for n in names if n not in (doc_id, text)])
    doc, text_hash, places, out = (free_name(base, n) for n in ("repeat_doc", "repeat_text", "repeat_places", "repeat_out"))
    keyed = base.withColumn(doc, F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1))).withColumn(text_hash, F.xxhash64(text))
    found = repeats(docs, doc_id, text).select(F.col("doc").alias(doc), F.col("text_hash").alias(text_hash), F.col("places").alias(places))
    joined = keyed.join(found, [doc, text_hash], "left")
    none = F.array().cast("array<struct<place:int,n:int>>")
    solved = joined.withColumn(out, kept_words(F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(places), none)))
    return solved.select(*[F.col(f"`{c}`") for c in base.columns], F.col(f"{out}.n_words").alias("n_words"),
                         F.col(f"{out}.n_removed").alias("n_removed"), F.col(f"{out}.kept").cast("string").alias("kept_text"))

