"""Near-duplicates by Order MinHash.

A document's five-word shingles are labelled with their occurrence (the second time a shingle comes it is another
element), so an element has one place in the text. For each of ``SKETCHES`` hash functions the ``TUPLE`` smallest
elements are taken *in text order* and hashed together: two texts share a sketch only if they share these elements in
the same order, which follows edit similarity and not only the overlap of sets. Texts that share a sketch are
candidates; a banded alignment of their elements decides.

Similarity of two texts: aligned elements / (elements of both - aligned), 0.8 or more makes a link. The alignment is
the longest common subsequence within the band that this similarity leaves.

Small groups (``NEXT`` + 1 texts) are compared completely. Large ones are not paired out: the first round puts the texts of a
sketch in the order of their following sketches, which brings those together that share more of them, and each meets the next
``NEXT`` ones and one leader, unless the two have nothing but this one sketch in common. That ties large families together through
all their sketches; their classes are only a start. The second round is exact for all texts of large groups, and for short texts
(up to ``SHORT`` elements), which may share no sketch at all though they are alike: elements are put in one order, rare ones first, two texts that are alike must share one of their first elements (a fifth of each text), and the places of the first
common element bound what the two can have in common. Pairs of different first classes within the bound are aligned. The order
is by counts over ``SLOTS`` hash slots; any order gives the same classes, a good one fewer pairs. Copies of one word sequence are
one text throughout.

Defined cases: a text of one to four words is one shingle; texts without words (null, empty, white space) are never
linked, each row is its own class. Rows with equal ``doc_id`` and text share a class. A class without any ``doc_id``
has a null ``class_id``. Columns beside ``doc_id`` and the text are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from millrace.llm.common import free_name, mixed, window_hashes, word_hashes
from millrace.llm.graph import components
from millrace.session import stored

SHINGLE = 5
HOT_ROWS = 1000  # rows of one text that are no burden to a task
SIMILARITY = 0.8
SKETCHES = 28
TUPLE = 5
NEXT = 4
SLOTS = 1 << 22
SHORT = 80


def elements(words: np.ndarray) -> np.ndarray:
    """Occurrence-labelled shingles of a text in text order; all different."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    shingles = window_hashes(words, min(SHINGLE, len(words)))
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    fresh = np.r_[True, ranked[1:] != ranked[:-1]]
    if fresh.all():
        return shingles
    place = np.arange(len(ranked))
    times = np.empty(len(ranked), dtype=np.uint64)
    times[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
    return np.where(times > 0, mixed(shingles + times * np.uint64(0xD1B54A32D192ED03)), shingles)


def sketches(items: np.ndarray, count: int = SKETCHES, size: int = TUPLE) -> np.ndarray:
    """One hash per hash function over its ``size`` smallest elements in text order."""
    size = min(size, len(items))
    t = np.arange(count, dtype=np.uint64)[:, None]
    turn, factor = np.uint64(0x9E3779B97F4A7C15) * (2 * t + 1), np.uint64(0xBF58476D1CE4E5B9) + 2 * t
    weights = np.uint64(0x9E3779B97F4A7C15) ** np.arange(size, dtype=np.uint64)
    out = np.empty(count, dtype=np.uint64)
    some = max(1, (1 << 18) // max(1, len(items)))  # functions at once: long texts need not hold all keys
    for i in range(0, count, some):
        keys = (items ^ turn[i:i + some]) * factor[i:i + some]
        least = np.sort(np.argpartition(keys, size - 1, axis=1)[:, :size], axis=1)
        out[i:i + some] = (items[least] * weights).sum(axis=1, dtype=np.uint64)
    return mixed(out)


def aligned(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two texts given as word hashes; 0.0 where it can't reach ``SIMILARITY``."""
    x, y = elements(a), elements(b)
    if not len(x) or not len(y):
        return 0.0
    need = SIMILARITY / (1 + SIMILARITY) * (len(x) + len(y))
    _, at_x, at_y = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if len(at_x) < need - 1e-9:
        return 0.0
    band = max(len(x), len(y)) - int(np.ceil(need - 1e-9))
    inside = np.abs(at_x - at_y) <= band
    at_x, at_y = at_x[inside], at_y[inside]
    tails: list[int] = []
    for place in at_y[np.argsort(at_x)].tolist():  # longest increasing run of places: the alignment
        k = bisect_left(tails, place)
        if k == len(tails):
            tails.append(place)
        else:
            tails[k] = place
    return len(tails) / (len(x) + len(y) - len(tails))


def content_key(hashes: np.ndarray) -> bytes:
    """A 128-bit key of a word sequence."""
    return xxhash.xxh3_128_digest(np.ascontiguousarray(hashes))


def sketched(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, content, sketches, words)`` per row that has words; ``words`` as 32-bit hashes."""
    schema = StructType([StructField("doc_id", docs.schema[doc_id].dataType), StructField("content", BinaryType()),
                         StructField("sketches", ArrayType(LongType())), StructField("words", ArrayType(IntegerType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, marks, words = [], [], [], []
            for row, hashes in word_hashes(batch.column(1)):
                if not len(hashes):
                    continue
                short = hashes.astype(np.uint32).view(np.int32)
                rows.append(row)
                keys.append(content_key(hashes))
                marks.append(sketches(elements(mixed(short.astype(np.uint64)))).view(np.int64))
                words.append(short)
            lists = [pa.ListArray.from_arrays(np.cumsum([0, *map(len, x)]).astype(np.int32),
                                              np.concatenate(x) if x else np.empty(0, kind)) for x, kind in ((marks, np.int64), (words, np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), pa.array(keys, pa.binary()), *lists],
                                             names=["doc_id", "content", "sketches", "words"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(work, schema)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with ``same``: whether the alignment of the two texts reaches the similarity."""
    schema = StructType([StructField("a", BinaryType()), StructField("b", BinaryType()), StructField("same", BooleanType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [(c.flatten().to_numpy(), np.r_[0, np.cumsum(c.value_lengths().to_numpy())]) for c in (batch.column(2), batch.column(3))]
            same = []
            for i in range(batch.num_rows):
                a, b = (mixed(v[o[i]:o[i + 1]].astype(np.uint64)) for v, o in both)
                same.append(bool(aligned(a, b) >= SIMILARITY))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.bool_())], names=["a", "b", "same"])

    with_b = pairs.join(texts.select(F.col("content").alias("b"), F.col("words").alias("wb")), "b")
    with_a = with_b.join(texts.select(F.col("content").alias("a"), F.col("words").alias("wa")), "a")
    return with_a.select("a", "b", "wa", "wb").mapInArrow(work, schema)


def lanes() -> Column:
    """One byte of each sketch, to tell how many sketches two texts share without carrying them."""
    return F.aggregate("sketches", F.lit(""), lambda s, x: F.concat(s, F.lpad(F.hex(F.shiftrightunsigned(x, 56)), 2, "0")), lambda s: F.unhex(s))


def several_shared(x: pa.Array, y: pa.Array) -> np.ndarray:
    a, b = (np.frombuffer(b"".join(v.to_pylist()), dtype=np.uint8).reshape(-1, SKETCHES) for v in (x, y))
    return (a == b).sum(axis=1) >= 2


def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = pa.array(several_shared(batch.column(2), batch.column(3)))
        yield batch.select([0, 1]).filter(kept)


def neighbours(shared: DataFrame) -> DataFrame:
    """``(x, y)``: every text of a bucket with the next ``NEXT`` ones in the order of ``following``; in large buckets those that share more with it.

    A small bucket lies in one partition, so all its pairs are here.
    """
    schema = StructType([StructField("x", BinaryType()), StructField("y", BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if tail is None else [tail, batch]).combine_chunks()
            old = 0 if tail is None else tail.num_rows
            buckets, contents, marks = rows.column(0).to_numpy(), rows.column(2).combine_chunks(), rows.column(3).combine_chunks()
            small = ~rows.column(4).to_numpy()
            for k in range(1, NEXT + 1):
                second = np.flatnonzero(buckets[k:] == buckets[:-k]) + k
                second = second[second >= old]  # pairs within the tail were made before
                second = second[small[second] | several_shared(marks.take(pa.array(second - k)), marks.take(pa.array(second)))]
                yield pa.RecordBatch.from_arrays([contents.take(pa.array(second - k)), contents.take(pa.array(second))], names=["x", "y"])
            tail = rows.slice(max(0, rows.num_rows - NEXT)).combine_chunks().to_batches()[0] if rows.num_rows else None

    parts = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = [F.when(F.col("large"), F.col(c)) for c in ("following", "content")]
    ordered = shared.select("bucket", "following", "content", "lanes", "large").repartitionByRange(parts, "bucket", *apart)
    return ordered.sortWithinPartitions("bucket", "following", "content").mapInArrow(work, schema)


def buckets(different: DataFrame) -> DataFrame:
    """``(bucket, following, content, lanes, large)`` of every sketch that several texts share."""
    after = [F.get("sketches", (F.col("t") + i) % SKETCHES) for i in (1, 2)]
    order = F.shiftleft(F.shiftrightunsigned(after[0], 32), 32).bitwiseOR(F.shiftrightunsigned(after[1], 32))
    marks = different.select("content", "sketches", F.posexplode("sketches").alias("t", "mark")).select(
        F.xxhash64("t", "mark").alias("bucket"), order.alias("following"), "content")
    several = marks.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket", (F.col("n") > NEXT + 1).alias("large"))
    return marks.join(several, "bucket").join(different.select("content", lanes().alias("lanes")), "content")


def first_pairs(shared: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of the first round: leaders of large buckets, neighbours in all."""
    large = shared.filter("large")
    leaders = large.groupBy("bucket").agg(F.min_by(F.struct("content", "lanes"), F.xxhash64("bucket", "content")).alias("leader"))
    to_leader = large.join(leaders, "bucket").filter("content <> leader.content").select(
        F.col("content").alias("x"), F.col("leader.content").alias("y"), "lanes", F.col("leader.lanes").alias("lanes_y"))
    met = to_leader.mapInArrow(led, StructType([StructField("x", BinaryType()), StructField("y", BinaryType())])).unionByName(neighbours(shared))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def slots_of(items: np.ndarray) -> np.ndarray:
    return (items % np.uint64(SLOTS)).astype(np.int64)


def lists_of(column: pa.Array) -> Iterator[np.ndarray]:
    values, ends = column.flatten().to_numpy(), np.r_[0, np.cumsum(column.value_lengths().to_numpy())]
    for i in range(len(column)):
        yield elements(mixed(values[ends[i]:ends[i + 1]].astype(np.uint64)))


def slot_counts(texts: DataFrame) -> np.ndarray:
    """How many elements of ``texts(words)`` fall into each slot, up to 65,535."""
    schema = StructType([StructField("slot", IntegerType()), StructField("n", LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for items in lists_of(batch.column(0)):
                np.add.at(total, slots_of(items), 1)
        used = np.flatnonzero(total)
        for i in range(0, len(used), 1 << 16):
            part = used[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(total[part])], names=["slot", "n"])

    found = texts.select("words").mapInArrow(work, schema).groupBy("slot").agg(F.least(F.sum("n"), F.lit(65535)).cast("int").alias("n")).toArrow()
    out = np.zeros(SLOTS, dtype=np.uint16)
    out[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return out


def first_elements(texts: DataFrame) -> DataFrame:
    """``(element, place, n, content, label)``: of each of ``texts(content, label, words)`` the elements of which one is in any text alike."""
    schema = StructType([StructField("element", LongType()), StructField("place", IntegerType()), StructField("n", IntegerType()),
                         StructField("content", BinaryType()), StructField("label", LongType())])
    counts = texts.sparkSession.sparkContext.broadcast(slot_counts(texts))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, places, rows, sizes = [], [], [], []
            for row, items in enumerate(lists_of(batch.column(2))):
                often = counts.value[slots_of(items)]
                order = np.lexsort((items, often))[:len(items) - int(np.ceil(SIMILARITY * len(items) - 1e-9)) + 1]
                place = np.flatnonzero(often[order] > 1)  # an element that comes once is in no other text
                out.append(items[order[place]].view(np.int64))
                places.append(place)
                rows.append(np.full(len(place), row))
                sizes.append(np.full(len(place), len(items)))
            if out:
                at = pa.array(np.concatenate(rows), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array(np.concatenate(places), pa.int32()), pa.array(np.concatenate(sizes), pa.int32()),
                                                  batch.column(0).take(at), batch.column(1).take(at)], names=schema.names)

    return texts.select("content", "label", "words").mapInArrow(work, schema)


def open_pairs(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of ``texts(content, words)`` with different labels that can be alike: none that is alike is missing."""
    labelled = texts.join(labels.withColumnRenamed("node", "content"), "content", "left").select(
        "content", F.xxhash64(F.coalesce("label", "content")).alias("label"), "words")
    firsts = stored(first_elements(stored(labelled, "open")), "first-elements")
    # an element of one label only leads nowhere; of the others the rows of the commonest label do not meet each other
    per_element = firsts.groupBy("element", "label").agg(F.count("*").alias("rows")).groupBy("element").agg(
        F.count("*").alias("labels"), F.max_by("label", "rows").alias("commonest")).filter("labels > 1")
    kept = stored(firsts.join(per_element, "element").withColumn("common", F.col("label") == F.col("commonest")), "shared-elements")
    a, b = (kept.select("element", *[F.col(c).alias(f"{c}_{x}") for c in ("place", "n", "content", "label", "common")]) for x in "ab")
    most = 1 + F.least(F.col("n_a") - F.col("place_a") - 1, F.col("n_b") - F.col("place_b") - 1)
    can = most * (1 + SIMILARITY) >= SIMILARITY * (F.col("n_a") + F.col("n_b")) - 1e-6
    once = F.col("common_b") | (F.col("content_a") < F.col("content_b"))
    met = a.filter(~F.col("common_a")).join(b, (a.element == b.element) & once & (F.col("label_a") != F.col("label_b")) & can)
    return met.select(F.least("content_a", "content_b").alias("a"), F.greatest("content_a", "content_b").alias("b")).distinct()


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels(node, label)`` after ``links(a, b)`` between their nodes or new ones were added."""
    def end(x: str) -> DataFrame:
        return labels.select(F.col("node").alias(x), F.col("label").alias(f"{x}_label"))

    between = links.join(end("a"), "a", "left").join(end("b"), "b", "left").select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    more = stored(components(between), "merged")
    old = labels.join(more.select(F.col("node").alias("label"), F.col("label").alias("then")), "label", "left").select("node", F.coalesce("then", "label").alias("label"))
    return old.unionByName(more.join(labels, "node", "left_anti"))


def labels_of(rows: DataFrame) -> DataFrame:
    """``(node, label)`` of every text with a link, from ``sketched`` rows."""
    short = F.size("words") < SHORT + SHINGLE
    different = stored(rows.select("content", "sketches", short.alias("short")).dropDuplicates(["content"]), "different")
    shared = stored(buckets(different), "buckets")
    wanted = shared.select("content", "large").unionByName(different.filter("short").select("content", F.lit(True).alias("large"))) \
        .groupBy("content").agg(F.max("large").alias("open"))
    # copies of a text are combined in their tasks before any words move
    texts = stored(rows.groupBy("content").agg(F.first("words").alias("words")).join(wanted, "content"), "texts")
    first = stored(verified(stored(first_pairs(shared), "pairs"), texts).filter("same").select("a", "b"), "links")
    labels = stored(components(first), "first-labels")
    rest = stored(open_pairs(texts.filter("open"), labels), "open-pairs")
    return merged(labels, stored(verified(rest, texts).filter("same").select("a", "b"), "open-links"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, texts)``: ``rows(doc_id, content)`` per row with words; ``texts(content, class_id, keeper, copies)`` per different text.

    ``class_id`` is the smallest ``doc_id`` of the class, ``keeper`` says that the text is the one with that ``doc_id``.
    """
    rows = stored(sketched(docs, doc_id, text), "sketched")
    labels = labels_of(rows)
    texts = rows.groupBy("content").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    joined = stored(texts.join(labels, texts.content == labels.node, "left")
                    .select("content", F.coalesce("label", "content").alias("label"), "first", "copies"), "classes")
    order = F.struct(F.col("first").isNull().alias("none"), "first", "content")
    heads = joined.groupBy("label").agg(F.min("first").alias("class_id"), F.min_by("content", order).alias("head"))
    return rows.select("doc_id", "content"), joined.join(heads, "label").select(
        "content", "class_id", (F.col("content") == F.col("head")).alias("keeper"), "copies")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, class_id)`` for every row of ``docs``."""
    rows, texts = classes(docs, doc_id, text)
    wordless = F.length(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))) == 0
    alone = docs.filter(wordless).select(F.col(doc_id).alias("doc_id"), F.col(doc_id).alias("class_id"))
    # a text with more than a thousandth of all rows, of which there are fewer than a thousand, goes to its rows; other rows go to their texts
    least = max(HOT_ROWS, rows.count() // 1000)
    texts = stored(texts.select("content", "class_id", "copies"), "class-of-text")
    hot = F.broadcast(texts.filter(F.col("copies") > least).select("content", "class_id"))
    found = rows.join(hot, "content").unionByName(rows.join(hot, "content", "left_anti").join(texts.filter(F.col("copies") <= least).drop("copies"), "content"))
    return found.select("doc_id", "class_id").unionByName(alone)


@arrow_udf(BinaryType())
def content_of(text: pa.Array) -> pa.Array:
    return pa.array([content_key(hashes) if len(hashes) else None for _, hashes in word_hashes(text)], pa.binary())


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the smallest ``doc_id`` (null last), then any of equal rows.

    Rows of one word sequence are thinned before the shuffle, so a group of copies of any size moves one row per task.
    Rows without words all stay.
    """
    _, texts = classes(docs, doc_id, text)
    key = free_name(docs, "content")
    keyed = docs.withColumn(key, content_of(F.coalesce(F.col(text), F.lit(""))))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"))
    one = keyed.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(whole, order).alias("row"))
    kept = one.join(texts.filter("keeper").select(F.col("content").alias(key)), key, "left_semi").select("row.*")
    return kept.unionByName(keyed.filter(F.col(key).isNull()).select(*docs.columns))
