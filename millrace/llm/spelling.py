"""Spelling variants: words at edit distance one, their most frequent form and its root.

The letters of a word are a multiset; with each repeated letter numbered it is a binary vector, and two words one edit apart
differ in at most two places of it: a replaced letter changes two, an inserted or deleted one changes one. PartEnum makes
signatures that two vectors within that distance must share: the places are dealt into parts, and for every choice of
``parts - distance`` parts the vector within them is one signature (at most ``distance`` parts can hold a difference). Words
of the same length get the signatures for distance two, words with one letter more or less those for distance one.
An edit leaves the first or the last half of the shorter word as it is, so every signature is taken once with either half:
half, length and choice are part of it. Equal signatures are joined and every pair is verified by its edit distance.

Signatures are 64-bit sums over letters; different vectors may share one (more is verified), equal vectors always do.

A signature that more than ``GROUP`` words share is not paired as a whole: its words are told apart further by what is
left when one letter is taken out (with its place, if the lengths are equal), which words one edit apart share exactly. A
group of that kind is as large as the alphabet (times the length, for longer words), whatever the vocabulary; no word is
dropped. The number of words of each signature is counted before any row moves with its word.

``root`` follows the forms by pointer doubling; as a form is ``FACTOR`` times as frequent, a chain of h forms needs a word
that is FACTOR^h times as frequent as its first, which bounds the steps.

Defined cases: null words and null counts are left out; a word that comes in several rows has the sum of its counts; ties go to the smallest word by code
points; an empty table gives an empty table; other columns of the input are not carried. Long words are compared whole.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from millrace.llm.common import mixed
from millrace.session import stored

GROUP = 32      # words of one signature that are compared with each other
FACTOR = 10     # how much more frequent a form is
PARTS_TWO, PARTS_ONE = 4, 2
SAME, SHORT, LONG = 0, 1, 2

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)


def letter_runs(text: Column) -> Column:
    """The maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of a text, A-Z lower-cased; none for null."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))
    return F.transform(runs, lambda r: F.translate(r, upper, upper.lower()))


class Letters:
    """The code points of some words in one array, with what hashes of their parts need."""

    def __init__(self, words: pa.Array):
        texts = words.to_pylist()
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.word = np.repeat(np.arange(len(texts)), self.lengths)
        self.place = np.arange(len(self.points)) - self.starts[self.word]
        longest = int(self.lengths.max(initial=0))
        self.powers = np.r_[np.uint64(1), np.multiply.accumulate(np.full(longest + 1, _BASE, dtype=np.uint64))]
        # running sums of each word's polynomial from its start
        self.sums = np.r_[np.uint64(0), np.cumsum((self.points + np.uint64(1)) * self.powers[self.place])]

    def prefix(self, length: np.ndarray) -> np.ndarray:
        return mixed(self.sums[self.starts + length] - self.sums[self.starts])

    def suffix(self, length: np.ndarray) -> np.ndarray:
        """Hashes of the last letters, the same wherever they begin."""
        backs = np.r_[np.uint64(1), np.multiply.accumulate(np.full(len(self.powers), _BACK, dtype=np.uint64))]
        return mixed((self.sums[self.ends] - self.sums[self.ends - length]) * backs[self.lengths - length], 1)

    def parts(self, n: int) -> np.ndarray:
        """For each word and each of ``n`` parts of the vector, a sum over its letters there."""
        order = np.lexsort((self.points, self.word))
        word, points = self.word[order], self.points[order]
        new = np.r_[True, (word[1:] != word[:-1]) | (points[1:] != points[:-1])]
        begin = np.flatnonzero(new)
        nth = np.arange(len(order)) - begin[np.cumsum(new) - 1] if len(order) else np.empty(0, dtype=np.int64)
        label = mixed(points * np.uint64(1 << 32) + nth.astype(np.uint64), 2)
        part = (label >> np.uint64(33)) % np.uint64(n)
        out = np.empty((len(self.lengths), n), dtype=np.uint64)
        for p in range(n):
            sums = np.r_[np.uint64(0), np.cumsum(np.where(part == p, label, np.uint64(0)))]
            out[:, p] = sums[self.ends] - sums[self.starts]
        return out


def part_enum(parts: np.ndarray, distance: int) -> np.ndarray:
    """One signature per word and choice of all but ``distance`` parts."""
    n = parts.shape[1]
    chosen = [mixed(sum((mixed(parts[:, p], p) for p in choice), np.uint64(0)), 16 + nth)
              for nth, choice in enumerate(itertools.combinations(range(n), n - distance))]
    return np.stack(chosen, axis=1)


def signatures(words: pa.Array, role: int) -> pa.Array:
    """The signatures of each word in a role: paired with words of its length, with longer or with shorter ones."""
    letters = Letters(words)
    shared = part_enum(letters.parts(PARTS_TWO), 2) if role == SAME else part_enum(letters.parts(PARTS_ONE), 1)
    length = np.maximum(letters.lengths - (role == LONG), 0)  # of the shorter word
    half = length // 2
    kind = mixed(length.astype(np.uint64) * np.uint64(2) + np.uint64(role != SAME), 3)
    first = mixed(letters.prefix(half) + kind, 4)
    last = mixed(letters.suffix(length - half) + kind, 5)
    keys = np.concatenate([mixed(shared + first[:, None], 6), mixed(shared + last[:, None], 7)], axis=1).astype(np.int64)
    return pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), keys.shape[1]).cast(pa.list_(pa.int64()))


def rests(words: pa.Array, roles: pa.Array, keys: pa.Array) -> pa.Array:
    """What tells the words of one signature apart: each word without one letter, or the word itself in the role of the shorter one."""
    letters = Letters(words)
    key = keys.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    role = roles.to_numpy(zero_copy_only=False)
    word, place = letters.word, letters.place
    before = letters.sums[:-1] - letters.sums[letters.starts[word]]
    after = letters.sums[letters.ends[word]] - letters.sums[1:]
    left = mixed(before + after * np.uint64(_BACK), 8)
    left = np.where(role[word] == SAME, mixed(left + place.astype(np.uint64), 9), left)
    whole = mixed(letters.sums[letters.ends] - letters.sums[letters.starts], 8)
    short = role == SHORT
    kept = ~short[word]
    owner, left = np.r_[word[kept], np.flatnonzero(short)], np.r_[left[kept], whole[short]]
    left = mixed(left + key[owner], 10).view(np.int64)
    order = np.lexsort((left, owner))
    owner, left = owner[order], left[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (left[1:] != left[:-1])
    ends = np.searchsorted(owner[new], np.arange(len(role) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(left[new]))


def signed(words: DataFrame) -> DataFrame:
    """``key, role, word, n``: the words once for each of their signatures."""
    def keys(role: int):
        @arrow_udf("array<bigint>")
        def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for part in parts:
                yield signatures(part, role)
        return run("word")

    roles = F.array(*[F.struct(F.lit(r).alias("role"), keys(r).alias("keys")) for r in (SAME, SHORT, LONG)])
    return words.select("word", "n", F.explode(roles).alias("r")).select(F.explode("r.keys").alias("key"), "r.role", "word", "n")


def fitting(a: str, b: str) -> Column:
    """Whether two rows with one key are words one edit apart, in the order in which each pair counts once."""
    a_role, b_role, a_word, b_word = (F.col(f"{x}.{c}") for c in ("role", "word") for x in (a, b))
    order = ((a_role == SAME) & (b_role == SAME) & (a_word < b_word)) | ((a_role == SHORT) & (b_role == LONG))
    return order & (F.levenshtein(a_word, b_word, 1) == 1)


PAIR = ["a.word", "a.n", "b.word AS near", "b.n AS n_of_near"]


def matched(rows: DataFrame) -> DataFrame:
    """Pairs of rows with one key, for keys with at most ``GROUP`` rows: ``word, n, near, n_of_near``."""
    groups = rows.groupBy("key").agg(F.collect_list(F.struct("role", "word", "n")).alias("rows"))
    pairs = groups.select("rows", F.explode("rows").alias("a")).filter(F.col("a.role") != LONG).select("a", F.explode("rows").alias("b"))
    return pairs.filter(fitting("a", "b")).selectExpr(*PAIR)


def joined(rows: DataFrame) -> DataFrame:
    """The same for keys with more rows."""
    a, b = rows.alias("a"), rows.alias("b")
    return a.join(b, (F.col("a.key") == F.col("b.key")) & fitting("a", "b")).selectExpr(*PAIR)


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of words one edit apart, each pair once: ``word, n, near, n_of_near``."""
    @arrow_udf("array<bigint>")
    def rest_keys(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for word, role, key in parts:
            yield rests(word, role, key)

    # a vocabulary is a small file with much to do: at least one part for every core
    rows = signed(words.repartition(2 * words.sparkSession.sparkContext.defaultParallelism))
    # signatures of a single word cannot match
    sizes = stored(rows.groupBy("key").count().filter("count > 1"), "signatures")
    # the planner takes exploded rows for few: it shall not send them to all tasks
    shared = rows.hint("merge").join(sizes, "key")
    small = matched(shared.filter(F.col("count") <= GROUP))
    large = shared.filter(F.col("count") > GROUP).withColumn("rests", rest_keys("word", "role", "key"))
    large = joined(stored(large.select(F.explode("rests").alias("key"), "role", "word", "n"), "rests"))
    return small.union(large).dropDuplicates(["word", "near"])


def forms(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """For a table of ``word`` and ``n``: ``word, n, n_near, form, form_n, root``.

    ``form`` is the most frequent word one edit away, if it is at least ``factor`` times as frequent; ``root`` follows forms to the last.
    """
    if factor < 2:
        raise ValueError("a form must be more frequent")
    words = stored(words.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    pairs = near_words(words)
    ways = F.array(F.struct("word", "near", F.col("n_of_near").alias("near_n")), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = pairs.select(F.explode(ways).alias("way")).select("way.*").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    form_n = -F.col("best.less")
    has_form = form_n >= factor * F.col("n")
    judged = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, form_n).alias("form_n")), "forms")
    top = judged.agg(F.max("form_n")).first()[0] or 1
    hops = max(1, int(math.log(top, factor)) + 1)  # forms in a row
    to = judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(hops))):
        onward = to.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        to = stored(to.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots")
    return judged.join(to, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
