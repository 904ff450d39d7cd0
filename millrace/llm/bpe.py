"""Byte-level BPE: texts to token ids and back, with the merges done for many words at once in numpy.

A text is cut before every space that is followed by something visible; such a place always begins a pre-token, so the
parts can be encoded alone and remembered. Parts that have not come before are split into pre-tokens, and all their
different pre-tokens become symbols in one flat array. In every round the pair of every two neighbours is looked up in the
sorted keys of the merges by binary search, the lowest rank of each word is found, all its places in that word are merged
and the array is closed up; words leave the array when they have no pair left. Very long words would need thousands of
rounds over the whole array; they are merged rank by rank from a queue of places instead (``merge_long``), with the same
result. Decoding gathers the bytes of all tokens from one flat table.

Added tokens inside a text are recognised as the library does by default; none are added, nothing is truncated or padded.
Pre-tokens with code points that were unassigned in the Unicode version of this Python are split by the library's own
splitter, since its tables may be older or newer.

Defined cases: a null text is empty and has no ids; repeated rows are encoded one by one; empty tables give empty tables;
columns with the name of a result are replaced, all others are kept. Bytes that are no UTF-8 decode to U+FFFD. Long texts
are handled whole, in memory of a few dozen bytes per byte of text; what is remembered between texts is bounded by bytes.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from tokenizers import pre_tokenizers

from millrace.llm.common import without

GROUP_BYTES = 2 << 20     # text encoded together
CACHE_BYTES = 48 << 20    # parts remembered between groups
LONG = 512                # symbols from which a word is merged rank by rank

# fixed: the pre-token pattern of byte-level vocabularies
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CUT = re.compile(r" (?=\S)")
UNEVEN = re.compile(r" (?!\S)")


def byte_chars() -> list[str]:
    """The visible character that stands for each byte in the vocabulary: itself if it is visible, else the next one from 256."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    out = {b: chr(b) for b in visible}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return [out[b] for b in range(256)]


def unassigned(text: str) -> bool:
    return not text.isascii() and any(unicodedata.category(c) == "Cn" for c in text)


def gather(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``rows`` of a flat table of lists, one after the other, and where each begins and ends."""
    lengths = offsets[rows + 1] - offsets[rows]
    ends = np.r_[0, np.cumsum(lengths)]
    at = np.repeat(offsets[rows] - ends[:-1], lengths) + np.arange(ends[-1])
    return values[at], ends


class Vocabulary:
    """What a ``tokenizers`` file says about symbols, merges and added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, splitter = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True) \
                or spec.get("normalizer") or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("only plain byte-level BPE is supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take neighbours along are not supported")
        ids = model["vocab"]
        chars = byte_chars()
        self.first = np.array([ids[c] for c in chars], dtype=np.int64)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max([*ids.values(), *self.added.values()]) + 1
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], dtype=np.int64)
        results = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        # a pair that can appear after a merge must have a higher rank than that merge: then all places of one rank go together
        made = {int(r): n for n, r in reversed(list(enumerate(results.tolist())))}
        self.in_order = len(made) == len(results) and all(
            made.get(k // self.size, -1) < n and made.get(k % self.size, -1) < n for n, k in enumerate(keys.tolist()))
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.results = keys[order], order.astype(np.int64), results
        byte_of = {c: b for b, c in enumerate(chars)}
        spelled = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()}
        spelled |= {i: t.encode() for t, i in self.added.items()}
        table = [spelled.get(i, b"") for i in range(self.size)]
        self.bytes = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.byte_offsets = np.r_[0, np.cumsum([len(t) for t in table])].astype(np.int64)

    @property
    def none(self) -> int:
        return len(self.results)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``none`` where it is no merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)


def _first_of_overlaps(at: np.ndarray, overlap: np.ndarray) -> np.ndarray:
    """Of places in ascending order, where ``overlap[i]`` says that place i touches the one before: every second of a chain."""
    begin = np.flatnonzero(~overlap)
    nth = np.arange(len(at)) - np.repeat(begin, np.diff(np.r_[begin, len(at)]))
    return at[nth % 2 == 0]


def merge_rounds(vocabulary: Vocabulary, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge all words of a flat array; ``word`` numbers the word of each symbol in ascending order."""

    def ranks_at(places: np.ndarray) -> np.ndarray:
        """The ranks of the pairs that begin at some places; the last symbol of a word begins none."""
        after = np.minimum(places + 1, len(symbols) - 1)
        found = vocabulary.rank(symbols[places], symbols[after])
        return np.where((after > places) & (word[places] == word[after]), found, vocabulary.none)

    done_symbols, done_words = [symbols[:0]], [word[:0]]
    symbols = symbols.copy()
    rank = ranks_at(np.arange(len(symbols)))
    while len(symbols):
        begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        least = np.minimum.reduceat(rank, begin)
        sizes = np.diff(np.r_[begin, len(symbols)])
        open_ = least < vocabulary.none
        if not open_.all():
            kept = np.repeat(open_, sizes)
            done_symbols.append(symbols[~kept])
            done_words.append(word[~kept])
            symbols, word, rank = symbols[kept], word[kept], rank[kept]
            least, sizes = least[open_], sizes[open_]
            if not len(symbols):
                break
        at = np.flatnonzero(rank == np.repeat(least, sizes))
        if vocabulary.in_order:
            at = _first_of_overlaps(at, np.r_[False, np.diff(at) == 1])
        else:
            at = at[np.r_[True, word[at][1:] != word[at][:-1]]]
        symbols[at] = vocabulary.results[rank[at]]
        kept = np.ones(len(symbols), dtype=bool)
        kept[at + 1] = False
        symbols, word, rank = symbols[kept], word[kept], rank[kept]
        # only pairs next to a merged symbol have changed
        at -= np.arange(len(at))
        changed = np.concatenate([at, at[at > 0] - 1])
        rank[changed] = ranks_at(changed)
    symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(word, kind="stable")  # a word leaves in one round, so its symbols stay in order
    return symbols[order], word[order]


def merge_long(vocabulary: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """Merge one long word: the places of each rank wait in a queue, all of the lowest rank are merged at once."""
    if not vocabulary.in_order:
        return merge_rounds(vocabulary, symbols, np.zeros(len(symbols), dtype=np.int64))[0]
    symbols = symbols.copy()
    n = len(symbols)
    following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    alive = np.ones(n, dtype=bool)
    waiting: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def wait(places: np.ndarray) -> None:
        places = places[following[places] < n]
        ranks = vocabulary.rank(symbols[places], symbols[following[places]])
        hit = ranks < vocabulary.none
        places, ranks = places[hit], ranks[hit]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        begin = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]) if len(ranks) else []
        for part, r in zip(np.split(places, begin[1:]) if len(ranks) else [], ranks[begin].tolist() if len(ranks) else [], strict=True):
            if r not in waiting:
                heapq.heappush(queue, r)
            waiting.setdefault(r, []).append(part)

    wait(np.arange(n))
    while queue:
        r = heapq.heappop(queue)
        places = np.unique(np.concatenate(waiting.pop(r)))
        places = places[alive[places]]
        places = places[following[places] < n]
        places = places[vocabulary.rank(symbols[places], symbols[following[places]]) == r]
        if not len(places):
            continue
        places = _first_of_overlaps(places, np.r_[False, following[places[:-1]] == places[1:]])
        gone = following[places]
        symbols[places] = vocabulary.results[r]
        alive[gone] = False
        after = following[gone]
        following[places] = after
        inner = after < n
        before[after[inner]] = places[inner]
        left = before[places]
        wait(np.unique(np.r_[places, left[left >= 0]]))
    return symbols[alive]


def merge_words(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after the other, and where each word's begin and end."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    symbols = vocabulary.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
    word = np.repeat(np.arange(len(words)), sizes)
    long = np.repeat(sizes > LONG, sizes)
    parts, numbers = merge_rounds(vocabulary, symbols[~long], word[~long])
    if long.any():
        ends = np.cumsum(sizes)
        extra = [(n, merge_long(vocabulary, symbols[ends[n] - sizes[n]:ends[n]])) for n in np.flatnonzero(sizes > LONG).tolist()]
        parts = np.concatenate([parts, *[e for _, e in extra]])
        numbers = np.concatenate([numbers, *[np.full(len(e), n) for n, e in extra]])
        order = np.argsort(numbers, kind="stable")
        parts, numbers = parts[order], numbers[order]
    return parts, np.searchsorted(numbers, np.arange(len(words) + 1))


class Numbers(dict):
    """Part -> number; a part that is asked for the first time gets the next number and waits to be encoded."""

    def __init__(self, encoder: Encoder, lead: str):
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, part: str) -> int:
        n = self[part] = self.encoder.count
        self.encoder.count += 1
        self.encoder.fresh.append(self.lead + part)
        return n


class Encoder:
    """Texts to ids; remembers the ids of parts until they take ``cache_bytes``."""

    def __init__(self, vocabulary: Vocabulary, cache_bytes: int = CACHE_BYTES):
        self.vocabulary, self.cache_bytes = vocabulary, cache_bytes
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.forget()

    def forget(self) -> None:
        self.heads, self.tails = Numbers(self, ""), Numbers(self, " ")  # parts without and with a space before them
        self.fresh: list[str] = []
        # the first numbers are those of the added tokens
        self.values = np.array(list(self.vocabulary.added.values()), dtype=np.int64)
        self.offsets = np.arange(len(self.values) + 1)
        self.count = len(self.values)
        self.size = 0

    def pieces(self, part: str) -> list[str]:
        if unassigned(part):
            return [part[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(part)]
        return PIECES.findall(part)

    def split(self, parts: list[str]) -> tuple[list[str], np.ndarray]:
        """The pre-tokens of all parts and how many each part has."""
        if unassigned("".join(set("".join(parts)))) or not all(map(CUT.match, parts)):
            pieces = [self.pieces(p) for p in parts]
            return [x for p in pieces for x in p], np.array([len(p) for p in pieces], dtype=np.int64)
        # parts that begin with a space and something visible keep their pre-tokens when they stand in a row
        pieces = PIECES.findall("".join(parts))
        ends = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))
        until = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))
        return pieces, np.diff(np.r_[0, np.searchsorted(ends, until, side="right")])

    def numbers(self, text: str) -> list[int]:
        """The numbers of the parts of a text without added tokens."""
        cut = CUT.split(text) if UNEVEN.search(text) else text.split(" ")
        head = [self.heads[cut[0]]] if cut[0] else []
        return head + [*map(self.tails.__getitem__, cut[1:])]

    def numbered(self, text: str) -> list[int]:
        added = self.vocabulary.added_pattern
        if added is None or not added.search(text):
            return self.numbers(text)
        names = list(self.vocabulary.added)
        return [n for nth, piece in enumerate(added.split(text)) for n in ([names.index(piece)] if nth % 2 else self.numbers(piece) if piece else [])]

    def learn(self) -> None:
        """Encode the parts that are new and append them to the table."""
        if not self.fresh:
            return
        tail = np.array([CUT.match(p) is not None for p in self.fresh])
        order, heads = np.argsort(tail, kind="stable"), len(tail) - int(tail.sum())
        some, few = self.split([self.fresh[i] for i in order[:heads]]) if heads else ([], np.empty(0, dtype=np.int64))
        rest, many = self.split([self.fresh[i] for i in order[heads:]]) if heads < len(order) else ([], np.empty(0, dtype=np.int64))
        known: dict[str, int] = {}
        rows = np.array([known.setdefault(p, len(known)) for p in some + rest], dtype=np.int64)
        ids, begins = merge_words(self.vocabulary, [p.encode() for p in known])
        ids, ends = gather(ids, begins, rows)
        # back into the order of the numbers
        ends = ends[np.r_[0, np.cumsum(np.r_[few, many])].astype(np.int64)]
        ids, ends = gather(ids, ends, np.argsort(order, kind="stable"))
        self.values = np.concatenate([self.values, ids])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + ends[1:]])
        # what a part takes: its characters, two objects and its ids
        self.size += sum(map(len, self.fresh)) + 200 * len(self.fresh) + 8 * len(ids)
        self.fresh = []

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and where each text's begin and end."""
        rows, counts = [], []
        for text in texts:
            numbers = self.numbered(text) if text else []
            rows.append(np.array(numbers, dtype=np.int64))
            counts.append(len(numbers))
        self.learn()
        ids, ends = gather(self.values, self.offsets, np.concatenate(rows) if rows else np.empty(0, dtype=np.int64))
        if self.size > self.cache_bytes:
            self.forget()
        return ids, ends[np.r_[0, np.cumsum(counts)].astype(np.int64)]


def groups(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` in sum, at least one row each."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
        yield at, stop
        at = stop


def encoded_lists(encoder: Encoder, texts: pa.Array) -> Iterator[pa.Array]:
    """A column of texts as lists of ids, in pieces of about ``GROUP_BYTES`` of text."""
    texts = texts.cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for a, b in groups(sizes, GROUP_BYTES):
        ids, ends = encoder([t.decode("utf-8", "replace") if t else "" for t in texts.slice(a, b - a).to_pylist()])
        yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))


def decoded_texts(vocabulary: Vocabulary, lists: pa.Array) -> Iterator[pa.Array]:
    """A column of lists of ids as texts, in pieces of about ``GROUP_BYTES`` ids; a null list is an empty text."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for a, b in groups(sizes, GROUP_BYTES):
        ids = lists.slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
        if len(ids) and (ids.min() < 0 or ids.max() >= vocabulary.size):
            raise ValueError("an id outside the vocabulary")
        data, at = gather(vocabulary.bytes, vocabulary.byte_offsets, ids)
        whole, cuts = data.tobytes(), at[np.r_[0, np.cumsum(sizes[a:b])]].tolist()
        yield pa.array([whole[x:y].decode("utf-8", "replace") for x, y in zip(cuts, cuts[1:], strict=False)], pa.string())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each text; the file must be readable where the driver runs, tasks get its contents."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    @arrow_udf("array<int>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary.value)
        for part in texts:
            yield from encoded_lists(encoder, part)

    kept = without(docs, [ids] if ids.lower() != text.lower() else [])
    return kept.withColumn(ids, run(F.coalesce(F.col(text), F.lit(""))))


def decode(df: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded_text") -> DataFrame:
    """``df`` with the text of each list of ids, added tokens included."""
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path))

    @arrow_udf("string")
    def run(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in lists:
            yield from decoded_texts(vocabulary.value, part)

    kept = without(df, [text] if ids.lower() != text.lower() else [])
    return kept.withColumn(text, run(F.col(ids)))
