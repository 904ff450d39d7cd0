"""Token counts with a shortcut for words that are one token.

``whole_tokens`` proves, once and with the tokenizer itself, which strings of the vocabulary come out as exactly one token
when they are encoded alone. Counting then splits a text into words at ASCII white space, which this tokenizer drops, and
words into pre-tokens; a proven pre-token counts 1 without being merged, everything else is encoded. The number of tokens
of a word is kept, so a word that comes again costs a look-up.

The shortcut is taken for plain ASCII words only: letters, digits and signs are told apart by the tokenizer's own pattern,
and normalisation is lower-casing there. A word with any other character, or with ``<|``, which may begin a special token,
is encoded whole by the library, so special strings inside texts are treated as the library does by default. No token is
added, nothing is truncated or padded.

Defined cases: null is an empty text (0 bytes, 0 tokens); very long texts are counted whole, and what is remembered is bounded in bytes; an empty
table gives an empty table; there are no ties; repeated rows are counted one by one; columns of the input with
the names of results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from tokenizers import Tokenizer

from millrace.llm.common import without

LIMIT = 2048
CACHE_WORDS = 500_000
CACHED_BYTES = 64       # longer words are not remembered

# fixed: the tokenizer's own pre-token pattern, on lower-cased ASCII
PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
PLAIN = re.compile(rb"[\x21-\x7e]+")


def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def whole_tokens(path: str) -> frozenset[bytes]:
    """Plain lower-case strings of the vocabulary that are one token alone; bounded by the vocabulary."""
    tokenizer = load(path)
    words = sorted({w[:-4] for w in tokenizer.get_vocab() if w.endswith("</w>") and re.fullmatch(r"[!-~]+", w[:-4]) and w[:-4] == w[:-4].lower()})
    words = [w for w in words if PIECES.fullmatch(w.encode())]
    encoded = tokenizer.encode_batch(words, add_special_tokens=False)
    return frozenset(w.encode() for w, e in zip(words, encoded, strict=True) if len(e.ids) == 1)


class Counts(dict):
    """UTF-8 word of at most ``CACHED_BYTES`` -> number of its tokens; emptied when it has grown to ``limit`` words."""

    def __init__(self, tokenizer: Tokenizer, whole: frozenset[bytes], limit: int = CACHE_WORDS):
        super().__init__()
        self.tokenizer, self.whole, self.limit = tokenizer, whole, limit

    def encoded(self, text: bytes) -> int:
        return len(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def __missing__(self, word: bytes) -> int:
        if PLAIN.fullmatch(word) and b"<|" not in word:
            n = 0
            for piece in PIECES.findall(word.lower()):
                n += 1 if piece in self.whole else self.encoded(piece)
        else:
            n = self.encoded(word)
        if len(word) <= CACHED_BYTES:
            if len(self) >= self.limit:
                self.clear()
            self[word] = n
        return n

    def of(self, text: bytes) -> int:
        return sum(map(self.__getitem__, text.split()))


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``; ``path`` must be readable on every executor."""
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    @arrow_udf("bigint")
    def tokens(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = Counts(load(path), whole.value)
        for part in texts:
            yield pa.array([counts.of(t) for t in part.cast(pa.binary()).to_pylist()], pa.int64())

    body = F.coalesce(F.col(text), F.lit(""))
    kept = without(docs, [c for c in ("n_bytes", "n_tokens", "over_limit") if c != text])
    return kept.withColumn("n_bytes", F.octet_length(body).cast("long")).withColumn("n_tokens", tokens(body)) \
        .withColumn("over_limit", F.col("n_tokens") > limit)
