"""Ids and texts against the library."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = bpe.Vocabulary(PATH)
CASES = ["Hello <|endoftext|>World foo  <|endoftext|>bar <|ENDOFTEXT|>", "<|endoftext|>", "don't I'LL 's '' ''' it's' a'sb 12ab3",
         "İstanbul ΣΑΣ ﬀ ½ \x1c\x1dfoo\x85bar　x", "", "   ", None, "a  b \n c\n\n d  \n", " x", "  x", "\n", "x \n", "a" * 5000, "ab" * 3000,
         "xyz " * 10 + "  ", "\U0003fc3b a՘", "é" * 2000, "hello" * 900, "東京 नमस्ते สวัสดี", "a b \U0001f600\U0001f600 naïve-café", "\x00\x01a\x7f b\x00", " " * 3000, "word " * 3000]


def of_library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("size", [2 << 20, 50])
def test_ids_and_texts_equal_the_library(spark, monkeypatch, size):
    monkeypatch.setattr(bpe, "GROUP_BYTES", size)
    docs = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(CASES)] * 2, "doc_id long, text string, Token_Ids string").repartition(3)
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    got = out.collect()
    assert len(got) == 2 * len(CASES) and out.columns == ["doc_id", "text", "token_ids", "decoded_text"]
    for r in got:
        want = of_library(CASES[r.doc_id])
        assert r.token_ids == want and r.text == CASES[r.doc_id]
        assert r.decoded_text == LIBRARY.decode(want, skip_special_tokens=False)
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_the_query_digests_the_operator(spark, tmp_path):
    spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.QUERIES["op12_bpe"](spark, str(tmp_path)).collect():
        ids = of_library(CASES[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


ENCODER = bpe.Encoder(VOCABULARY, cache_bytes=5000)


@settings(max_examples=500, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(max_size=60) | st.text(alphabet="abcXYZ019'.,<|>stmrelvd \n\t\x1c\x85é\xa0", max_size=60))
def test_any_text_equals_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    ids, ends = ENCODER([text, "", text])
    assert ids[:ends[1]].tolist() == ids[ends[2]:].tolist() == of_library(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abeinrst", min_size=1, max_size=300))
def test_rounds_and_queue_give_the_same(text):
    symbols = VOCABULARY.first[np.frombuffer(text.encode(), dtype=np.uint8)]
    rounds, _ = bpe.merge_rounds(VOCABULARY, symbols, np.zeros(len(symbols), dtype=np.int64))
    assert rounds.tolist() == bpe.merge_long(VOCABULARY, symbols).tolist() == of_library(text)


def toy(pairs, in_order):
    """A vocabulary of three letters and some merges, given by ids."""
    out = object.__new__(bpe.Vocabulary)
    out.size, out.in_order = 100, in_order
    keys = np.array([a * 100 + b for a, b, _ in pairs])
    order = np.argsort(keys)
    out.keys, out.ranks, out.results = keys[order], order, np.array([c for _, _, c in pairs])
    return out


def one_by_one(vocabulary, symbols):
    """The lowest pair, leftmost first, until there is none."""
    ranks = {k: (r, vocabulary.results[r]) for k, r in zip(vocabulary.keys.tolist(), vocabulary.ranks.tolist(), strict=True)}
    symbols = list(symbols)
    while True:
        found = [(*ranks[a * 100 + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a * 100 + b in ranks]
        if not found:
            return symbols
        _, made, i = min(found, key=lambda f: (f[0], f[2]))
        symbols[i:i + 2] = [made]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40))
def test_merges_that_are_out_of_order_go_one_by_one(symbols):
    # 3 comes from two pairs, and a pair with 3 ranks between them
    vocabulary = toy([(0, 1, 3), (3, 0, 4), (1, 2, 3), (3, 3, 5)], in_order=False)
    array = np.array(symbols, dtype=np.int64)
    got, _ = bpe.merge_rounds(vocabulary, array, np.zeros(len(array), dtype=np.int64))
    assert got.tolist() == one_by_one(vocabulary, symbols) == bpe.merge_long(vocabulary, array).tolist()


def test_bytes_that_are_no_text_and_unknown_ids():
    byte = {b: int(i) for b, i in enumerate(VOCABULARY.first)}
    lists = [[byte[0xC3]], [byte[0xF0], byte[0x9F], byte[0x41]], [], None, [byte[0xC3], byte[0xA9]]]
    got = [t for part in bpe.decoded_texts(VOCABULARY, pa.array(lists, pa.list_(pa.int32()))) for t in part.to_pylist()]
    assert got == [LIBRARY.decode(ids or [], skip_special_tokens=False) for ids in lists]
    with pytest.raises(ValueError):
        list(bpe.decoded_texts(VOCABULARY, pa.array([[VOCABULARY.size]], pa.list_(pa.int32()))))


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
