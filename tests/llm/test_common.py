"""Word hashes and windows over any split into blocks."""

import re

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import common

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["one two  three", "", "   ", "\n\x0btabs\tand\x0cfeeds\r", "é ñandú 東京 x", "a" * 200 + " b", "no\xa0break\x85here", "end ", " start"]


@pytest.mark.parametrize("size", [1 << 20, 64, 8])
def test_word_hashes_follow_the_words(monkeypatch, size):
    monkeypatch.setattr(common, "BLOCK_BYTES", size)
    common._tables.clear()
    got = dict(common.word_hashes(pa.array(TEXTS)))
    common._tables.clear()
    seen = {}
    for row, text in enumerate(TEXTS):
        words = WORDS.findall(text)
        assert len(got[row]) == len(words)
        if size == 1 << 20:
            for value, word in zip(got[row].tolist(), words, strict=True):
                assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_a_long_text_is_hashed_in_parts_like_a_short_one(monkeypatch):
    text = " ".join(f"w{i % 7}" for i in range(300))
    whole = dict(common.word_hashes(pa.array([text, "w1 w2"])))
    monkeypatch.setattr(common, "BLOCK_BYTES", 256)
    parts = dict(common.word_hashes(pa.array([text, "w1 w2"])))
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_sliced_column():
    column = pa.array(["skip this", "a b", "b"]).slice(1)
    got = dict(common.word_hashes(column))
    assert len(got[0]) == 2 and got[0][1] == got[1][0]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 20])
def test_window_hashes_are_those_of_the_windows(size):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 4, 60).astype(np.uint64)
    got = common.window_hashes(values, size)
    assert len(got) == 60 - size + 1
    by_words = {}
    for i, h in enumerate(got.tolist()):
        assert by_words.setdefault(tuple(values[i:i + size].tolist()), h) == h
    assert len(set(by_words.values())) == len(by_words)
    assert len(common.window_hashes(values[:size - 1], size)) == 0
