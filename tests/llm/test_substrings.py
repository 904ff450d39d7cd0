"""Removal of repeated word sequences against a plain scan."""

import random
import re

import pytest

from millrace.llm import substrings

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k:k + 20])
            if window in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(window)
        out[i] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([19, 20, 21, 35, 80]))] for _ in range(6)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))] if rng.random() < 0.5 else rng.choice(passages)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(100, "same " * 70), (101, "same " * 30), (102, "a b " * 40), (103, rows[3][1]), (None, rows[4][1] + " " + "same " * 25)]
    return rows


@pytest.mark.parametrize("group, rows_at_once", [(1000, 20_000), (3, 40), (0, 7)])
def test_equals_plain_scan(spark, monkeypatch, group, rows_at_once):
    monkeypatch.setattr(substrings, "GROUP", group)
    monkeypatch.setattr(substrings, "ROWS", rows_at_once)
    monkeypatch.setattr(substrings, "COMBINED", rows_at_once)
    rows = corpus(group)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substrings.remove_repeats(docs).collect()}
    assert got == plain(rows)


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 1 << 6)
    rows = corpus(11)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substrings.remove_repeats(docs).collect()}
    assert got == plain(rows)


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None, 0), (2, "", 0), (3, long, 0), (3, long, 1), (4, long, 0), (None, long + " tail", 0), (None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, places int")
    out = substrings.remove_repeats(docs)
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in out.collect()), key=str)
    assert got == sorted([(1, 0, 0), (2, 0, 0), (3, 40, 0), (3, 40, 0), (4, 40, 40), (None, 41, 40), (None, 0, 0)], key=str)
    assert "places" in out.columns and substrings.remove_repeats(docs.limit(0)).count() == 0
