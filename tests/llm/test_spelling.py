"""Spelling variants against all pairs."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import queries, spelling


def one_edit(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_forms(counts, factor=10):
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], [ord(c) for c in o]), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def vocabulary(seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(150)}
    for w in list(words):
        for _ in range(3):
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abxß") + w[i:], w[:i] + rng.choice("abxß") + w[i + 1:]]))
    words.discard("")
    return {w: rng.choice([2, 3, 5, 40, 500, 6000, 70000]) for w in sorted(words)}


@pytest.mark.parametrize("group", [0, 3, 32])
def test_forms_equal_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(spelling, "GROUP", group)
    counts = vocabulary(group)
    rows = [(w, n, 1) for w, n in counts.items()]
    rows += [(None, 5, 1), ("abc", None, 1)]
    twice = [(w, n - 1, 1) for w, n, _ in rows[:20]] + [(w, 1, 2) for w, _, _ in rows[:20]] + rows[20:]
    assert result(spelling.forms(spark.createDataFrame(twice, "word string, n long, form int"))) == plain_forms(counts)


def test_one_large_family_is_split_and_not_paired(spark):
    # many words with one first half, one length and the same letters but for two: one signature holds them all
    rng = random.Random(5)
    counts = {"prefix" + "".join(p): rng.choice([2, 30, 900]) for p in itertools.islice(itertools.permutations("abcdefg"), 800)}
    counts |= {w[:9] + "x" + w[10:]: 3 for w in list(counts)[:200]}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    keys = spelling.signed(words).groupBy("key").count()
    assert keys.agg({"count": "max"}).first()[0] > 10 * spelling.GROUP
    assert result(spelling.forms(words)) == plain_forms(counts)


def test_nothing_and_one_word(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert result(spelling.forms(empty)) == []
    assert result(spelling.forms(spark.createDataFrame([("alone", 2), ("", 3), ("x" * 30000, 4), ("x" * 30001, 40)], "word string, n long"))) == sorted(
        [("alone", None, "alone", 2, 0, None), ("", None, "", 3, 0, None), ("x" * 30000, "x" * 30001, "x" * 30001, 4, 1, 40), ("x" * 30001, None, "x" * 30001, 40, 1, None)])
    with pytest.raises(ValueError):
        spelling.forms(empty, factor=1)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcé", max_size=12), st.integers(0, 12), st.sampled_from("abcéz"), st.sampled_from(["insert", "delete", "replace"]))
def test_words_one_edit_apart_share_a_signature(word, place, letter, edit):
    place = min(place, len(word))
    other = {"insert": word[:place] + letter + word[place:], "delete": word[:place] + word[place + 1:], "replace": word[:place] + letter + word[place + 1:]}[edit]
    if not one_edit(word, other):
        return
    a, b = sorted([word, other], key=len)
    roles = (spelling.SAME, spelling.SAME) if len(a) == len(b) else (spelling.SHORT, spelling.LONG)
    keys = [set(spelling.signatures(pa.array([w]), r).to_pylist()[0]) for w, r in zip((a, b), roles, strict=True)]
    assert keys[0] & keys[1]
    rests = [set(spelling.rests(pa.array([w]), pa.array([r]), pa.array([77])).to_pylist()[0]) for w, r in zip((a, b), roles, strict=True)]
    assert rests[0] & rests[1]


def test_signatures_follow_the_choices():
    parts = np.array([[1, 2, 3, 4], [1, 2, 9, 9], [1, 9, 9, 9]], dtype=np.uint64)
    shared = spelling.part_enum(parts, 2)
    assert shared.shape == (3, 6) and (shared[0] == shared[1]).sum() == 1 and (shared[0] == shared[2]).sum() == 0


def test_the_query_deletes_letters_first(spark, tmp_path):
    rng = random.Random(2)
    words = ["".join(rng.choice("aeinrst") for _ in range(8)) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(words + ["Überall7", "STRASSEN", "naïveté", "naïvetés-kurz"]) for _ in range(30))) for i in range(300)] + [(None, words[0]), (7, None), (8, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
    want = plain_forms({w: n for w, n in counts.items() if n >= 2})
    assert result(queries.QUERIES["op13_spelling_forms"](spark, str(tmp_path))) == want and sum(w[1] is not None for w in want) > 20
