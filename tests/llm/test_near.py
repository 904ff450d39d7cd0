"""Near-duplicate classes against all pairs by brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import graph, near
from millrace.llm.common import mixed, word_hashes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def classes_by_pairs(texts):
    sets = {}
    for i, t in texts:
        w = WORDS.findall(t or "")
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(400)]
    texts = []
    for base in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([4, 30, 120, 300]))]
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 3, 12])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 20])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append("  \n".join(copy) if rng.random() < 0.3 else " ".join(copy))
    return list(enumerate(texts))


def test_classes_equal_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near.near_duplicates(docs).collect()}
    assert got == classes_by_pairs(texts)


def test_one_row_of_each_class_stays(spark):
    texts = corpus(5)
    docs = spark.createDataFrame([(i, t, "x", i * 2) for i, t in texts] + [(0, texts[0][1], "x", 0)], "doc_id long, text string, content string, label int")
    kept = near.deduplicate(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id, r.text, r.label) for r in kept.collect())
    want = classes_by_pairs(texts)
    assert got == sorted((i, t, i * 2) for i, t in texts if want[i] == i)


def test_nulls_empty_and_short_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (6, "a c"), (None, "a b"), (None, None), (7, "x " * 5000), (8, "x " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id) for r in near.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (None, 4), (None, None), (7, 7), (8, 7)], key=str)
    assert near.deduplicate(docs).count() == 7
    assert near.near_duplicates(docs.limit(0)).count() == 0


def test_alignment_needs_order():
    def words(text):
        return mixed(next(word_hashes(pa.array([text])))[1])

    rng = random.Random(1)
    first = [f"w{rng.randrange(1000)}" for _ in range(200)]
    a, b = " ".join(first), " ".join(first[100:] + first[:100])
    assert near.aligned(words(a), words(a)) == 1.0
    assert near.aligned(words(a), words(b)) == 0.0
    assert near.aligned(words(a), words(a + " tail of some words")) > 0.9
    assert near.aligned(words(""), words(a)) == 0.0


def test_elements_of_repeated_shingles_differ():
    words = np.array([7] * 40, dtype=np.uint64)
    assert len(set(near.elements(words).tolist())) == 36


@pytest.mark.parametrize("n", [1, 2, 5, 6, 500])
def test_sketches_of_any_length(n):
    items = near.elements(np.arange(n, dtype=np.uint64))
    assert len(near.sketches(items)) == near.SKETCHES and (near.sketches(items) == near.sketches(items.copy())).all()


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, **{i: 200 for i in range(200, 203)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_large_families_equal_brute_force(spark):
    rng = random.Random(11)
    texts = []
    for i in range(400):  # all of one template, about as alike as the similarity asks for
        words = [f"base{k}" for k in range(240)]
        for k in rng.sample(range(240), 3 + i % 3):
            words[k] = f"own{i}x{k}"
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near.near_duplicates(docs).collect()}
    assert got == classes_by_pairs(texts)


def test_short_texts_equal_brute_force(spark):
    rng = random.Random(7)
    texts = []
    for size in [8, 9, 9, 10, 12, 14, 20, 30] * 40:  # each with one word more at an end
        words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [" ".join(words), " ".join([*words, "end"] if rng.random() < 0.5 else ["start", *words])]
    texts = list(enumerate(texts))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = classes_by_pairs(texts)
    assert len(set(want.values())) == len(texts) // 2
    assert {r.doc_id: r.class_id for r in near.near_duplicates(docs).collect()} == want
