"""Runs and extensions against plain scans."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.llm import periodic, queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=6, times=4):
    """Every stretch that keeps a period, by trying all periods; of equal stretches the one with the smallest period."""
    n, best = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, times * p):
                best.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted((s, size, p) for (s, size), p in best.items())


def plain_collapse(words, runs):
    lost = {i for s, size, p in runs for i in range(s + p, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in lost)


def plain_row(doc_id, text):
    words = WORDS.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    longest = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{size},{p}\n" for s, size, p in runs), plain_collapse(words, runs))]
    return (len(runs), *longest, longest[0] if longest[0] is None else 1000 * longest[1] // longest[2], *sha)


CASES = ["a b c d e f", "x " * 6, "x " * 5, "a b a b a b a b", "a b a b a b a", "", "  \n ", None, "one a a a a a a b b b b b b two", "x y x y x y x y x x x x x x y x y x y x y",
         "a b c " * 40 + "q " + "a b c " * 4, ("p q " * 5 + "r ") * 6, "é\xa0é\x85 " * 7, "w " * 20000, " ".join(f"u{i}" for i in range(5000)) + " " + "k l m " * 900]


def test_the_operator_equals_a_plain_scan(spark):
    docs = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(CASES)] * 2, "doc_id long, text string, RUNS string").repartition(3)
    out = periodic.collapse_runs(docs)
    assert out.columns == ["doc_id", "text", "n_words", "runs", "collapsed_text"]
    got = out.collect()
    assert len(got) == 2 * len(CASES)
    for r in got:
        words = WORDS.findall(CASES[r.doc_id] or "")
        want = [(0, len(words), 1)] if words == ["w"] * 20000 else [(5000, 2700, 3)] if len(words) == 7700 else plain_runs(words)
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == want, r.doc_id
        assert r.collapsed_text == plain_collapse(words, want)
    assert periodic.collapse_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.collapse_runs(docs, times=1)


def test_the_query_digests_the_operator(spark, tmp_path):
    rows = [(i, CASES[i % 13] if i % 3 else " ".join(f"v{j % (i + 1)}" for j in range(i))) for i in range(400)] + [(None, "n n n n n n n")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_recompression_runs"](spark, str(tmp_path)).collect()
    assert len(got) == 401 and sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(400)) > 20
    texts = dict(rows)
    for r in got:
        if r.doc_id is not None:
            assert tuple(r)[1:] == plain_row(r.doc_id, texts[r.doc_id]), r.doc_id
        else:
            assert (r.n_runs, r.start, r.length, r.period) == (1, 0, 7, 1)


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(0, 2), max_size=60) | st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 12)).map(lambda t: t[0] * t[1]), max_size=8),
       st.sampled_from([(6, 4), (2, 2), (1, 3), (9, 4)]))
def test_any_documents(documents, bounds):
    got = periodic.runs_of([np.array(d, dtype=np.int64) for d in documents], *bounds)
    assert [[tuple(r) for r in g.tolist()] for g in got] == [plain_runs(d, *bounds) for d in documents]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=1, max_size=120), st.integers(0, 3))
def test_extensions_of_all_pairs(values, cuts):
    rng = np.random.default_rng(len(values))
    array = np.array(values, dtype=np.int64) + 10
    where = sorted(set(rng.integers(0, len(array), cuts).tolist()))
    array[where] = np.arange(len(where))
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(array)), np.arange(len(array))))
    i, j = i[i != j], j[i != j]
    grammar = periodic.Grammar(array, len(where))
    right, left = grammar.right(i, j), grammar.left(i, j)
    for x, y, r, n in zip(i.tolist(), j.tolist(), right.tolist(), left.tolist(), strict=True):
        want = next((k for k in range(len(array)) if max(x, y) + k >= len(array) or array[x + k] != array[y + k]), len(array))
        back = next((k for k in range(len(array)) if min(x, y) - k <= 0 or array[x - k - 1] != array[y - k - 1]), len(array))
        assert (r, n) == (want, back)


def test_levels_shrink():
    rng = np.random.default_rng(3)
    grammar = periodic.Grammar(rng.integers(1, 5, 50_000), 1)
    assert len(grammar.forward) < 90 and sum(len(lv.symbols) for lv in grammar.forward) < 8 * 50_000
