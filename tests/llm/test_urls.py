"""Rules by a plain reading of urls, models against plain counting."""

import math
from collections import Counter

import pytest

from millrace.llm import urls
from millrace.llm.queries import RULES

URLS = [None, "", "abc", "http://A.example.COM/en/x?y", "x://host", "https://www.EXAMPLE.com/en/", "http://a/b://c", "://n.net/es/", "http://b.net/fr/a#f?x",
        "http://c.net/de/", "ftp://x.notcom/", "http://com", "http://org.com?x/en/", "http://É.com/É", "http://example.com/en", "x" * 3000 + "://a.com/" + "p" * 3000]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    cut = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), path[:cut]


def plain_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] * 2, "page_id long, url string, host string")
    got = urls.judge(pages, RULES).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path = plain(URLS[r.page_id])
        assert (r.host, r.path) == (host, path)
        rule = plain_rule(host, path)
        assert r.rule == (rule.name if rule else None) and r.verdict in ("allow", "block")
        if rule:
            assert r.verdict == rule.verdict and r.score is None


def plain_scores(texts):
    """The same smoothing by counting every context in dictionaries."""
    counts = {side: [Counter() for _ in range(urls.ORDER + 1)] for side in (0, 1)}
    kinds = {side: [Counter() for _ in range(urls.ORDER + 1)] for side in (0, 1)}

    def grams(t):
        t = " " * urls.ORDER + t
        return [t[i:i + urls.ORDER + 1] for i in range(len(t) - urls.ORDER)]

    for text, label in texts:
        for g in grams(text) if label is not None else []:
            for k in range(urls.ORDER + 1):
                counts[label][k][g[urls.ORDER - k:urls.ORDER], g[-1]] += 1
    for side in (0, 1):
        for k in range(urls.ORDER + 1):
            for c, _ in counts[side][k]:
                kinds[side][k][c] += 1

    def probability(side, g):
        p = 1 / urls.ALPHABET
        for k in range(urls.ORDER + 1):
            c = g[urls.ORDER - k:urls.ORDER]
            total = sum(n for (x, _), n in counts[side][k].items() if x == c)
            if total:
                p = (counts[side][k][c, g[-1]] + kinds[side][k][c] * p) / (total + kinds[side][k][c])
        return p

    return [sum(math.log(probability(1, g)) - math.log(probability(0, g)) for g in grams(t)) / len(t) for t, _ in texts]


def test_scores_equal_plain_counting(spark, monkeypatch):
    texts = [("good.site.org/news", 1), ("good.place.org/a", 1), ("bad-spam.biz/win", 0), ("spam.biz/cash", 0), ("site.org/win", None), ("spam.org/", None)]
    df = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(texts)], "id long, text string, label int")
    got = {r.id: r.score for r in urls.scored(df).collect()}
    want = plain_scores(texts)
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-8)
    monkeypatch.setattr(urls, "BROADCAST_GRAMS", 1)
    assert {r.id: r.score for r in urls.scored(df).collect()} == got


def test_threshold_separates(spark):
    df = spark.createDataFrame([(-1.0, False), (-0.5, False), (0.2, True), (0.9, True), (0.1, False)], "score double, accepted boolean")
    assert 0.1 < urls.threshold(df) <= 0.2
    assert urls.threshold(df.filter("accepted")) == 0.0


def test_models_learn_from_the_rules(spark):
    rows = [(f"http://shop{i}.net/es/casino-win-cash-{i}",) for i in range(60)] + [(f"http://paper{i}.com/de/science-report-{i}",) for i in range(60)]
    rows += [("http://x.org/casino-win-cash",), ("http://y.org/de/science-report",)]
    got = {r.url: r.verdict for r in urls.judge(spark.createDataFrame(rows, "url string"), RULES).collect()}
    assert got["http://x.org/casino-win-cash"] == "block" and got["http://y.org/de/science-report"] == "allow"


def test_no_python_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.org/b")], "page_id long, url string")
    out = urls.judge(pages, RULES)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert urls.judge(pages.limit(0), RULES).count() == 0
