"""Revisits against a plain search."""

import datetime as dt
import random

from pyspark.sql import functions as F

from millrace.llm import warc

SCHEMA = "record_id string, warc_type string, target_uri string, warc_date timestamp, headers map<string,string>, payload_digest string, canonical_uri int"
START = dt.datetime(2024, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


def test_latest_earlier_response_by_plain_search(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        url = rng.choice(["http://a.org/x", "https://www.a.org/x#f", "HTTP://A.org:80/x", "http://b.org"])
        kind = rng.choice(["response", "revisit", "request"])
        rows.append((f"r{i:03}", kind, url, at(rng.randint(0, 100)), {"ETag": rng.choice(['"1"', 'W/"1"', '"2"'])}, None, 0))
    same = {"http://b.org": "b"}
    got = {r.record_id: r for r in warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == sum(r[1] == "revisit" for r in rows)
    for r in rows:
        if r[1] != "revisit":
            continue
        found = [x for x in rows if x[1] == "response" and same.get(x[2], "a") == same.get(r[2], "a") and x[3] < r[3]]
        best = max(found, key=lambda x: (x[3], x[0]), default=None)
        assert got[r[0]].refers_to == (best[0] if best else None)
        strip = lambda t: t.removeprefix("W/")
        want = "orphan" if not best else "resolved" if strip(best[4]["ETag"]) == strip(r[4]["ETag"]) else "mismatch"
        assert got[r[0]].status == want


def test_headers_are_merged(spark):
    rows = [("a", "response", "http://h/", at(0), {"Content-Length": "10", "ETag": '"e"', "Server": "old", "X": "1"}, "d", 0),
            ("b", "revisit", "http://h", at(1), {"content-length": "0", "etag": '"e"', "SERVER": "new", "Server": "newer", "Y": "2"}, "d", 0)]
    r = warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).first()
    assert r.status == "resolved" and r.headers == {"content-length": "10", "etag": '"e"', "server": "newer", "x": "1", "y": "2"}


def test_defined_cases(spark):
    h = {"Last-Modified": "m"}
    rows = [("a", "response", "http://h/", at(0), h, None, 0), ("b", "revisit", None, at(1), h, None, 0), ("c", "revisit", "http://h/", None, h, None, 0),
            ("d", "revisit", "http://h/", at(0), h, None, 0), ("e", "revisit", "http://h/", at(2), None, None, 0), ("f", "revisit", "http://h/?", at(2), h, None, 0),
            ("f", "revisit", "http://h/?", at(2), h, None, 0), (None, None, None, None, None, None, 0), ("g", "response", None, at(0), h, None, 0)]
    got = sorted((r.record_id, r.status) for r in warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("b", "orphan"), ("c", "orphan"), ("d", "orphan"), ("e", "unchecked"), ("f", "resolved"), ("f", "resolved")]
    assert warc.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_canonical_urls(spark):
    urls = ["http://WWW.Example.com:80", "https://example.com/#x", "http://www2.example.com/?", "http://example.com:8080/", "http://example.com/a?b#c",
            "mailto:x", None, "http:///x", "http://example.com?q"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").select("i", warc.canonical(F.col("u")).alias("c"))
    assert [r.c for r in df.orderBy("i").collect()] == ["example.com/"] * 3 + ["example.com:8080/", "example.com/a?b", "", "", "", "example.com/?q"]
