"""Each stage of the pipeline against a plain version of it, on the smallest tables."""

import os
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from millrace.llm.queries import ORACLES
from millrace.session import stored
from tests.llm.test_mixing import plain_targets
from tests.llm.test_near import classes_by_pairs

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], FOLDER), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_quality_keeps_what_the_sql_keeps(stages):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = {i for i, kept in con.execute(f"SELECT doc_id, kept FROM ({ORACLES['op8_quality_rules']})").fetchall() if kept}
    assert set(texts(stages[1])) == want and stages[1].columns == stages[0].columns


def test_one_document_of_each_class_stays(stages):
    before = texts(stages[1])
    classes = classes_by_pairs(sorted(before.items()))
    assert set(texts(stages[2])) == {i for i, c in classes.items() if i == c} and stages[2].columns == stages[0].columns


def test_documents_with_benchmark_texts_go(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before = texts(stages[2])
    assert set(texts(stages[3])) == {i for i, t in before.items() if not any(x in t for x in items)}
    assert stages[3].columns == stages[0].columns


def test_sources_are_mixed(stages):
    rows = stages[3].collect()
    taken = Counter(r.doc_id for r in stages[4].select("doc_id").collect())
    assert set(taken) <= {r.doc_id for r in rows} and max(taken.values()) <= 3 and stages[4].columns == stages[0].columns
    size, have, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        n = len(r.text.split())
        size[r.source] += n
        have[r.source] += n * taken[r.doc_id]
        largest[r.source] = max(largest[r.source], n)
    goal = plain_targets(size, {s: i % 3 + 1 for i, s in enumerate(sorted(size))})
    assert all(abs(have[s] - goal[s]) <= largest[s] for s in goal)


def test_shards_hold_every_row_and_groups_stay_together(stages):
    rows = stages[5].collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in stages[4].collect())
    shard_of, slots = {}, defaultdict(list)
    for r in rows:
        assert shard_of.setdefault(r.text, r.shard) == r.shard
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_gives_the_last_stage(spark, stages):
    key = lambda r: (r.shard, r.slot, r.doc_id)
    assert sorted(map(key, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(key, stages[5].collect()))


def test_stages_take_odd_rows_and_empty_tables(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "x " * 20_000, "en", None, 1), (3, "one two three", "", "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for odd in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, odd, FOLDER).count() >= 0
