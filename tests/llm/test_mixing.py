"""Targets by plain resharing, rounding by its invariants and by a plain fold."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing


def plain_targets(sizes, weights, most=3):
    """Share by weight, cap, share the excess again, until none is above."""
    total, capped = float(sum(sizes.values())), {}
    while True:
        rest = total - sum(capped.values())
        open_ = [s for s in sizes if s not in capped]
        share = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s] + 1e-9]
        if not above:
            return {**capped, **share}
        capped.update({s: most * sizes[s] for s in above})


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_plain_resharing(spark, seed):
    rng = random.Random(seed)
    names = ["b", "a", "Z", "é", "", None, "aa"]
    sizes = {n: rng.choice([0, 3, 50, 1000, 40000]) for n in names}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df, mixing.default_weights(df.select("source"))).collect()}
    order = sorted((n for n in names if n is not None), key=str.encode) + [None]
    want = plain_targets(sizes, {n: i % 3 + 1 for i, n in enumerate(order)}) if sum(sizes.values()) else dict.fromkeys(names, 0.0)
    assert got == pytest.approx(want)


def plain_fold(items):
    """The same settling of neighbours, one after the other."""
    done, old = {}, list(items[0])
    for new in map(list, items[1:]):
        to_old = min(old[1] * (1 - old[2]), new[1] * new[2])
        to_new = min(old[1] * old[2], new[1] * (1 - new[2]))
        rises = new[3] * (to_old + to_new) < to_new
        if (old[1] * (1 - old[2]) <= new[1] * new[2]) if rises else (old[1] * old[2] <= new[1] * (1 - new[2])):
            done[old[0]] = rises
            moved = to_old if rises else -to_new
            new[2] = min(1.0, max(0.0, new[2] - moved / new[1]))
            old = new
        else:
            done[new[0]] = not rises
            moved = to_old if rises else -to_new
            old[2] = min(1.0, max(0.0, old[2] + moved / old[1]))
    return done, old


def test_fold_equals_plain_version_and_keeps_the_mass(spark):
    rng = random.Random(2)
    items = [(i, float(rng.randint(1, 500)), rng.random(), rng.random()) for i in range(60)]
    df = spark.createDataFrame([(items,)], "items array<struct<key:bigint,mass:double,p:double,u:double>>")
    f = df.select(mixing._fold(F.col("items")).alias("f")).first().f
    done, left = plain_fold(items)
    assert {d.key: d.up for d in f.done} == done and f.open.key == left[0]
    mass = {i: m for i, m, _, _ in items}
    assert sum(mass[k] for k, up in done.items() if up) + left[1] * left[2] == pytest.approx(sum(m * p for _, m, p, _ in items))


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "c", None]), "w " * rng.choice([1, 5, 40, 300])) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plan = [r.asDict() for r in mixing.plan_mix(docs).collect()]
    again = [r.asDict() for r in mixing.plan_mix(docs.repartition(7)).collect()]
    key = lambda r: r["key"]
    assert sorted(plan, key=key) == sorted(again, key=key)
    taken, target = defaultdict(int), {}
    for r in plan:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"] * r["n"]
        target[r["source"]] = r["target"]
    for s, t in target.items():
        assert taken[s] == pytest.approx(t, rel=0.01)


def test_expected_copies_stay(spark):
    units = spark.createDataFrame([("a", i, float(1 + i % 9), 0.3) for i in range(40)], "source string, key long, mass double, p double")
    ups = sum(r.up for seed in range(12) for r in mixing.rounded(units, seed).collect())
    assert 0.2 < ups / (12 * 40) < 0.4


def test_defined_cases(spark):
    rows = [(1, "a", None, 1), (2, "a", "", 2), (None, None, "x y", 3), (3, "b", "one two", 4), (3, "b", "one two", 4), (3, "b", "other", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, mix_key int")
    plan = mixing.plan_mix(docs)
    assert plan.agg(F.sum("n")).first()[0] == 6
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    counts = {(r.doc_id, r.text): r.n for r in out.groupBy("doc_id", "text").agg(F.count("*").alias("n")).collect()}
    assert counts.get((3, "one two"), 0) % 2 == 0
    assert mixing.plan_mix(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")
    assert {r.target for r in mixing.plan_mix(nothing).collect()} == {0.0}


def test_no_python(spark):
    docs = spark.createDataFrame([(1, "a", "x y z")], "doc_id long, source string, text string")
    assert "Python" not in mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
