import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as ag
from millrace.operators import ranking as rk
from millrace.operators.batching import group_into_batches, with_shards
from tests.conftest import rows

KV = [("a", 1), ("b", 1), ("a", 2)]


def test_keyed(frame):
    kv = frame(KV, "key string, value int")
    assert rows(ag.count_per(kv, "key")) == [("a", 2), ("b", 1)]
    assert rows(ag.sum_per(kv, ["key"], F.col("value"))) == [("a", 3), ("b", 1)]
    lists = rk.value_pages(kv.withColumn("seq", F.col("value") * 10 + F.length("key")), ["key"], F.col("value"), "seq")
    assert rows(lists) == [("a", 0, [1, 2]), ("b", 0, [1])]


def test_global(frame):
    numbers = frame([(1,), (2,), (3,)], "value int")
    empty = numbers.where("value > 9")
    assert rows(ag.global_sum(numbers, F.col("value"))) == [(6,)]
    assert rows(ag.global_sum(empty, F.col("value"))) == [(0,)]
    total = F.sum("value").alias("total")
    assert rows(ag.global_combine(numbers, total)) == [(6,)]
    assert rows(ag.global_combine(empty, total)) == []
    assert rows(ag.top_n(frame([(1,), (3,), (2,), (4,)], "v int"), 2, F.desc("v"))) == [(3,), (4,)]
    assert rows(ag.count_per(frame([("a",), ("b",), ("a",)], "v string"), "v")) == [("a", 2), ("b", 1)]
    assert rows(frame([("a", [1, 2]), ("b", [])], "k string, v array<bigint>").select("k", ag.sum_of_list(F.col("v")))) == [("a", 3), ("b", 0)]


class Longest(ag.CombineFn):
    def create(self):
        return ""

    def add(self, acc, value):
        return max(acc, value, key=len)

    merge = add


@pytest.mark.parametrize("max_open_keys", [1, 2, 1000])
def test_combine_fn(spark, frame, max_open_keys):
    data = [(f"k{i % 3}", "x" * (i % 17)) for i in range(500)]
    df = frame(data, "key string, v string").repartition(4)
    expected = sorted((k, max((v for kk, v in data if kk == k), key=len)) for k in {"k0", "k1", "k2"})
    out = ag.combine_per_key(df, "key", "v", Longest(), "string", max_open_keys=max_open_keys, fan_in=3)
    assert rows(out) == expected


def test_salted_sum_equals_plain_sum(spark):
    df = spark.range(1000).withColumn("key", F.when(F.col("id") % 10 < 7, "US").otherwise("PL"))
    plain = rows(ag.sum_per(df, ["key"], F.col("id")))
    assert rows(ag.salted_sum(df, ["key"], F.col("id"), F.col("id") % 10)) == plain


def test_rank_equals_brute_force(spark, frame):
    """One key holds most rows, blocks are small, numbers have gaps, one key is NULL."""
    rng = random.Random(7)
    data = [(rng.choice(["hot"] * 8 + ["x", None]), n) for n in rng.sample(range(-500, 5000), 900)]
    out = rk.ranked(frame(data, "key string, seq bigint").repartition(5), ["key"], "seq", blocks=7)
    expected = []
    for key in {k for k, _ in data}:
        expected += [(key, s, i + 1) for i, s in enumerate(sorted(s for k, s in data if k == key))]
    assert rows(out) == sorted(expected, key=repr)


def test_blocks_do_not_depend_on_the_spacing_of_ids(spark):
    sparse = spark.range(20_000).select(F.lit("hot").alias("key"), (F.col("id") * 1_000_003).alias("seq"))
    cuts = rk.cuts_of(sparse, "seq", 16)
    assert len(cuts) == 15
    sizes = [r["count"] for r in sparse.groupBy(rk.block_of(F.col("seq"), cuts)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16
    out = rk.ranked(sparse.repartition(7), ["key"], "seq", blocks=16)
    assert out.where((F.col("rn") - 1) * 1_000_003 != F.col("seq")).count() == 0 and out.count() == 20_000


def test_pages_hold_every_value_once(spark):
    df = spark.range(1, 1001).withColumn("key", F.when(F.col("id") > 3, "hot").otherwise("cold"))
    out = rk.value_pages(df, ["key"], F.col("id"), "id", size=64).orderBy("key", "page").collect()
    assert max(len(r["values"]) for r in out) == 64
    assert [v for r in out if r["key"] == "hot" for v in r["values"]] == list(range(4, 1001))
    assert [tuple(r) for r in out if r["key"] == "cold"] == [("cold", 0, [1, 2, 3])]


def test_running_max_equals_brute_force(spark, frame):
    rng = random.Random(3)
    data = [(t, rng.randint(0, 10_000)) for t in range(0, 400, 3)]
    out = rk.running_max(frame(data, "t bigint, v bigint").repartition(3), "t", "v", "before", span=25)
    expected = [(t, v, max([w for u, w in data if u < t], default=None)) for t, v in data]
    assert rows(out) == sorted(expected, key=repr)


EVENTS = [("a", 1, 0), ("a", 2, 1), ("b", 3, 2), ("b", 10, 5), ("c", 20, 6), ("a", 30, 7), ("b", 40, 7), ("d", 50, 7),
          ("b", 60, 8), ("b", 70, 9)]


def windowed(frame):
    numbered = [(k, v, s, i) for i, (k, v, s) in enumerate(EVENTS)]
    return frame(numbered, "key string, value int, second int, id bigint").withColumn("w", F.expr("second div 5"))


def test_batches_of_three(frame):
    out = group_into_batches(windowed(frame), ["key", "w"], F.col("value"), "id", 3)
    assert out.count() == 7
    assert sorted(r["size"] for r in out.where("key = 'b'").collect()) == [1, 1, 3]
    assert [10, 40, 60] in [r["values"] for r in out.where("key = 'b'").collect()]


def test_shards_by_count(frame):
    first_eight = windowed(frame).where("id < 8")
    out = with_shards(first_eight, ["w"], F.col("id"), 2)
    assert rows(out.groupBy("w", "shards").count()) == [(0, 1, 3), (1, 2, 5)]
    assert {r["shard"] for r in out.where("w = 1").collect()} == {0, 1}


def test_set_pages_equal_whole_sets(spark):
    import random
    rng = random.Random(1)
    # one key holds most rows; values come again, are null, and a key may be null
    data = [(rng.choice(["hot"] * 8 + ["a", None]), rng.choice([None, *(f"v{i:04}" for i in range(700))])) for _ in range(6000)] + [("none", None)]
    df = spark.createDataFrame(data, "key string, value string")
    got = {}
    for r in rk.set_pages(df, ["key"], F.col("value"), size=64).collect():
        assert 0 < len(r["values"]) <= 64
        got.setdefault(r.key, {})[r.page] = r["values"]
    want = {k: sorted({v for x, v in data if x == k and v is not None}) for k in ("hot", "a", None)}
    assert {k: [v for page in sorted(p) for v in p[page]] for k, p in got.items()} == want
    assert all(len(p[i]) == 64 for p in got.values() for i in range(len(p) - 1))
    whole = rk.set_pages(df, [], F.col("value"), size=100).orderBy("page").collect()
    assert [v for r in whole for v in r["values"]] == sorted({v for _, v in data if v is not None})
    assert rk.set_pages(df.limit(0), ["key"], F.col("value")).count() == 0
