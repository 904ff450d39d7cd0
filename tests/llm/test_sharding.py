"""Longest-first shards: the heap against a plain scan, slots, groups."""

import random
from collections import defaultdict

import pytest

from millrace.llm import sharding


def test_heap_equals_a_plain_scan_for_the_least_loaded():
    rng = random.Random(1)
    sizes = [(rng.randint(1, 900), (False, i, 0)) for i in range(300)]
    loads, want = [0] * 8, {}
    for size, name in sorted(sizes, key=lambda x: (-x[0], x[1])):
        s = loads.index(min(loads))
        loads[s] += size
        want[name] = s
    assert dict(sharding.longest_first(sizes, 8)) == want
    assert max(loads) - min(loads) <= 900


@pytest.mark.parametrize("rows_per_block", [50_000, 7])
def test_groups_together_bytes_even_slots_gapless(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(sharding, "ROWS_PER_BLOCK", rows_per_block)
    rng = random.Random(2)
    texts = ["t%d " % i * rng.choice([1, 3, 20, 200]) for i in range(700)]
    rows = [(i, rng.choice(texts[:20]) if i % 3 == 0 else texts[i % 700]) for i in range(1500)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 1500
    shard_of, slots, load = {}, defaultdict(list), defaultdict(int)
    for r in got:
        assert shard_of.setdefault(r.text, r.shard) == r.shard
        slots[r.shard].append(r.slot)
        load[r.shard] += len(r.text.encode()) + 1
    assert set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / 8


def test_defined_cases(spark):
    rows = [(1, None, 5, 1), (None, None, 6, 2), (2, "", 7, 3), (2, "", 7, 3), (3, "é" * 100_000, 8, 4), (None, "x", 9, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, shard_group int")
    got = sharding.shard(docs, 3).collect()
    assert len(got) == 6 and len({r.shard for r in got if r.text is None}) == 1 and len({r.shard for r in got if r.text == ""}) == 1
    per = defaultdict(list)
    for r in got:
        per[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    assert sharding.shard(docs.limit(0)).count() == 0
    again = sorted((r.shard, r.slot, str(r.doc_id), r.text or "") for r in sharding.shard(docs.repartition(3), 3).collect())
    assert [x[:1] + x[2:] for x in sorted((r.shard, r.slot, str(r.doc_id), r.text or "") for r in got)] == [x[:1] + x[2:] for x in again]
