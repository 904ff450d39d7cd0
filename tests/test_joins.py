import pytest
from pyspark.sql import functions as F

from millrace.operators import joins as jn
from tests.conftest import rows


def kv(frame, pairs, value="m"):
    return frame([(k, v, i) for i, (k, v) in enumerate(pairs)], f"key string, {value} int, seq bigint")


def test_cogroup_sum(frame):
    main, side = kv(frame, [("a", 1), ("b", 2)]), kv(frame, [("b", 10), ("c", 20)], "s")
    assert rows(jn.cogroup_sums(main, side, "key", "m", "s")) == [("a", 1), ("b", 12), ("c", 20)]


def test_cogroup_sum_times_first(frame):
    main = kv(frame, [("a", 1), ("b", 2), ("b", 3), ("c", 4)])
    side = kv(frame, [("b", 10), ("b", 99), ("c", 100), ("z", 7)], "s")
    out = jn.cogroup_sum_times_first(main, side, "key", "m", "s", "seq")
    assert rows(out) == [("a", 1), ("b", 50), ("c", 400), ("z", 0)]


def test_cogroup_pages(frame):
    main, side = kv(frame, [("a", 1), ("b", 2), ("b", 3)]), kv(frame, [("b", 20), ("c", 30)], "s")
    assert rows(jn.cogroup_pages(main, side, "key", "m", "s", "seq")) == [
        ("a", 0, [1], []), ("b", 0, [2, 3], [20]), ("c", 0, [], [30])]
    assert rows(jn.cogroup_pages(main, side, "key", "m", "s", "seq", size=1).where("key = 'b'")) == [
        ("b", 0, [2], [20]), ("b", 1, [3], [])]


def test_lookup_or_default(frame):
    main = kv(frame, [("a", 1), ("b", 2), ("c", 3), ("c", 4)])
    side = kv(frame, [("b", 11), ("c", 22), ("d", 33)], "s")
    out = jn.lookup_or_default(main, side, "key", "s", F.lit(1))
    assert rows(out.select("key", F.col("m") * F.col("s"))) == [("a", 1), ("b", 22), ("c", 66), ("c", 88)]
    with pytest.raises(Exception, match="duplicate lookup key: b"):
        jn.lookup_or_default(main, kv(frame, [("b", 1), ("b", 2)], "s"), "key", "s", F.lit(1)).collect()


def test_membership(frame):
    main, lookup = frame([(c,) for c in "abcd"], "e string"), frame([(c,) for c in "bcb"], "l string")
    assert rows(jn.in_lookup(main, lookup, "e", "l")) == [("b",), ("c",)]
    assert rows(jn.in_lookup(main, lookup, "e", "l", "anti")) == [("a",), ("d",)]
    assert rows(jn.in_lookup(main, lookup, "e", "l", "flag")) == [("a", False), ("b", True), ("c", True), ("d", False)]


def test_side_values(frame):
    main = frame([("a", "1"), ("b", "2")], "k string, v string")
    single = jn.with_singleton(main, frame([("M",)], "m string"), "meta")
    assert rows(single.select("k", F.concat("meta", "v"))) == [("a", "M1"), ("b", "M2")]
    for wrong in ([], [("M",), ("N",)]):
        with pytest.raises(Exception, match="exactly one row"):
            jn.with_singleton(main, frame(wrong, "m string"), "meta").collect()
    side = frame([("x",), ("y",), ("x",)], "s string")
    assert rows(jn.with_side_set(main, side, "s", "all").select("k", "all")) == [("a", ["x", "y"]), ("b", ["x", "y"])]
    with pytest.raises(Exception, match="more than 1 values"):
        jn.with_side_set(main, side, "s", "all", max_values=1).collect()


def test_schema_join(frame):
    names = frame([(123, "bob"), (567, "alice")], "id int, name string")
    ages = frame([(123, 10), (567, 7)], "id int, age int")
    out = jn.schema_join(names, ages, ["id"])
    assert rows(out.select(F.concat_ws(",", "lhs.name", F.col("rhs.age").cast("string")))) == [("alice,7",), ("bob,10",)]


def test_tiered_match(frame):
    p = frame([("a", "aa", "aaa", 1), ("b", "bb", "bbb", 2), ("c", "cc", "ccc", 3)], "k1 string, k2 string, k3 string, p int")
    s = frame([("b", "bb", "bbb", 10), ("b", "bb", "-", 20), ("c", "cc", "-", 30), ("c", "cc", "-", 40), ("d", "dd", "ddd", 50)],
              "k1 string, k2 string, k3 string, v int")
    out = jn.tiered_match(p, s, ["k1", "k2"], "k3", "v")
    assert rows(out.select("k1", "tier", "v")) == [("a", None, None), ("b", 1, 10), ("c", 2, 40)]


def test_tiered_match_returns_all_exact_rows(frame):
    p = frame([("b", "bb", "x", 1)], "k1 string, k2 string, k3 string, p int")
    s = frame([("b", "bb", "x", 1), ("b", "bb", "x", None), ("b", "bb", "z", 9)], "k1 string, k2 string, k3 string, v int")
    assert rows(jn.tiered_match(p, s, ["k1", "k2"], "k3", "v").select("tier", "v")) == [(1, 1), (1, None)]


def test_enrichment(frame):
    main = frame([("a", "A"), ("b", "B"), ("a", "AA"), ("a", "AAAA")], "k string, name string")
    service = frame([("A", "_A_", 1), ("A", "_A_A_", 2), ("B", "_B_", 1)], "n string, v string, o int")
    out = jn.enrich_with_last(main, service, "name", "n", "v", "o")
    assert rows(out.select("k", F.concat_ws(":", "name", "v"))) == [
        ("a", "A:_A_A_"), ("a", "AA:UNKNOWN"), ("a", "AAAA:UNKNOWN"), ("b", "B:_B_")]


class Service:
    """Answers for at most two names at a time."""

    known = {"A": ["_A_", "_A_A_"], "B": ["_B_"]}

    def ask(self, names):
        assert len(names) <= 2
        return {n: self.known.get(n, []) for n in names}


def ask_service(service, batch):
    answers = service.ask(list(batch["name"]))
    return batch.assign(name=[f"{n}:{(answers[n] or ['UNKNOWN'])[-1]}" for n in batch["name"]])


def test_service_is_called_in_batches(frame):
    events = [("a", "A"), ("b", "B"), ("a", "AA"), ("b", "BB"), ("a", "AAA"), ("b", "BBB"), ("a", "AAAA")]
    out = jn.call_in_batches(frame(events, "k string, name string").coalesce(1), 2, Service, ask_service, "k string, name string")
    found = rows(out)
    assert len(found) == 7
    assert {("a", "A:_A_A_"), ("b", "B:_B_"), ("a", "AAAA:UNKNOWN")} <= set(found)
