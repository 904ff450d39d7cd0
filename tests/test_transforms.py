import pytest
from pyspark.sql import functions as F

from millrace.functions.text import base_name, hash_prefix, parse_int, thousands
from millrace.operators import transforms as tr
from tests.conftest import rows


def test_union_partition_filter(frame):
    parts = [frame([(v,) for v in vs], "value string") for vs in ("abcd", "XYZ", "21")]
    union = tr.union_all(parts)
    assert union.count() == 9
    index = F.when(F.col("value").rlike("[a-z]"), 0).when(F.col("value").rlike("[A-Z]"), 1).otherwise(2)
    lower, upper, digits = tr.partition_by_index(union, index, 3)
    assert rows(lower) == [("a",), ("b",), ("c",), ("d",)]
    assert rows(upper) == [("X",), ("Y",), ("Z",)]
    assert rows(digits) == [("1",), ("2",)]
    assert rows(parts[0].where("value <> 'a'")) == [("b",), ("c",), ("d",)]


def test_partition_index_out_of_range_is_an_error(frame):
    with pytest.raises(Exception, match="partition index out of range: 5"):
        tr.partition_by_index(frame([(5,)], "n int"), F.col("n"), 3)[0].collect()


def test_odd_even_drops_negative_odd_numbers(frame):
    outputs = tr.odd_even(frame([(n,) for n in (1, -1, 2, 0, -2)], "n int"), "n")
    assert rows(outputs["even"]) == [(-2,), (0,), (2,)]
    assert rows(outputs["odd"]) == [(1,)]


def test_dead_letters(frame):
    lines = frame([("1",), ("a",), ("2",), (None,)], "line string")
    good, bad = tr.with_dead_letters(lines, F.col("line"), parse_int(F.col("line")), "n", "For input string: ")
    assert rows(good.select("n")) == [(1,), (2,)]
    assert rows(bad) == [("a", 'For input string: "a"'), (None, "null input")]


def test_keys(frame):
    df = frame([(n,) for n in (9, 10, 99, 999, 1000)], "n int")
    key = tr.bucket_key(F.col("n"), [(10, "a"), (100, "b"), (1000, "c")], "d")
    assert [r[0] for r in df.orderBy("n").select(key).collect()] == ["a", "b", "b", "c", "d"]
    countries = [r[0] for r in frame([(n,) for n in range(10)], "n bigint").orderBy("n").select(tr.skewed_key(F.col("n"))).collect()]
    assert countries == tr.COUNTRIES


def test_flatten_lists_skips_empty_and_null(frame):
    df = frame([(1, [1, 2]), (2, []), (3, None)], "id int, v array<int>")
    assert rows(tr.flatten_lists(df, "v", "x")) == [(1, 1), (1, 2)]


def test_setup_and_teardown_run_once_per_task(spark, tmp_path):
    folder = str(tmp_path)

    def setup():
        import tempfile
        return tempfile.NamedTemporaryFile(dir=folder, delete=False, suffix=".open")

    def process(resource, batch):
        return batch.assign(name=resource.name)

    def teardown(resource):
        import os
        os.rename(resource.name, resource.name + ".closed")

    out = tr.map_partitions_with_setup(spark.range(0, 1000, 1, 3), setup, process, "id bigint, name string", teardown)
    assert len({r["name"] for r in out.collect()}) == 3
    assert len(list(tmp_path.glob("*.closed"))) == 3


def test_observed(frame):
    df, seen = tr.observed(frame([(1,), (None,), (5,)], "v int"), "m", "v")
    df.collect()
    assert seen.get == {"rows": 3, "count": 2, "min": 1, "max": 5, "sum": 6}


def test_spread_deals_rows_out_by_key(spark):
    dealt = tr.spread(spark.range(0, 100, 1, 1), "id")
    assert dealt.count() == 100 and dealt.select(F.spark_partition_id()).distinct().count() >= 1


def test_tagged_outputs_from_one_pass(frame):
    df = frame([(n,) for n in (1, -1, 2, 0, None)], "n int")
    both = tr.tagged(df, {**tr.odd_even_rules("n"), "all": F.lit(True)})
    counts = {r["output"]: r["count"] for r in both.groupBy("output").count().collect()}
    assert counts == {"even": 2, "odd": 1, "all": 5}


def test_attempted_keeps_good_rows_and_reasons(frame):
    df = tr.attempted(frame([("1",), ("x",), (None,)], "line string"), F.col("line"), parse_int(F.col("line")), "n", "bad: ")
    assert rows(df.select("n", "error")) == rows(frame([(1, None), (None, 'bad: "x"'), (None, "null input")], "n bigint, error string"))


def test_text(frame):
    df = frame([(1234567, "gs/a/b.txt")], "n bigint, p string")
    assert rows(df.select(thousands(F.col("n")), base_name(F.col("p")))) == [("1,234,567", "b.txt")]
    assert len(df.select(hash_prefix(F.col("n"), F.col("p"))).first()[0]) == 6
