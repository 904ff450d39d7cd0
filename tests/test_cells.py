"""Cells of a few meters: what they are (``plate``) and what they read (``level``), some read twice."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import cells as cl
from tests.conftest import rows

SCHEMA = "row_key string, family string, qualifier string, ts_micros bigint, value string"


@pytest.fixture
def cells(frame):
    return frame([
        ("north#07#a", "plate", "maker", 50, "Ohm"), ("north#07#a", "level", "litres", 50, "310"),
        ("north#08#b", "plate", "maker", 60, "unknown"), ("north#08#b", "plate", "owner", 60, "city"),
        ("north#08#b", "plate", "maker", 90, "Volt*"), ("north#08#b", "level", "litres", 90, "77"), ("north#08#b", "level", "alarm", 90, "low"),
        ("south#01#c", "plate", "maker", 90, "Volt"), ("south#01#c", "plate", "owner", 90, "mill"), ("south#01#c", "level", "litres", 90, "5"),
        ("west#02#d", "plate", "owner", 200, "mill"), ("west#02#d", "level", "litres", 200, "12")], SCHEMA)


def test_latest_and_ranges(cells):
    newest = cl.latest(cells)
    assert rows(newest.where("row_key = 'north#08#b' AND qualifier = 'maker'").select("ts_micros", "value")) == [(90, "Volt*")]
    assert {r[0] for r in cl.time_range(cells, 50, 90).select("row_key").collect()} == {"north#07#a", "north#08#b"}
    assert {r[0] for r in cl.key_range(cells, "north#08", "south#~").select("row_key").collect()} == {"north#08#b", "south#01#c"}
    assert {r[0] for r in cl.key_prefix(cells, "west").select("row_key").collect()} == {"west#02#d"}


def test_patterns_match_whole_text(cells, frame):
    assert cells.where(cl.matches(qualifier="litre", value=".*")).count() == 0
    assert rows(cells.where(cl.matches("plate", "maker", r".*\*")).select("value")) == [("Volt*",)]
    lines = frame([("r", "f", "q", 1, "two\nlines"), ("r", "f", "q", 2, "one\n")], SCHEMA)
    assert rows(lines.where(cl.matches(value="two.*")).select("ts_micros")) == [(1,)]
    assert lines.where(cl.matches(value="one")).count() == 0


def test_condition_keeps_one_row(cells):
    found = cl.render_rows(cl.latest(cl.rows_with(cells, cl.matches("plate", "owner", "city"))))
    assert rows(found.select("text")) == [("north#... level:alarm=low,litres=77|plate:maker=Volt*,owner=city",)]


def test_all_predicates(cells):
    plates = cl.latest(cells.where(F.col("family") == "plate"))
    found = cl.rows_with_all(plates, cl.matches(qualifier="owner", value="city"), (F.col("qualifier") == "maker") & F.col("value").endswith("*"))
    assert rows(cl.render_rows(found).select("text")) == [("north#... plate:maker=Volt*,owner=city",)]


def test_nested_condition_labels(cells):
    predicates = {"city": cl.matches(qualifier="owner", value="city"), "marked": cl.matches(qualifier="maker", value=r".*\*"),
                  "mill": cl.matches(qualifier="owner", value="mill")}
    label = F.when(F.col("city") & F.col("marked"), "marked of the city").when(~F.col("city") & F.col("mill"), "of the mill")
    out = cl.label_rows(cl.time_range(cl.latest(cells), 60, 100), predicates, label)
    assert rows(out.select("row_key", "label").distinct()) == [("north#08#b", "marked of the city"), ("south#01#c", "of the mill")]
    assert out.columns == [*cells.columns, "label"]


def test_labels_take_one_exchange(cells):
    out = cl.label_rows(cl.latest(cells, by_row=True), {"mill": cl.matches(value="mill")}, F.when(F.col("mill"), "m"))
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    assert {r.row_key for r in out.collect()} == {"south#01#c", "west#02#d"}


def test_versions_are_rendered_newest_first(cells):
    text = cl.render_rows(cells.where("row_key = 'north#08#b' AND qualifier = 'maker'")).first()["text"]
    assert text == "north#... plate:maker=Volt*;unknown"


def test_sorted_cells_push_the_key_range_down(spark, cells, tmp_path):
    cl.write_sorted(cells, str(tmp_path / "cells"))
    stored = cl.key_range(spark.read.parquet(str(tmp_path / "cells")), "south#", "south#~")
    plan = stored._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(row_key,south#)" in plan and "LessThan(row_key,south#~)" in plan
    assert stored.count() == 3


def test_whole_rows_are_dealt_out_once_to_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(cl, "CELLS_PER_TASK", 100)
    typed = spark.range(1000).coalesce(1)
    made = [cl.cell("f", "q", F.lit(n), F.concat(F.lit(f"v{n}-"), F.col("id").cast("string"))) for n in (1, 2)]
    cells = cl.unpivot(typed, F.concat(F.lit("row#"), F.col("id").cast("string")), made, whole_rows=True)
    assert cells.rdd.getNumPartitions() == 20
    shown = cl.render_rows(cl.latest(cells))
    assert rows(shown.select("text")) == sorted((f"row#... f:q=v2-{n}",) for n in range(1000))
    assert shown._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
