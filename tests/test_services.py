"""One call per batch, several at a time, retries, time limits, dead letters."""

import datetime
import decimal
import os
import threading
import time
import uuid
from functools import partial

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.services import Caller, KeyedFiles, _requests, call_per_batch, write_keyed_files
from tests.conftest import rows


class Slow:
    """Counts what is under way; some requests fail at first or for ever."""

    def __init__(self):
        self.lock, self.now, self.most, self.calls, self.closed = threading.Lock(), 0, 0, [], False

    def close(self):
        self.closed = True


def ask(service, requests):
    with service.lock:
        service.now += 1
        service.most = max(service.most, service.now)
        service.calls.append([r["n"] for r in requests])
        seen = service.calls.count([r["n"] for r in requests])
    time.sleep(.02)
    with service.lock:
        service.now -= 1
    if requests[0]["n"] == 3 and seen < 3 or requests[0]["n"] == 5:
        raise RuntimeError("busy")
    if requests[0]["n"] == 7:
        time.sleep(.6)
    return [r["n"] * 10 for r in requests][:None if requests[0]["n"] != 9 else 0]


def test_calls_of_a_task():
    caller = Caller(Slow, ask, in_flight=3, attempts=3, seconds=.3, pause=.01)
    out = list(caller.run([{"n": n}, {"n": n + 100}] for n in range(12)))
    assert [asked[0]["n"] for asked, *_ in out] == list(range(12))  # in order
    by = {asked[0]["n"]: rest for asked, *rest in out}
    assert by[0] == [[0, 1000], None, 1] and by[3] == [[30, 1030], None, 3]
    assert by[5] == [[None, None], "RuntimeError: busy", 3] and by[9][1].startswith("ValueError") and by[7] == [[None, None], "no answer in 0.3 s", 3]
    calls = caller.client.calls
    assert calls.count([0, 100]) == 1 and calls.count([3, 103]) == 3 and 2 <= caller.client.most
    caller.close()
    assert caller.client.closed


class Logged:
    """Leaves a file per call."""

    def __init__(self, folder):
        self.folder = folder

    def ask(self, names):
        with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(",".join(names))
        return [n.lower() if n != "?" else None for n in names]


def ask_names(service, requests):
    return service.ask([r["name"] for r in requests])


def test_one_call_per_batch(spark, tmp_path):
    batches = [([(1, "A"), (2, "B")],), ([(3, "C")],), ([],), (None,), ([(4, "?"), (None, "D"), (4, "?")],)]
    df = spark.createDataFrame(batches, "asked array<struct<id: long, name: string>>").repartition(2)
    out = call_per_batch(df, "asked", partial(Logged, str(tmp_path)), ask_names, T.StringType())
    assert rows(out.select("id", "name", "answer", "error", "attempts")) == sorted([
        (1, "A", "a", None, 1), (2, "B", "b", None, 1), (3, "C", "c", None, 1), (4, "?", None, None, 1), (4, "?", None, None, 1), (None, "D", "d", None, 1)], key=repr)
    asked = sorted(open(tmp_path / f).read() for f in os.listdir(tmp_path))
    assert asked == ["?,D,?", "A,B", "C"]
    assert call_per_batch(df.limit(0), "asked", partial(Logged, str(tmp_path)), ask_names, T.StringType()).count() == 0


def test_keyed_files(spark, tmp_path):
    df = spark.range(1000).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    write_keyed_files(df.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id, 'x' AS v")), "id", "v", str(tmp_path / "ok"))
    files = KeyedFiles(str(tmp_path / "ok"), "id", "v")
    assert files.ask([5, None, 999, 5, 1000]) == ["v5", None, "v999", "v5", None] and files.ask([None]) == [None] and files.ask([]) == []
    with pytest.raises(Exception, match="several"):
        write_keyed_files(df.union(df), "id", "v", str(tmp_path / "twice"))


def test_a_call_reads_a_row_group_per_key_and_keeps_the_last(spark, tmp_path):
    df = spark.range(60_000).select((F.col("id") * 3).alias("id"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    write_keyed_files(df, "id", "v", str(tmp_path / "many"))
    for held in (64 << 20, 1):
        files, read = KeyedFiles(str(tmp_path / "many"), "id", "v", held), []
        assert len(files.groups) >= 4
        for name, file in files.files.items():
            files.files[name] = type("Watched", (), {"read_row_group": lambda self, n, columns, file=file: read.append(n) or file.read_row_group(n, columns)})()
        assert files.ask([3, 150_000, 4, None, -3, 3, 10**9, 179_997]) == ["v1", "v50000", None, None, None, "v1", None, "v59999"]
        assert len(read) == 3
        assert files.ask([179_997, 179_994]) == ["v59999", "v59998"] and len(read) <= 4 and len(files.kept) == (3 if held > 1 else 1)
    texts = df.select(F.col("v").alias("id"), F.col("id").cast("string").alias("v"))
    write_keyed_files(texts, "id", "v", str(tmp_path / "texts"))
    assert KeyedFiles(str(tmp_path / "texts"), "id", "v").ask(["v1", "v59999", "v", "w"]) == ["3", "179997", None, None]


def test_days_and_decimals_are_looked_up(spark, tmp_path):
    df = spark.range(100).select(F.expr("date_add(DATE'2024-01-01', CAST(id AS INT) * 2)").alias("d"), F.col("id").cast("decimal(12,2)").alias("amount"), "id")
    for key, asked in (("d", [datetime.date(2024, 1, 3), datetime.date(2024, 1, 4), None]), ("amount", [decimal.Decimal("1.00"), decimal.Decimal("1.5"), None])):
        write_keyed_files(df, key, "id", str(tmp_path / key))
        assert KeyedFiles(str(tmp_path / key), key, "id").ask(asked) == [1, None, None]


def test_a_call_waits_once_for_the_others(spark, tmp_path):
    df = spark.range(60_000).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    write_keyed_files(df, "id", "v", str(tmp_path / "many"))
    files, taken = KeyedFiles(str(tmp_path / "many"), "id", "v"), []
    asked = list(range(0, 60_000, 5000))
    files.ask(asked)

    class Watched:
        def __enter__(self):
            taken.append(1)

        def __exit__(self, *_):
            pass

    files.lock = Watched()
    assert files.ask(asked) == [f"v{n}" for n in asked] and len(files.kept) >= 4 and len(taken) == 1


def test_null_and_empty_requests():
    kind = pa.list_(pa.struct([("n", pa.int64()), ("of", pa.list_(pa.string()))]))
    given = [[{"n": 1, "of": ["a"]}], None, [], [{"n": None, "of": None}, {"n": 2, "of": []}], [None, {"n": 3, "of": None}]]
    for first in (0, 1, 3):
        for last in (4, 5):
            assert list(_requests(pa.array(given, kind).slice(first, last - first))) == [r for r in given[first:last] if r]


def test_answers_of_many_calls_leave_together(spark):
    df = spark.range(500).select(F.array(F.struct(F.col("id").alias("n"))).alias("asked")).coalesce(1)
    out = call_per_batch(df, "asked", Doubled, ask_doubled, T.LongType())
    assert rows(out.select("n", "answer")) == [(n, 2 * n) for n in sorted(range(500), key=lambda n: repr((n, 2 * n)))]


class Doubled:
    pass


def ask_doubled(service, requests):
    return [r["n"] * 2 for r in requests]
