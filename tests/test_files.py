import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas, session
from millrace.session import scratch_path, shared_folder
from millrace.sources import connectors as cn
from millrace.sources import files as fl
from millrace.sources import generators as gn
from millrace.sources import tables as tb
from tests.conftest import rows

def record(name, stamp, **more):
    """A record as a load job gets it: integers in quotes, the time parts of one stamp, only required parts unless given."""
    plain = stamp.removesuffix(" UTC")
    return {"id": name, "creation_timestamp": stamp, "expiration_date": plain[:10], "my_datetime": plain, "my_time": plain[11:], "numbers": [],
            "myRequiredSubRecord": {"myRequiredInt": 9, "myRequiredBoolean": True}, **more}


SUBSCRIPTIONS = [
    record("zone", "2019-07-04 23:59:59.000001 UTC", numbers=["8"]),
    record("no zone", "2019-07-04 06:05:04.5", my_numeric=12.000000001),
    record("seconds", "2020-02-29 00:00:00", myOptionalArraySubRecords=[]),
    record("full", "2020-02-29 12:00:01 UTC", numbers=["-1", "9007199254740993"], my_numeric=-7.25,
           myRequiredSubRecord={"myRequiredInt": 4, "myNullableLong": 44, "myRequiredBoolean": False},
           myOptionalArraySubRecords=[{"myRequiredDouble": 0.5, "myOptionalFloat": 2.25}, {"myRequiredDouble": -8.0}]),
]


@pytest.fixture
def subscriptions(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text("\n".join(json.dumps(r) for r in SUBSCRIPTIONS))
    schema = spark.createDataFrame([], schemas.SUBSCRIPTION).schema
    return fl.nested_json(spark, str(path), schema)


def test_nested_json(spark, subscriptions):
    found = {r["id"]: r for r in subscriptions.collect()}
    assert found["full"]["numbers"] == [-1, 9007199254740993] and found["zone"]["numbers"] == [8] and found["seconds"]["numbers"] == []
    assert found["full"]["myRequiredSubRecord"].asDict() == {"myRequiredInt": 4, "myNullableLong": 44, "myRequiredBoolean": False}
    assert found["zone"]["myRequiredSubRecord"]["myNullableLong"] is None
    assert [(r["myRequiredDouble"], r["myOptionalFloat"]) for r in found["full"]["myOptionalArraySubRecords"]] == [(0.5, 2.25), (-8.0, None)]
    assert found["seconds"]["myOptionalArraySubRecords"] == [] and found["zone"]["myOptionalArraySubRecords"] is None
    assert found["zone"]["my_numeric"] is None and found["no zone"]["my_numeric"] == Decimal("12.000000001")
    assert found["no zone"]["my_datetime"] == dt.datetime(2019, 7, 4, 6, 5, 4, 500_000) and found["full"]["expiration_date"] == dt.date(2020, 2, 29)
    micros = {r[0]: r[1] for r in subscriptions.select("id", F.unix_micros("creation_timestamp")).collect()}
    start = dt.datetime(2019, 7, 4, tzinfo=dt.timezone.utc).timestamp()
    assert micros["zone"] == int(start + 86_399) * 1_000_000 + 1 and micros["no zone"] == int((start + 6 * 3600 + 304.5) * 1_000_000)


def test_nested_round_trip(spark, subscriptions, tmp_path):
    fl.write_records(subscriptions, str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    assert [(f.name, f.dataType) for f in stored.schema.fields] == [(f.name, f.dataType) for f in subscriptions.schema.fields]
    assert rows(stored) == rows(subscriptions)


def test_whole_files(spark, tmp_path):
    (tmp_path / "myFile.txt").write_text("abc123")
    (tmp_path / "other.log").write_text("no")
    out = fl.whole_files(spark, str(tmp_path / "*.txt"))
    assert rows(out.select(F.concat_ws(",", "name", F.decode("content", "UTF-8")))) == [("myFile.txt,abc123",)]


def test_csv(frame):
    schema = T.StructType().add("id", "long").add("name", "string").add("x", "double")
    out = fl.csv_records(frame([("1,bob,2.5",), ("2,,",), ("3",)], "value string"), schema)
    assert rows(out) == [(1, "bob", 2.5), (2, None, None), (3, None, None)]
    assert rows(out.select(fl.csv_line(F.col("id"), F.col("name"), F.col("x")))) == [("1,bob,2.5",), ("2,,",), ("3,,",)]


def test_text_shards(spark, tmp_path):
    lines = spark.range(100).select(F.col("id").cast("string").alias("value"))
    fl.write_text(lines, str(tmp_path / "t"), shards=4, compression="gzip")
    assert len(list((tmp_path / "t").glob("part-*.txt.gz"))) == 4
    assert fl.read_lines(spark, str(tmp_path / "t")).count() == 100


def test_destinations_limit_rows_per_file(spark, tmp_path):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, "hot").otherwise("cold"))
    fl.write_by_destination(df, str(tmp_path / "d"), ["k"], rows_per_file=300)
    assert len(list((tmp_path / "d" / "k=hot").glob("*.parquet"))) >= 3
    assert rows(spark.read.parquet(str(tmp_path / "d")).groupBy("k").count()) == [("cold", 100), ("hot", 900)]


def test_schema_evolution(spark, frame, tmp_path):
    frame([(1,)], "id int").write.parquet(str(tmp_path / "e" / "v=1"))
    frame([(2, "x")], "id int, name string").write.parquet(str(tmp_path / "e" / "v=2"))
    assert rows(fl.merged_schema(spark, str(tmp_path / "e")).select("id", "name")) == [(1, None), (2, "x")]
    assert rows(fl.hive_partitioned(spark, str(tmp_path / "e"), "id INT, name STRING, v STRING")) == [(1, None, "1"), (2, "x", "2")]


def test_dispositions(spark, tmp_path):
    name = "millrace_test_dispositions"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    with pytest.raises(ValueError, match="does not exist"):
        tb.load_table(spark.range(2), name, str(tmp_path / "t"), create=False)
    tb.load_table(spark.range(2), name, str(tmp_path / "t"))
    tb.load_table(spark.range(3), name, str(tmp_path / "t"))
    assert spark.table(name).count() == 5
    tb.load_table(spark.range(1), name, str(tmp_path / "t"), write="truncate", create=False)
    assert spark.table(name).count() == 1


def test_delete_keeps_rows_the_condition_is_null_for(spark, frame, tmp_path):
    df = frame([(1,), (None,), (5,)], "n int")
    tb.delete_where(df, F.col("n") > 3, str(tmp_path / "kept"))
    assert rows(spark.read.parquet(str(tmp_path / "kept"))) == [(1,), (None,)]


def test_parameters(spark, frame):
    assert tb.checked("d", "2021-03-03", tb.DATE) == "2021-03-03"
    for bad in ("2021-3-3", "2021-03-03' OR '1'='1", ""):
        with pytest.raises(ValueError):
            tb.checked("d", bad, tb.DATE)
    df = frame([("2021-03-03", 1), ("x' OR '1'='1", 2)], "d string, n int")
    assert rows(tb.sql_with_parameters(spark, "SELECT n FROM {t} WHERE d = :d", {"d": "x' OR '1'='1"}, t=df)) == [(2,)]


def test_parameter_range(spark):
    assert rows(gn.parameter_range(spark, "3,5")) == [(3,), (4,), (5,)]
    with pytest.raises(ValueError):
        gn.parameter_range(spark, "3-5")


def test_fanout(spark):
    out = gn.weighted_fanout(spark.range(6), "id", 2, [1, 2])
    assert rows(out.groupBy("weight").count()) == [(1, 2), (2, 4)]
    assert rows(out.select("body")) == [("0_0",), ("1_0",), ("2_0",), ("2_1",), ("3_0",), ("3_1",)]


def test_generated_records_repeat(spark):
    def made():
        return rows(gn.generated_records(spark.range(20), F.col("id"), F.lit(dt.datetime(2021, 1, 1))))
    records = made()
    assert records == made()
    assert len({r[0] for r in records}) == 20 and all(0 <= r[2] < 100 and len(r[3]) == 1000 for r in records)


def test_kafka_options():
    options = cn.kafka_options("h:1", topics="t", group_id="g")
    assert options == {"kafka.bootstrap.servers": "h:1", "includeHeaders": "true", "subscribe": "t", "kafka.group.id": "g",
                       "kafka.isolation.level": "read_committed"}
    secured = cn.kafka_options("h:1", partitions={"t": [0, 2]}, security={"security.protocol": "SASL_SSL"}, endingOffsets="latest")
    assert json.loads(secured["assign"]) == {"t": [0, 2]}
    assert secured["kafka.security.protocol"] == "SASL_SSL" and secured["endingOffsets"] == "latest"
    with pytest.raises(ValueError):
        cn.kafka_options("h:1")


def test_kafka_records_without_headers(frame):
    schema = ("topic string, partition int, offset bigint, value binary, headers array<struct<key: string, value: binary>>")
    df = frame([("t", 0, 5, bytearray(b"x"), None), ("t", 1, 6, bytearray(b"y"), [("a", bytearray(b"1"))])], schema)
    assert rows(cn.kafka_messages(df).select("attrs", "msg_id")) == [({"a": "1"}, "t-1-6"), ({}, "t-0-5")]


def test_scratch_is_under_the_configured_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark) + "/x-")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_finished_flows_leave_nothing_behind(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", {})
    df = session.stored(spark.range(3), "kept")
    name = session.scratch_table(spark, "t")
    tb.load_table(df, name, scratch_path(spark, "t"))
    assert spark.catalog.tableExists(name) and df.count() == 3
    assert session.release_scratch(spark) == 2 and not spark.catalog.tableExists(name)
    assert session.release_scratch(spark) == 0


def test_console_and_bus_writers_are_not_started(spark, tmp_path):
    spark.range(1).select(F.encode(F.lit("x"), "UTF-8").alias("payload"), F.create_map(F.lit("a"), F.lit("1")).alias("attrs"),
                          F.lit("7").alias("msg_id")).write.parquet(str(tmp_path / "bus"))
    stream = spark.readStream.schema("payload binary, attrs map<string,string>, msg_id string").parquet(str(tmp_path / "bus"))
    writer = cn.bus_writer(stream, "parquet", str(tmp_path / "progress"), path=str(tmp_path / "out"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select(F.decode("value", "UTF-8"), F.col("headers")[0]["key"])) == [("x", "a")]
    assert cn.console_writer(stream) is not None
