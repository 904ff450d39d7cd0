"""Avro container files: splits, schemas, codecs, damage."""

import datetime as dt
import decimal
import json

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.sources import avro

SCHEMA = {"type": "record", "name": "r", "fields": [{"name": "n", "type": "long"}, {"name": "s", "type": ["null", "string"]}]}


def container(path, rows, per_block, codec="null", schema=SCHEMA):
    put, marker = avro.writer_of(schema), bytes(range(200, 216))
    meta = {"avro.schema": json.dumps(schema), "avro.codec": codec}
    out = avro.MAGIC + avro.put_long(len(meta)) + b"".join(avro.put_bytes(k.encode()) + avro.put_bytes(v.encode()) for k, v in meta.items()) + b"\x00" + marker
    for at in range(0, len(rows), per_block):
        part = rows[at:at + per_block]
        out += avro.put_long(len(part)) + avro.put_bytes(avro.packed(b"".join(map(put, part)), codec)) + marker
    path.write_bytes(out)
    return out


def read(spark, path, **options):
    return spark.read.format(avro.register(spark)).options(path=str(path), **options).load()


@pytest.mark.parametrize("codec", ["null", "deflate", "snappy", "zstandard"])
def test_every_block_is_read_once_wherever_the_cuts_fall(tmp_path, codec):
    rows = [{"n": i * (-1) ** i, "s": None if i % 5 == 0 else "é" * (i % 90)} for i in range(400)]
    data = container(tmp_path / "f.avro", rows, 23, codec)
    with avro.filesystem(str(tmp_path))[0].open_input_file(str(tmp_path / "f.avro")) as f:
        for size in (1, 7, 16, 97, 1000, len(data)):
            c = avro.Container(f)
            one = avro.reader_of(c.schema, avro.named(SCHEMA))
            got = []
            for start in range(0, len(data), size):
                for n, block in c.blocks(start, min(start + size, len(data))):
                    at = 0
                    for _ in range(n):
                        value, at = one(block, at)
                        got.append(value)
                    assert at == len(block)
            assert got == rows


def test_types_survive_in_spark(spark, tmp_path):
    row = (1, -(2**62), 1.5, 2.25, True, b"\x00\xff", "ñ", decimal.Decimal("-123.450000001"), dt.date(1815, 6, 18), dt.datetime(1969, 12, 31, 23, 59, 59, 999999),
           dt.datetime(2024, 2, 29, 1, 2, 3, 4), [1, None, 3], {"a": [("x", None)]}, (None, "in"))
    schema = ("i int, l long, f float, d double, b boolean, y binary, s string, m decimal(38,9), day date, at timestamp, local timestamp_ntz, a array<long>, "
              "k map<string, array<struct<p: string, q: int>>>, r struct<u: int, v: string>")
    df = spark.createDataFrame([row, (None,) * 14], schema)
    for codec in ("snappy", "deflate"):
        df.write.format(avro.register(spark)).mode("append").options(path=str(tmp_path / "t"), codec=codec).save()
    back = read(spark, tmp_path / "t")
    assert sorted(map(str, back.collect())) == sorted(2 * [str(r) for r in df.collect()])
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    assert back.where("i = 1").count() == 2 and back.select(F.sum("l")).first()[0] == -(2**63)
    with pytest.raises(Exception, match="added"):
        df.write.format("avro_blocks").mode("overwrite").options(path=str(tmp_path / "t")).save()
    with pytest.raises(Exception, match="codec"):
        df.write.format("avro_blocks").mode("append").options(path=str(tmp_path / "u"), codec="lzo").save()


def resolved(writer, wanted, value):
    writer, wanted = avro.named(writer), avro.named(wanted)
    return avro.reader_of(writer, wanted)(avro.writer_of(writer)(value), 0)[0]


def test_schemas_are_resolved():
    assert resolved("int", "double", 3) == 3.0 and resolved("long", ["null", "float"], 3) == 3.0 and resolved("string", "bytes", "é") == "é".encode()
    old = {"type": "record", "name": "o", "fields": [{"name": "a", "type": "int"}, {"name": "gone", "type": {"type": "array", "items": "string"}}, {"name": "c", "type": ["null", "long"]}]}
    new = {"type": "record", "name": "o", "fields": [
        {"name": "c", "type": ["null", "long"]}, {"name": "b", "aliases": ["a"], "type": "long"}, {"name": "d", "type": "string", "default": "x"},
        {"name": "e", "type": {"type": "map", "values": "int"}, "default": {"k": 1}}, {"name": "n", "type": ["null", "int"]}]}
    assert resolved(old, new, {"a": 7, "gone": ["p", "q"], "c": None}) == {"c": None, "b": 7, "d": "x", "e": [("k", 1)], "n": None}
    enum = {"type": "enum", "name": "e", "symbols": ["X", "Y"]}
    assert avro.reader_of(enum, "string")(b"\x02", 0) == ("Y", 1)
    millis = {"type": "long", "logicalType": "timestamp-millis"}
    micros = {"type": "long", "logicalType": "timestamp-micros"}
    assert avro.reader_of(millis, micros)(avro.put_long(1500), 0)[0] == avro.EPOCH + dt.timedelta(seconds=1.5)
    assert avro.reader_of(millis, "long")(avro.put_long(1500), 0)[0] == 1500
    fixed = {"type": "fixed", "name": "f", "size": 2, "logicalType": "decimal", "precision": 4, "scale": 2}
    assert avro.reader_of(fixed, fixed)(b"\xff\x9c", 0)[0] == decimal.Decimal("-1.00") and avro.reader_of(fixed, "bytes")(b"\xff\x9c", 0)[0] == b"\xff\x9c"
    for writer, wanted in (("string", "int"), ("double", "long"), (old, {"type": "record", "name": "o", "fields": [{"name": "z", "type": "int"}]})):
        with pytest.raises(ValueError):
            avro.reader_of(avro.named(writer), avro.named(wanted))
    # a branch that is not wanted is an error only where it has a value
    branchy = avro.reader_of(["null", "string"], "null")
    assert branchy(b"\x00", 0) == (None, 1)
    with pytest.raises(ValueError):
        branchy(b"\x02\x02a", 0)
    again = {"type": "record", "name": "p", "namespace": "x", "fields": [
        {"name": "l", "type": {"type": "fixed", "name": "h", "size": 1}}, {"name": "m", "type": "h"}]}
    assert avro.reader_of(avro.named(again), avro.named(again))(b"ab", 0)[0] == {"l": b"a", "m": b"b"}


def test_damage_is_noticed(spark, tmp_path):
    data = container(tmp_path / "a.avro", [{"n": i, "s": "x" * 50} for i in range(100)], 10, "snappy")
    (tmp_path / "a.avro").write_bytes(data[:-16] + b"!" * 16)
    with pytest.raises(Exception, match="marker"):
        read(spark, tmp_path).collect()
    (tmp_path / "a.avro").write_bytes(b"no such thing")
    with pytest.raises(Exception, match="Avro"):
        read(spark, tmp_path).collect()
    block = avro.packed(b"some text", "snappy")
    with pytest.raises(ValueError):
        avro.unpacked(block[:-1] + bytes([block[-1] ^ 1]), "snappy")


def test_negative_counts_carry_sizes_and_wide_numbers_hold():
    # a block of two items may be written with its size in bytes
    items = avro.put_long(5) + avro.put_long(-6)
    data = avro.put_long(-2) + avro.put_long(len(items)) + items + b"\x00"
    array = {"type": "array", "items": "long"}
    assert avro.reader_of(array, array)(data, 0) == ([5, -6], len(data))


@settings(max_examples=200, deadline=None)
@given(st.integers(-(2**63), 2**63 - 1), st.decimals(allow_nan=False, allow_infinity=False, places=9, min_value=-10**28, max_value=10**28))
def test_numbers(n, d):
    assert avro.read_long(avro.put_long(n), 0)[0] == n
    kind = {"type": "bytes", "logicalType": "decimal", "precision": 38, "scale": 9}
    assert avro.reader_of(kind, kind)(avro.writer_of(kind)(d), 0)[0] == d


def test_an_empty_folder_has_no_schema(spark, tmp_path):
    (tmp_path / "e").mkdir()
    with pytest.raises(Exception, match="schema"):
        read(spark, tmp_path / "e").collect()
    assert read(spark, tmp_path / "e", avroSchema=json.dumps(SCHEMA)).count() == 0
    assert isinstance(avro.spark_type(avro.named({"type": "record", "name": "q", "fields": [{"name": "u", "type": ["null", "int", "long"]}]}))[0]["u"].dataType, avro.T.LongType)
    with pytest.raises(ValueError):
        avro.spark_type(["int", "string"])
    assert pa.Codec.is_available("snappy")
