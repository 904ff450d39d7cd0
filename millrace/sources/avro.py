"""Avro container files as a Spark source and sink, split at sync markers.

``spark.dataSource.register(AvroFiles)`` (or ``register``) adds the format ``avro_blocks``. The driver only lists files and cuts their
sizes into ranges of ``splitBytes``; a task looks for the first sync marker in its range and decodes the blocks whose marker begins there,
so every block is read once, wherever the cuts fall. Files may have schemas of their own: each is resolved against the schema asked for
(by name or alias, with defaults, widening of numbers, text for bytes and the branches of unions). Without a schema that of the first file holds.

Codecs: null, deflate, snappy, zstandard. Logical types: date, timestamps (with and without zone), decimal, uuid. A union of null and one type is a nullable column; a
named type may not contain itself.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "avro_blocks"
MAGIC = b"Obj\x01"   # fixed by the format
MARKER = 16
SPLIT_BYTES = 64 << 20
BATCH_ROWS = 2000
BLOCK_ROWS = 4000
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)


def register(spark: SparkSession) -> str:
    """Make the format known to a session; returns its name."""
    spark.dataSource.register(AvroFiles)
    return FORMAT


# --- schemas ---------------------------------------------------------------

PLAIN = {"null": T.NullType, "boolean": T.BooleanType, "int": T.IntegerType, "long": T.LongType, "float": T.FloatType, "double": T.DoubleType,
         "bytes": T.BinaryType, "string": T.StringType}


def named(schema, known: dict | None = None):
    """The schema with every reference to a named type replaced by the type."""
    known = {} if known is None else known
    if isinstance(schema, str):
        return schema if schema in PLAIN else known[schema]
    if isinstance(schema, list):
        return [named(s, known) for s in schema]
    kind = schema["type"]
    if kind in ("record", "error", "enum", "fixed"):
        space = schema.get("namespace")
        out = {**schema, "type": "record" if kind == "error" else kind}
        if kind in ("record", "error"):
            out["fields"] = [{**f, "type": named(f["type"], known)} for f in schema["fields"]]
        known[schema["name"]] = out
        if space and "." not in schema["name"]:
            known[f"{space}.{schema['name']}"] = out
        return out
    if kind == "array":
        return {**schema, "items": named(schema["items"], known)}
    if kind == "map":
        return {**schema, "values": named(schema["values"], known)}
    return named(kind, known) if isinstance(kind, (dict, list)) else (schema if "logicalType" in schema else kind)


def kind_of(schema) -> str:
    return "union" if isinstance(schema, list) else schema if isinstance(schema, str) else schema["type"]


def spark_type(schema) -> tuple[T.DataType, bool]:
    """The Spark type of a schema and whether it may be null."""
    kind, logical = kind_of(schema), schema.get("logicalType") if isinstance(schema, dict) else None
    if kind == "union":
        rest = [s for s in schema if kind_of(s) != "null"]
        if len(rest) > 1 and {kind_of(s) for s in rest} <= {"int", "long"}:
            return T.LongType(), len(rest) < len(schema)
        if len(rest) > 1:
            raise ValueError("a union of several types has no column type")
        return (spark_type(rest[0])[0] if rest else T.NullType()), len(rest) < len(schema)
    if kind == "record":
        fields = [T.StructField(f["name"], *spark_type(f["type"])) for f in schema["fields"]]
        return T.StructType(fields), False
    if kind == "array":
        return T.ArrayType(*spark_type(schema["items"])), False
    if kind == "map":
        return T.MapType(T.StringType(), *spark_type(schema["values"])), False
    if kind == "enum" or logical == "uuid":
        return T.StringType(), False
    if logical == "decimal":
        return T.DecimalType(schema["precision"], schema.get("scale", 0)), False
    if logical == "date":
        return T.DateType(), False
    if logical in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType(), False
    if logical in ("local-timestamp-millis", "local-timestamp-micros"):
        return T.TimestampNTZType(), False
    return (T.BinaryType() if kind == "fixed" else PLAIN[kind]()), kind == "null"


def avro_type(kind: T.DataType, nullable: bool, name: str):
    """The schema written for a Spark type."""
    if isinstance(kind, T.StructType):
        out = {"type": "record", "name": name, "fields": [
            {"name": f.name, "type": avro_type(f.dataType, f.nullable, f"{name}_{f.name}"), **({"default": None} if f.nullable else {})} for f in kind.fields]}
    elif isinstance(kind, T.ArrayType):
        out = {"type": "array", "items": avro_type(kind.elementType, kind.containsNull, f"{name}_item")}
    elif isinstance(kind, T.MapType):
        out = {"type": "map", "values": avro_type(kind.valueType, kind.valueContainsNull, f"{name}_value")}
    elif isinstance(kind, T.DecimalType):
        out = {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
    elif isinstance(kind, T.DateType):
        out = {"type": "int", "logicalType": "date"}
    elif isinstance(kind, T.TimestampType):
        out = {"type": "long", "logicalType": "timestamp-micros"}
    elif isinstance(kind, T.TimestampNTZType):
        out = {"type": "long", "logicalType": "local-timestamp-micros"}
    elif isinstance(kind, (T.ByteType, T.ShortType)):
        out = "int"
    else:
        out = next((n for n, k in PLAIN.items() if isinstance(kind, k)), None)
        if out is None:
            raise ValueError(f"{kind.simpleString()} cannot be written")
    return ["null", out] if nullable else out


# --- decoding: every reader takes (bytes, place) and gives (value, next place) ---

def read_long(data: bytes, at: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), at
        shift += 7


def read_bytes(data: bytes, at: int) -> tuple[bytes, int]:
    n, at = read_long(data, at)
    return data[at:at + n], at + n


def _then(read: Callable, change: Callable) -> Callable:
    def run(data, at):
        value, at = read(data, at)
        return change(value), at
    return run


def _unpacked(form: str) -> Callable:
    size = struct.calcsize(form)
    return lambda data, at: (struct.unpack_from(form, data, at)[0], at + size)


READERS = {"null": lambda data, at: (None, at), "boolean": lambda data, at: (data[at] == 1, at + 1), "int": read_long, "long": read_long,
           "float": _unpacked("<f"), "double": _unpacked("<d"), "bytes": read_bytes, "string": _then(read_bytes, lambda b: b.decode("utf-8", "replace"))}


def _blocks(item: Callable, add: Callable, empty: Callable) -> Callable:
    """Arrays and maps: counted blocks up to an empty one."""
    def run(data, at):
        out = empty()
        while True:
            n, at = read_long(data, at)
            if n == 0:
                return out, at
            if n < 0:
                n, (_, at) = -n, read_long(data, at)
            for _ in range(n):
                at = add(out, data, at)
    return run


def reader_of(writer, wanted) -> Callable:
    """How to read what ``writer`` says as what ``wanted`` says."""
    have, want = kind_of(writer), kind_of(wanted)
    if have == "union":
        def failing(branch, error):
            def run(data, at):
                raise ValueError(f"a value of {kind_of(branch)} where it is not wanted: {error}")
            return run
        readers = []
        for branch in writer:
            try:
                readers.append(reader_of(branch, wanted))
            except ValueError as error:  # only a value of this branch is an error
                readers.append(failing(branch, error))

        def choose(data, at):
            n, at = read_long(data, at)
            return readers[n](data, at)
        return choose
    if want == "union":
        for exact in (True, False):
            for branch in wanted:
                if not exact or kind_of(branch) == have:
                    try:
                        return reader_of(writer, branch)
                    except ValueError:
                        continue
        raise ValueError(f"{have} is in no branch")
    if have == "record" and want == "record":
        given = {f["name"]: f for f in writer["fields"]}
        source, defaults = {}, []
        for f in wanted["fields"]:
            name = next((n for n in [f["name"], *f.get("aliases", [])] if n in given), None)
            if name is not None:
                source[name] = f
            elif "default" in f or kind_of(f["type"]) == "union" and "null" in f["type"]:
                defaults.append((f["name"], default_value(f.get("default"), f["type"])))
            else:
                raise ValueError(f"no value for {f['name']}")
        steps = [(source[f["name"]]["name"], reader_of(f["type"], source[f["name"]]["type"])) if f["name"] in source
                 else (None, reader_of(f["type"], f["type"])) for f in writer["fields"]]

        def record(data, at):
            out = dict(defaults)
            for name, read in steps:
                value, at = read(data, at)
                if name is not None:
                    out[name] = value
            return out, at
        return record
    if have == want == "array":
        item = reader_of(writer["items"], wanted["items"])

        def add_item(out, data, at):
            value, at = item(data, at)
            out.append(value)
            return at
        return _blocks(item, add_item, list)
    if have == want == "map":
        item = reader_of(writer["values"], wanted["values"])

        def add_entry(out, data, at):
            key, at = read_bytes(data, at)
            value, at = item(data, at)
            out.append((key.decode(), value))
            return at
        return _blocks(item, add_entry, list)
    if have == "enum" and want in ("enum", "string"):
        symbols = writer["symbols"]
        return _then(read_long, lambda n: symbols[n])
    if have == "fixed" and want in ("fixed", "bytes"):
        size = writer["size"]
        return logical(lambda data, at: (data[at:at + size], at + size), writer, wanted)
    widened = {("int", "long"), ("int", "float"), ("int", "double"), ("long", "float"), ("long", "double"), ("float", "double")}
    if have == want or (have, want) in widened:
        read = READERS[have]
        return _then(read, float) if want in ("float", "double") and have in ("int", "long") else logical(read, writer, wanted)
    if (have, want) == ("bytes", "string"):
        return READERS["string"]
    if (have, want) == ("string", "bytes"):
        return read_bytes
    raise ValueError(f"{have} cannot be read as {want}")


def logical(read: Callable, writer, wanted) -> Callable:
    """Plain values unless a logical type is wanted; units and scale are those of the file."""
    special = [x.get("logicalType") if isinstance(x, dict) else None for x in (writer, wanted)]
    if special[1] is None:
        return read
    kind, schema = (special[0], writer) if special[0] else (special[1], wanted)
    if kind in ("local-timestamp-millis", "local-timestamp-micros"):
        unit = 1000 if kind == "local-timestamp-millis" else 1
        return _then(read, lambda n: EPOCH.replace(tzinfo=None) + dt.timedelta(microseconds=n * unit))
    if kind == "date":
        return _then(read, lambda n: dt.date(1970, 1, 1) + dt.timedelta(days=n))
    if kind in ("timestamp-millis", "timestamp-micros"):
        unit = 1000 if kind == "timestamp-millis" else 1
        return _then(read, lambda n: EPOCH + dt.timedelta(microseconds=n * unit))
    if kind == "decimal":
        scale = schema.get("scale", 0)
        wide = decimal.Context(prec=max(38, schema["precision"]))
        return _then(read, lambda b: decimal.Decimal(int.from_bytes(b, "big", signed=True)).scaleb(-scale, wide))
    return read


def default_value(value, schema):
    if kind_of(schema) == "union":
        schema = schema[0]
    if value is None:
        return None
    kind = kind_of(schema)
    if kind in ("bytes", "fixed"):
        return value.encode("latin-1")
    if kind == "map":
        return [(k, default_value(v, schema["values"])) for k, v in value.items()]
    if kind == "array":
        return [default_value(v, schema["items"]) for v in value]
    if kind == "record":
        return {f["name"]: default_value(value.get(f["name"], f.get("default")), f["type"]) for f in schema["fields"]}
    return value


# --- encoding --------------------------------------------------------------

def put_long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def put_bytes(data: bytes) -> bytes:
    return put_long(len(data)) + data


def writer_of(schema) -> Callable:
    kind, special = kind_of(schema), schema.get("logicalType") if isinstance(schema, dict) else None
    if kind == "union":
        put = writer_of(schema[1])
        return lambda v: b"\x00" if v is None else b"\x02" + put(v)
    if kind == "record":
        puts = [(f["name"], writer_of(f["type"])) for f in schema["fields"]]
        return lambda v: b"".join(put(v[name]) for name, put in puts)
    if kind == "array":
        put = writer_of(schema["items"])
        return lambda v: (put_long(len(v)) + b"".join(map(put, v)) if v else b"") + b"\x00"
    if kind == "map":
        put = writer_of(schema["values"])
        return lambda v: (put_long(len(v)) + b"".join(put_bytes(k.encode()) + put(x) for k, x in v) if v else b"") + b"\x00"
    if special == "decimal":
        def put_decimal(v):
            n = int(v.scaleb(schema["scale"], decimal.Context(prec=76)))
            return put_bytes(n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True))
        return put_decimal
    if special == "date":
        return lambda v: put_long((v - dt.date(1970, 1, 1)).days)
    if special == "timestamp-micros":
        return lambda v: put_long((v - EPOCH) // dt.timedelta(microseconds=1))
    if special == "local-timestamp-micros":
        return lambda v: put_long((v - EPOCH.replace(tzinfo=None)) // dt.timedelta(microseconds=1))
    return {"null": lambda v: b"", "boolean": lambda v: b"\x01" if v else b"\x00", "int": put_long, "long": put_long, "float": lambda v: struct.pack("<f", v),
            "double": lambda v: struct.pack("<d", v), "bytes": put_bytes, "string": lambda v: put_bytes(v.encode())}[kind]


def packed(data: bytes, codec: str) -> bytes:
    if codec == "deflate":
        pack = zlib.compressobj(6, zlib.DEFLATED, -15)
        return pack.compress(data) + pack.flush()
    if codec == "snappy":
        return pa.Codec("snappy").compress(data, asbytes=True) + struct.pack(">I", zlib.crc32(data))
    if codec == "zstandard":
        return pa.Codec("zstd").compress(data, asbytes=True)
    if codec == "null":
        return data
    raise ValueError(f"codec {codec} is not known")


def unpacked(data: bytes, codec: str) -> bytes:
    if codec == "deflate":
        return zlib.decompress(data, -15)
    if codec == "snappy":
        n = shift = 0  # a snappy block begins with its plain size
        for byte in data:
            n |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                break
        out = pa.Codec("snappy").decompress(data[:-4], decompressed_size=n, asbytes=True)
        if zlib.crc32(out) != struct.unpack(">I", data[-4:])[0]:
            raise ValueError("a block is damaged")
        return out
    if codec == "zstandard":
        with pa.CompressedInputStream(pa.BufferReader(data), "zstd") as f:
            return f.read()
    if codec == "null":
        return data
    raise ValueError(f"codec {codec} is not known")


# --- files -----------------------------------------------------------------

class Container:
    """An open file: its schema, codec and marker; ``blocks`` gives those whose marker begins in a range."""

    def __init__(self, f):
        self.f = f
        self.size = f.size()
        f.seek(0)
        head, need = b"", 4096
        while True:
            head += f.read(need)
            if head[:4] != MAGIC:
                raise ValueError("no Avro file")
            try:
                meta, at = _blocks(read_bytes, self._entry, dict)(head, 4)
                if at + MARKER > len(head):
                    raise IndexError
                break
            except IndexError:
                if len(head) >= self.size:
                    raise ValueError("the file ends in its header") from None
                need = len(head)
        self.schema = named(json.loads(meta["avro.schema"]))
        self.codec = meta.get("avro.codec", b"null").decode()
        self.marker, self.first = head[at:at + MARKER], at

    @staticmethod
    def _entry(out, data, at):
        key, at = read_bytes(data, at)
        value, at = read_bytes(data, at)
        if at > len(data):
            raise IndexError
        out[key.decode()] = value
        return at

    def find(self, at: int, end: int) -> int | None:
        """Where the first marker at or after a place begins, if that is before ``end``."""
        if at <= self.first:
            return self.first if self.first < end else None
        step, held, start = 1 << 20, b"", at
        self.f.seek(at)
        while start - len(held) < end:
            data = self.f.read(step)
            if not data:
                return None
            held += data
            hit = held.find(self.marker)
            if hit >= 0:
                place = start + len(data) - len(held) + hit
                return place if place < end else None
            start += len(data)
            held = held[-(MARKER - 1):]
        return None

    def blocks(self, start: int, end: int) -> Iterator[tuple[int, bytes]]:
        at = self.find(start, end)
        while at is not None and at < end and at + MARKER < self.size:
            self.f.seek(at + MARKER)
            head = self.f.read(20)
            rows, n = read_long(head, 0)
            size, n = read_long(head, n)
            place = at + MARKER + n
            self.f.seek(place)
            data, mark = self.f.read(size), self.f.read(MARKER)
            if mark != self.marker:
                raise ValueError(f"no marker after the block at {place}")
            yield rows, unpacked(data, self.codec)
            at = place + size


def filesystem(path: str):
    return pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)


def files(path: str) -> list[tuple[str, int]]:
    """Visible files at or below a path, with their sizes."""
    fs, root = filesystem(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(root, info.size)]
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    return sorted((i.path, i.size) for i in found if i.type == pafs.FileType.File and not i.base_name.startswith(("_", ".")))


class Split(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        super().__init__((path, start, end))
        self.path, self.start, self.end = path, start, end


class AvroReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType, wanted):
        self.path, self.bytes = options["path"], int(options.get("splitBytes", SPLIT_BYTES))
        self.schema, self.wanted = schema, wanted

    def partitions(self) -> list[Split]:
        return [Split(path, at, min(at + self.bytes, size)) for path, size in files(self.path) for at in range(0, size, self.bytes)] or [Split("", 0, 0)]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        if not split.path:
            return
        fs, _ = filesystem(self.path)
        arrow = to_arrow_schema(self.schema)
        with fs.open_input_file(split.path) as f:
            container = Container(f)
            read = reader_of(container.schema, self.wanted)
            for count, data in container.blocks(split.start, split.end):
                at, rows = 0, []
                for _ in range(count):
                    value, at = read(data, at)
                    rows.append(value)
                    if len(rows) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)


class Moved(WriterCommitMessage):
    def __init__(self, names: list[tuple[str, str]]):
        self.names = names


class AvroWriter(DataSourceArrowWriter):
    """Tasks write hidden files, the commit shows them."""

    def __init__(self, options, schema: T.StructType):
        self.path, self.codec = options["path"], options.get("codec", "snappy")
        self.schema = avro_type(schema, False, options.get("recordName", "record"))
        packed(b"", self.codec)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Moved:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        name, marker, put = uuid.uuid4().hex, os.urandom(MARKER), writer_of(self.schema)
        meta = {b"avro.schema": json.dumps(self.schema).encode(), b"avro.codec": self.codec.encode()}
        with fs.open_output_stream(f"{root}/_{name}.avro") as out:
            out.write(MAGIC + put_long(len(meta)) + b"".join(put_bytes(k) + put_bytes(v) for k, v in meta.items()) + b"\x00" + marker)
            for batch in iterator:
                for at in range(0, len(batch), BLOCK_ROWS):
                    rows = batch.slice(at, BLOCK_ROWS).to_pylist()
                    data = packed(b"".join(map(put, rows)), self.codec)
                    out.write(put_long(len(rows)) + put_bytes(data) + marker)
        return Moved([(f"{root}/_{name}.avro", f"{root}/part-{name}.avro")])

    def commit(self, messages) -> None:
        fs, _ = filesystem(self.path)
        for m in messages:
            for hidden, shown in m.names if m is not None else []:
                fs.move(hidden, shown)

    def abort(self, messages) -> None:
        fs, _ = filesystem(self.path)
        for m in messages:
            for hidden, _ in m.names if m is not None else []:
                fs.delete_file(hidden)


class AvroFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def given(self):
        """The schema asked for as Avro JSON, else that of the first file."""
        if "avroSchema" in self.options:
            return named(json.loads(self.options["avroSchema"]))
        found = files(self.options["path"])
        if not found:
            raise ValueError("no file to take the schema from")
        fs, _ = filesystem(self.options["path"])
        with fs.open_input_file(found[0][0]) as f:
            return Container(f).schema

    def schema(self) -> T.StructType:
        return spark_type(self.given())[0]

    def reader(self, schema: T.StructType) -> AvroReader:
        # a schema given to Spark holds by its names and types
        told = "avroSchema" in self.options
        wanted = named(json.loads(self.options["avroSchema"])) if told else avro_type(schema, False, "record")
        return AvroReader(self.options, schema, wanted)

    def writer(self, schema: T.StructType, overwrite: bool) -> AvroWriter:
        if overwrite:
            raise ValueError("files can only be added")
        return AvroWriter(self.options, schema)
