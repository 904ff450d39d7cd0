"""Record schemas, and warehouse table definitions <-> StructType."""

from __future__ import annotations

from pyspark.sql import types as T

# The nested subscription record; TIME needs spark.sql.timeType.enabled.
SUBSCRIPTION = """
    id STRING NOT NULL, creation_timestamp TIMESTAMP NOT NULL, expiration_date DATE NOT NULL,
    my_datetime TIMESTAMP_NTZ NOT NULL, my_time TIME(6) NOT NULL, my_numeric DECIMAL(38,9),
    numbers ARRAY<BIGINT>,
    myRequiredSubRecord STRUCT<myRequiredInt: INT, myNullableLong: BIGINT, myRequiredBoolean: BOOLEAN>,
    myOptionalArraySubRecords ARRAY<STRUCT<myRequiredDouble: DOUBLE, myOptionalFloat: FLOAT>>
"""


def record_fields(prefix: str, required: bool) -> T.StructType:
    """The eleven-field record used for routing by type, with required or optional fields."""
    types = [
        ("String", T.StringType()), ("Int", T.LongType()), ("Date", T.DateType()),
        ("Timestamp", T.TimestampType()), ("Boolean", T.BooleanType()), ("Numeric", T.DecimalType(38, 9)),
        ("Double", T.DoubleType()), ("Time", T.TimeType()), ("Bytes", T.BinaryType()),
        ("Float", T.DoubleType()), ("Long", T.LongType()),
    ]
    return T.StructType([T.StructField(prefix + name, dtype, not required) for name, dtype in types])


REQUIRED_RECORD = record_fields("myRequired", True)
OPTIONAL_RECORD = record_fields("myOptional", False)

# Warehouse type names.
_WAREHOUSE_NAMES: list[tuple[type, str]] = [
    (T.StringType, "STRING"), (T.IntegerType, "INTEGER"), (T.LongType, "INTEGER"), (T.ShortType, "INTEGER"),
    (T.FloatType, "FLOAT"), (T.DoubleType, "FLOAT"), (T.BooleanType, "BOOLEAN"), (T.BinaryType, "BYTES"),
    (T.DecimalType, "NUMERIC"), (T.DateType, "DATE"), (T.TimestampType, "TIMESTAMP"),
    (T.TimestampNTZType, "DATETIME"), (T.TimeType, "TIME"), (T.VariantType, "JSON"), (T.StructType, "RECORD"),
]


def _warehouse_field(field: T.StructField) -> dict:
    dtype, mode = field.dataType, "NULLABLE" if field.nullable else "REQUIRED"
    if isinstance(dtype, T.ArrayType):
        dtype, mode = dtype.elementType, "REPEATED"
    name = next((n for cls, n in _WAREHOUSE_NAMES if isinstance(dtype, cls)), None)
    if name is None:
        raise TypeError(f"no warehouse type for {dtype.simpleString()} ({field.name})")
    out = {"name": field.name, "type": name, "mode": mode}
    if isinstance(dtype, T.StructType):
        out["fields"] = to_warehouse_schema(dtype)
    return out


def to_warehouse_schema(schema: T.StructType) -> list[dict]:
    """StructType as a warehouse table schema (name, type, mode, fields)."""
    return [_warehouse_field(f) for f in schema.fields]


def from_warehouse_schema(fields: list[dict]) -> T.StructType:
    """Warehouse table schema as StructType."""
    spark_types = {
        "STRING": T.StringType(), "INTEGER": T.LongType(), "INT64": T.LongType(), "FLOAT": T.DoubleType(),
        "FLOAT64": T.DoubleType(), "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(), "BYTES": T.BinaryType(),
        "NUMERIC": T.DecimalType(38, 9), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
        "DATETIME": T.TimestampNTZType(), "TIME": T.TimeType(), "JSON": T.VariantType(),
    }
    out = []
    for f in fields:
        mode = f.get("mode", "NULLABLE")
        dtype = from_warehouse_schema(f["fields"]) if f["type"] in ("RECORD", "STRUCT") else spark_types[f["type"]]
        if mode == "REPEATED":
            dtype = T.ArrayType(dtype, True)
        out.append(T.StructField(f["name"], dtype, mode != "REQUIRED"))
    return T.StructType(out)
