"""Typed records as JSON rows in warehouse spelling, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def warehouse_value(value: Column, dtype: T.DataType) -> Column:
    """A field as the warehouse spells it: integers and decimals as text, bytes as base64."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return value.cast("string")
    if isinstance(dtype, T.DecimalType):
        return value.cast("decimal(38,9)").cast("string")
    if isinstance(dtype, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(dtype, T.TimestampType):
        return F.concat(F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" UTC"))
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    if isinstance(dtype, T.TimeType):
        return value.cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.base64(value)
    if isinstance(dtype, T.StructType):
        return F.struct(*[warehouse_value(value[f.name], f.dataType).alias(f.name) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: warehouse_value(x, dtype.elementType))
    return value


def json_row(record: Column, schema: T.StructType) -> Column:
    """One JSON object per record; fields that are NULL are left out."""
    return F.to_json(warehouse_value(record, schema))


def typed_record(json: Column, schema: T.StructType) -> Column:
    """Parse a JSON object into a typed record; bytes are given as text, a bad document is an error."""
    wire = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, (T.BinaryType, T.TimeType)) else f.dataType, True)
        for f in schema.fields
    ])
    parsed = F.from_json(json, wire, {"mode": "FAILFAST"})
    fields = []
    for f in schema.fields:
        value = parsed[f.name]
        if isinstance(f.dataType, T.BinaryType):
            value = F.encode(value, "UTF-8")
        elif isinstance(f.dataType, T.TimeType):
            value = F.to_time(value)
        fields.append(value.alias(f.name))
    return F.struct(*fields)
