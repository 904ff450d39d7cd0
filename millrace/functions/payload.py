"""Compressed and XML payloads.

Compression runs in Python (Arrow batches). Documents are split and parsed by
built-in expressions; for salary sums, plain documents are read by expat where
they are unpacked and all others by ``from_xml``.
"""

from __future__ import annotations

import gzip as _gzip
import re
from collections.abc import Callable, Iterable, Iterator
from xml.parsers.expat import ExpatError, ParserCreate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLLEGE_SCHEMA = (
    "_id INT, staff ARRAY<STRUCT<_id: BIGINT, _dep_name: STRING, salary: STRUCT<basic: BIGINT>>>"
)


@F.arrow_udf(T.BinaryType())
def gzip(payload: pa.Array) -> pa.Array:
    """Compress; equal input gives equal bytes."""
    return pa.array([None if b is None else _gzip.compress(b, compresslevel=6, mtime=0) for b in payload.to_numpy(zero_copy_only=False)], pa.binary())


@F.arrow_udf(T.BinaryType())
def gunzip(payload: pa.Array) -> pa.Array:
    return pa.array([None if b is None else _gzip.decompress(b) for b in payload.to_numpy(zero_copy_only=False)], pa.binary())


def gunzip_text(payload: Column) -> Column:
    return F.decode(gunzip(payload), "UTF-8")


def split_documents(text: Column, tag: str) -> Column:
    """All documents ``<tag ...>...</tag>`` of a text that holds several, as an array."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>.*?</{tag}>"), F.lit(0))


def parse_college(xml: Column) -> Column:
    """One parse of a college document into a struct."""
    return F.from_xml(xml, COLLEGE_SCHEMA, {"mode": "FAILFAST"})


def basic_salary_sum(college: Column) -> Column:
    return F.aggregate(
        F.coalesce(college["staff"], F.array()), F.lit(0).cast("bigint"),
        lambda acc, s: acc + F.coalesce(s["salary"]["basic"], F.lit(0)),
    )


# --- salary sums of packed documents ---------------------------------------

_COLLEGE_START = re.compile(r"<college(?:\s[^>]*)?>", re.ASCII).search

# The tokens of a plain document, one a line. No token of this form holds a line break.
_PLAIN = re.compile(r'''<college id="-?[0-9]{1,9}">
(?:<staff id="-?[0-9]{1,18}" dep_name="[ !#-%'-;=-~]*">
<salary>
<basic>
-?[0-9]{1,18}
</basic>
</salary>
</staff>
)*</college>''').fullmatch

_READ = T.ArrayType(T.StructType([T.StructField("salary", T.LongType()), T.StructField("other", T.StringType())]))


def plain_salary_sum(xml: str) -> int | None:
    """What ``basic_salary_sum(parse_college(xml))`` gives for a plain document; None if ``from_xml`` has to decide.

    Plain is a well-formed document with the fields of the schema and nothing else, not even white space between them.
    """
    tokens: list[str] = []
    parser = ParserCreate()
    parser.DefaultHandler = tokens.append
    try:
        parser.Parse(xml, True)
    except ExpatError:
        return None
    return sum(map(int, tokens[4:-1:7])) if _PLAIN("\n".join(tokens)) else None


def college_documents(text: str) -> Iterator[str]:
    """The documents that ``split_documents(text, "college")`` gives."""
    start = _COLLEGE_START(text)
    while start and (end := text.find("</college>", start.end())) >= 0:
        end += len("</college>")
        yield text[start.start():end]
        start = _COLLEGE_START(text, end)


def _read_payloads(payload: pa.Array, documents: Callable[[str], Iterable[str]]) -> pa.Array:
    """Per document of a payload the salary sum, or the text where ``from_xml`` has to decide; NULL has no documents."""
    sums: list[int | None] = []
    others: list[str | None] = []
    ends = [0]
    for packed in payload.to_numpy(zero_copy_only=False):
        for xml in () if packed is None else documents(_gzip.decompress(packed).decode()):
            salary = plain_salary_sum(xml)
            sums.append(salary)
            others.append(xml if salary is None else None)
        ends.append(len(sums))
    read = pa.StructArray.from_arrays([pa.array(sums, pa.int64()), pa.array(others, pa.string())], ["salary", "other"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), read)


@F.arrow_udf(_READ)
def _read_many(payload: pa.Array) -> pa.Array:
    return _read_payloads(payload, college_documents)


@F.arrow_udf(_READ)
def _read_one(payload: pa.Array) -> pa.Array:
    return _read_payloads(payload, lambda text: [text])


def _salary_sums(read: Column) -> Column:
    return F.transform(read, lambda d: F.coalesce(d["salary"], basic_salary_sum(parse_college(d["other"]))))


def packed_salary_sums(payload: Column) -> Column:
    """The salary sum of every college document of a compressed payload, as an array."""
    return _salary_sums(_read_many(payload))


def packed_salary_sum(payload: Column) -> Column:
    """The salary sum of a compressed payload that is one college document."""
    return F.coalesce(F.get(_salary_sums(_read_one(payload)), F.lit(0)), F.lit(0).cast("bigint"))


def staff_id_sum(college: Column) -> Column:
    return F.aggregate(
        F.coalesce(college["staff"], F.array()), F.lit(0).cast("bigint"),
        lambda acc, s: acc + F.coalesce(s["_id"], F.lit(0)),
    )


def college_fields(college: Column) -> Column:
    """The extracted fields of a college as ``map<string,string>``.

    ``college`` is used several times: it should be a column of an earlier projection, or every use parses again.
    """
    first = F.get(college["staff"], F.lit(0))["_dep_name"]
    return F.create_map(
        F.lit("college_first_staff_dep_name"), first,
        F.lit("college_first_staff_dep_name_length"), F.length(first).cast("string"),
        F.lit("staff_basic_salary_sum"), basic_salary_sum(college).cast("string"),
        F.lit("staff_id_attr_sum"), staff_id_sum(college).cast("string"),
        F.lit("college_id"), college["_id"].cast("string"),
    )


def college_xml(college_id: Column, staff: list[tuple[Column, str, Column]]) -> Column:
    """A college document from columns: (staff id, department, basic salary) per staff member."""
    parts = [F.lit('<college id="'), college_id.cast("string"), F.lit('">')]
    for staff_id, department, basic in staff:
        parts += [
            F.lit('<staff id="'), staff_id.cast("string"), F.lit(f'" dep_name="{department}"><salary><basic>'),
            basic.cast("string"), F.lit("</basic></salary></staff>"),
        ]
    return F.concat(*parts, F.lit("</college>"))
