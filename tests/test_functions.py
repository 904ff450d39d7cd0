import gzip
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import arrays, numbers, payload, records, temporal
from millrace.functions.messages import message_text, sorted_attributes
from millrace.plans import QUERIES
from tests.conftest import rows

# A college document.
COLLEGE = """<college id="1">
  <staff id="101" dep_name="Admin"><salary id="101-sal"><basic>20000</basic><medical>10000</medical></salary></staff>
  <staff id="102" dep_name="HR"><salary id="102-sal"><basic>25000</basic></salary></staff>
  <staff id="103" dep_name="IT"><salary id="103-sal"><basic>35000</basic></salary></staff>
</college>"""


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_conversions(spark):
    ts = F.to_timestamp(F.lit("2021-03-03T12:12:12.123Z"))
    assert one(spark, F.unix_date(F.to_date(ts)), F.unix_micros(ts) % 86_400_000_000) == (18689, 43932123000)
    time = F.to_time(F.lit("12:12:12.123"))
    assert one(spark, temporal.micros_of_day(time)) == (43932123000,)
    assert one(spark, temporal.time_from_micros(F.lit(43932123000)).cast("string")) == ("12:12:12.123",)
    assert one(spark, temporal.date_path(ts, minute=True)) == ("year=2021/month=03/day=03/hour=12/minute=12",)
    assert one(spark, temporal.file_safe(F.lit("12:12:12"))) == ("12_12_12",)
    assert one(spark, temporal.reverse_timestamp(ts)) == (2**63 - 1 - 1614773532123,)
    assert one(spark, temporal.freshness_ms(ts, F.lit(None).cast("timestamp"))) == (-1,)
    line = temporal.instant_of_log_line(F.lit("a,2021-03-03T12:12:12.123Z"))
    assert one(spark, F.unix_millis(line)) == (1614773532123,)


def test_decimal_scale(spark):
    assert str(one(spark, temporal.decimal_scale9(F.lit("1.23").cast("decimal(38,18)")))[0]) == "1.230000000"
    with pytest.raises(Exception, match="more than 9 decimals"):
        one(spark, temporal.decimal_scale9(F.lit("0.1234567891").cast("decimal(38,18)")))


def test_arrays(spark, frame):
    df = frame([([100000, 50001, 100002, 100003, 50004, 100005],), ([],), ([None, 1],), (None,)], "n array<bigint>")
    out = [tuple(r) for r in df.select(arrays.array_sum(F.col("n")), arrays.even_numbers(F.col("n"))).collect()]
    assert out == [(500015, [100000, 100002, 50004]), (None, None), (1, None), (None, None)]
    arrays.register_array_functions(spark)
    sql = spark.sql("SELECT my_sum(n), my_even_numbers(n), get(my_even_numbers(n), 0) FROM {df}", df=df)
    assert [tuple(r) for r in sql.collect()] == [(500015, [100000, 100002, 50004], 100000), (None,) * 3, (1, None, None), (None,) * 3]


def test_factorial(spark):
    n = spark.range(3).select((F.col("id") * 100).alias("n"))
    assert [r[0] for r in n.select(numbers.factorial_text(F.col("n"))).collect()] == [str(math.factorial(k)) for k in (0, 100, 200)]


def test_college(spark, frame):
    df = frame([(bytearray(gzip.compress(COLLEGE.encode())),)], "p binary")
    fields = df.select(payload.college_fields(payload.parse_college(payload.gunzip_text(F.col("p"))))).first()[0]
    assert fields == {"college_first_staff_dep_name": "Admin", "college_first_staff_dep_name_length": "5",
                      "staff_basic_salary_sum": "80000", "staff_id_attr_sum": "306", "college_id": "1"}


def test_split_documents(spark, frame):
    text = "".join(f'<ABC><D e="{i}"/></ABC>\n' for i in range(1, 5))
    docs = frame([(text,), ("<ABCD>x</ABCD><ABC a='1'>\n</ABC>",), ("none",)], "x string").select(
        payload.split_documents(F.col("x"), "ABC").alias("d"))
    found = [r["d"] for r in docs.collect()]
    assert found[0] == [f'<ABC><D e="{i}"/></ABC>' for i in range(1, 5)]
    assert found[1:] == [["<ABC a='1'>\n</ABC>"], []]


def test_gzip_round_trip(frame):
    df = frame([(bytearray(b"abc" * 1000),), (None,)], "p binary")
    assert [r[0] for r in df.select(payload.gunzip(payload.gzip("p"))).collect()] == [bytearray(b"abc" * 1000), None]


def test_json_rows(spark, frame):
    required = ('{"myRequiredString":"abc","myRequiredInt":123,"myRequiredDate":"2017-01-01",'
                '"myRequiredTimestamp":"2022-03-20T03:41:42.123Z","myRequiredBoolean":true,"myRequiredNumeric":1.23,'
                '"myRequiredDouble":4.56,"myRequiredTime":"12:34:56.789","myRequiredBytes":"abc123","myRequiredFloat":7.89,"myRequiredLong":567}')
    expected = ('{"myRequiredString":"abc","myRequiredInt":"123","myRequiredDate":"2017-01-01",'
                '"myRequiredTimestamp":"2022-03-20 03:41:42.123 UTC","myRequiredBoolean":true,"myRequiredNumeric":"1.230000000",'
                '"myRequiredDouble":4.56,"myRequiredTime":"12:34:56.789","myRequiredBytes":"YWJjMTIz","myRequiredFloat":7.89,"myRequiredLong":"567"}')

    def through(text, schema):
        record = records.typed_record(F.col("j"), schema)
        return frame([(text,)], "j string").select(records.json_row(record, schema)).first()[0]

    assert through(required, schemas.REQUIRED_RECORD) == expected
    assert through('{"myOptionalString":"abc"}', schemas.OPTIONAL_RECORD) == '{"myOptionalString":"abc"}'
    with pytest.raises(Exception):
        through('{"myRequiredInt":"x"', schemas.REQUIRED_RECORD)


def test_schema_definitions(spark):
    schema = spark.createDataFrame([], schemas.SUBSCRIPTION).schema
    fields = schemas.to_warehouse_schema(schema)
    assert [(f["name"], f["type"], f["mode"]) for f in fields] == [
        ("id", "STRING", "REQUIRED"), ("creation_timestamp", "TIMESTAMP", "REQUIRED"), ("expiration_date", "DATE", "REQUIRED"),
        ("my_datetime", "DATETIME", "REQUIRED"), ("my_time", "TIME", "REQUIRED"), ("my_numeric", "NUMERIC", "NULLABLE"),
        ("numbers", "INTEGER", "REPEATED"), ("myRequiredSubRecord", "RECORD", "NULLABLE"),
        ("myOptionalArraySubRecords", "RECORD", "REPEATED")]
    assert schemas.to_warehouse_schema(schemas.from_warehouse_schema(fields)) == fields
    with pytest.raises(TypeError, match="no warehouse type"):
        schemas.to_warehouse_schema(T.StructType().add("m", T.MapType(T.StringType(), T.StringType())))


def test_semi_structured(spark, frame):
    df = frame([("id1", '{"myStrProp1":"a","myIntProp1":10}'), ("id2", '{"myStrProp2":"b","myIntProp1":20}'),
                ("id3", '{"myIntProp1":"ten"}')], "user_id string, j string").select("user_id", F.parse_json("j").alias("v"))
    assert rows(df.where(F.try_variant_get("v", "$.myIntProp1", "int") == 10).select("user_id")) == [("id1",)]


def test_message_text(frame):
    df = frame([(bytearray(b"hi"), {"pt": "2", "et": "1"}, "7")], "payload binary, attrs map<string,string>, msg_id string")
    assert df.select(sorted_attributes(F.col("attrs"))).first()[0] == "{et=1, pt=2}"
    assert df.select(message_text(F.col("payload"), F.col("attrs"), F.col("msg_id"), lag=F.lit(5))).first()[0] == (
        "body=hi, attrs={et=1, pt=2}, msgId=7, lag=5")


def test_a_document_is_parsed_once_for_all_fields(spark, tmp_path):
    spark.sql("SELECT 7L AS o_orderkey, 3L AS o_custkey, 99.5D AS o_totalprice, DATE'2024-01-01' AS o_orderdate").write.parquet(
        f"{tmp_path}/orders.parquet")
    found = QUERIES["xml_xpath_extract"](spark, str(tmp_path))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1
    assert [tuple(r) for r in found.collect()] == [(7, "Admin", 5, 99 + 3 + 35000, 3 * 7 + 306)]


def staff(basic="5", id="7", name="HR"):
    return f'<staff id="{id}" dep_name="{name}"><salary><basic>{basic}</basic></salary></staff>'


def packed(*texts):
    return [(None if x is None else bytearray(gzip.compress(x.encode())),) for x in texts]


PLAIN_COLLEGES = [
    f'<college id="1">{staff()}{staff("70")}</college>', '<college id="-12"></college>', f'<college id="007">{staff("-003", "-9", "A > b/c-=")}</college>',
    f'<college id="1">{staff("9" * 18)}</college>', f'<college id="1">{staff(name="")}</college>']
OTHER_COLLEGES = [
    COLLEGE, f"<college>{staff()}</college>", f'<college id="1">{staff(name="Ä")}</college>', f'<college id="1">{staff(name="a &amp; b")}</college>',
    f'<college id="1">{staff(" 5 ")}</college>', f'<college id="1">{staff("+5")}</college>', f'<college id="1"><!-- {staff()} -->{staff("6")}</college>',
    '<college id="1"><staff id="2"><salary><basic>3</basic></salary><salary><basic>4</basic></salary></staff></college>',
    "<college id='1'><staff dep_name='x' id='2'><salary><basic><![CDATA[5]]></basic></salary></staff></college>",
    '<college id="1"><staff id="2" dep_name="x"><salary><basic></basic></salary></staff></college>',
    '<college id="1"><staff id="2" dep_name="x"><salary><basic/></salary></staff></college>',
    f'<college id="1"><hall>{staff()}</hall>{staff("8")}</college>', f'<college id="1">{staff()}text</college>',
    f'<college id="1">{staff(str(2**63 - 1))}</college>', "<college id='1'><staff id='2'/><staff/></college>"]


def test_packed_salary_sums_are_those_of_the_parse(frame):
    colleges = PLAIN_COLLEGES + OTHER_COLLEGES
    df = frame(packed("\n".join(colleges[:7]), "", "x".join(colleges[7:]), None, "none", *colleges), "p binary")
    parsed = F.transform(payload.split_documents(payload.gunzip_text(F.col("p")), "college"), lambda d: payload.basic_salary_sum(payload.parse_college(d)))
    found = df.select(payload.packed_salary_sums(F.col("p")).alias("a"), F.coalesce(parsed, F.array()).alias("b")).collect()
    assert [r["a"] for r in found] == [r["b"] for r in found]
    assert [r["a"] for r in found[5:9]] == [[75], [0], [-3], [10**18 - 1]]
    singles = frame(packed(*colleges, f" {colleges[0]}\n", f'<?xml version="1.0"?>{colleges[0]}', None), "p binary")
    both = singles.select(payload.packed_salary_sum(F.col("p")).alias("a"),
                          payload.basic_salary_sum(payload.parse_college(payload.gunzip_text(F.col("p")))).alias("b")).collect()
    assert [r["a"] for r in both] == [r["b"] for r in both]


def test_plain_documents_are_read_where_they_are_unpacked():
    assert [payload.plain_salary_sum(x) for x in PLAIN_COLLEGES] == [75, 0, -3, 10**18 - 1, 5]
    assert [payload.plain_salary_sum(x) for x in OTHER_COLLEGES] == [None] * len(OTHER_COLLEGES)


@pytest.mark.parametrize("broken", [
    f'<college id="x">{staff()}</college>', f'<college id="{2**31}">{staff()}</college>', f'<college id="1">{staff(id="a")}</college>',
    f'<college id="1">{staff("many")}</college>', f'<college id="1">{staff()}<staff></college>', f'<college id="1"><college id="1">{staff()}</college>'])
def test_broken_documents_are_refused(frame, broken):
    df = frame(packed(PLAIN_COLLEGES[0] + broken), "p binary")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        df.select(payload.packed_salary_sums(F.col("p"))).collect()


def test_documents_are_split_alike(frame):
    texts = ["<college>a</college><college >b</college>", "<colleges>x</colleges><college\nid='1'>\n</college>c", "<college/><college /></college>", "none",
             "<college id='>'></college></college>", "<college><college>a</college></college>", "<college\u00a0>a</college><college\x0b>b</college>", "<college>"]
    split = frame([(x,) for x in texts], "x string").select(payload.split_documents(F.col("x"), "college")).collect()
    assert [list(payload.college_documents(x)) for x in texts] == [r[0] for r in split]


def test_payloads_are_packed_and_read_in_one_call(spark, tmp_path):
    spark.sql("SELECT id AS o_orderkey, 3L AS o_custkey, 99.5D AS o_totalprice, DATE'2024-01-01' AS o_orderdate FROM range(5)").write.parquet(
        f"{tmp_path}/orders.parquet")
    found = QUERIES["xml_multi_sum"](spark, str(tmp_path))
    assert found._jdf.queryExecution().sparkPlan().toString().count("ArrowEvalPython") == 1
    assert tuple(found.first()) == (5 * (3 * (99 + 3 + 35000) + 3), 15)
