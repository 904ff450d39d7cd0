"""Compressed XML, JSON and message payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import payload as pl
from millrace.functions.messages import message_text
from millrace.functions.records import json_row, typed_record
from millrace.functions.temporal import freshness_ms
from millrace.operators.transforms import COUNTRIES, skewed_key, spread, union_all
from millrace.plans.registry import Tables, query
from millrace.schemas import OPTIONAL_RECORD, REQUIRED_RECORD
from millrace.session import scratch_path
from millrace.sources.tables import write_by_type


def college_of_order(shift: int = 0) -> Column:
    """A college with three staff made from an order row."""
    return pl.college_xml(F.col("o_orderkey"), [
        (F.col("o_orderkey") % 1000 + 101, "Admin", F.floor("o_totalprice") + shift),
        (F.col("o_orderkey") % 1000 + 102, "HR", F.col("o_custkey")),
        (F.col("o_orderkey") % 1000 + 103, "IT", F.lit(35000))])


def spread_orders(t: Tables) -> DataFrame:
    return spread(t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), "o_orderkey")


def college_payloads(t: Tables) -> DataFrame:
    """One compressed college document per order."""
    return spread_orders(t).select("o_orderkey", pl.gzip(F.encode(college_of_order(), "UTF-8")).alias("payload"))


def multi_payloads(t: Tables) -> DataFrame:
    """Three documents per payload."""
    texts = [college_of_order(shift) for shift in (0, 1, 2)]
    return spread_orders(t).select("o_orderkey", pl.gzip(F.encode(F.concat_ws("\n", *texts), "UTF-8")).alias("payload"))


BASIC = "CAST(floor(o_totalprice) AS BIGINT) + o_custkey + 35000"
COUNTRY = f"({COUNTRIES})[o_orderkey % 10 + 1]"


@query("xml_gunzip_sum", f"SELECT CAST(sum({BASIC}) AS BIGINT) AS total, count(*) AS docs FROM orders")
def xml_gunzip_sum(t: Tables) -> DataFrame:
    return college_payloads(t).select(pl.packed_salary_sum(F.col("payload")).alias("s")).agg(
        F.sum("s").alias("total"), F.count("*").alias("docs"))


@query("xml_split_multi", """
    SELECT o_orderkey, 3 AS docs, CAST(3 * length('<college id="') AS INT) AS marker FROM orders""")
def xml_split_multi(t: Tables) -> DataFrame:
    docs = pl.split_documents(pl.gunzip_text(F.col("payload")), "college")
    starts = F.aggregate(docs, F.lit(0), lambda n, d: n + F.when(
        d.startswith('<college id="') & d.endswith("</college>"), F.lit(13)).otherwise(0))
    return multi_payloads(t).select("o_orderkey", F.size(docs).alias("docs"), starts.alias("marker"))


@query("xml_multi_sum", f"SELECT CAST(sum(3 * ({BASIC}) + 3) AS BIGINT) AS total, 3 * count(*) AS docs FROM orders")
def xml_multi_sum(t: Tables) -> DataFrame:
    """Sums are a column of their own before they become rows, so that one call into Python packs and reads a payload.

    Outer, since Spark puts a filter on empty lists before the shuffle for the plain ``explode``, which would read all payloads
    twice. A payload without documents has a NULL, which is neither summed nor counted.
    """
    sums = multi_payloads(t).select(pl.packed_salary_sums(F.col("payload")).alias("sums"))
    return sums.select(F.explode_outer("sums").alias("s")).agg(F.sum("s").alias("total"), F.count("s").alias("docs"))


@query("xml_xpath_extract", f"""
    SELECT o_orderkey AS college_id, 'Admin' AS first_dep, 5 AS first_dep_length, {BASIC} AS basic_sum,
           3 * (o_orderkey % 1000) + 306 AS id_sum FROM orders""")
def xml_xpath_extract(t: Tables) -> DataFrame:
    """All fields of a document from one parse, through the map of extracted values."""
    colleges = college_payloads(t).select(pl.parse_college(pl.gunzip_text(F.col("payload"))).alias("college"))
    parsed = colleges.select(pl.college_fields(F.col("college")).alias("m"))
    return parsed.select(
        F.col("m")["college_id"].cast("bigint").alias("college_id"),
        F.col("m")["college_first_staff_dep_name"].alias("first_dep"),
        F.col("m")["college_first_staff_dep_name_length"].cast("int").alias("first_dep_length"),
        F.col("m")["staff_basic_salary_sum"].cast("bigint").alias("basic_sum"),
        F.col("m")["staff_id_attr_sum"].cast("bigint").alias("id_sum"))


@query("xml_sum_per_key", f"SELECT {COUNTRY} AS country, CAST(sum({BASIC}) AS BIGINT) AS total FROM orders GROUP BY 1")
def xml_sum_per_key(t: Tables) -> DataFrame:
    """Parsed before the shuffle: only key and number are exchanged, never documents."""
    return college_payloads(t).select(
        skewed_key(F.col("o_orderkey")).alias("country"), pl.packed_salary_sum(F.col("payload")).alias("s")).groupBy(
        "country").agg(F.sum("s").alias("total"))


# --- JSON ------------------------------------------------------------------

@query("json_variant_filter", """
    SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events
    WHERE CAST(json_extract(props, '$.k') AS INT) = 10""")
def json_variant_filter(t: Tables) -> DataFrame:
    """Semi-structured column written and read as VARIANT, filtered on a path with a safe cast."""
    path = scratch_path(t.spark, "variant")
    t("events").select("event_id", "user_id", F.parse_json("props").alias("props")).write.parquet(path)
    k = F.try_variant_get("props", "$.k", "int")
    return t.spark.read.parquet(path).where(k == 10).select("event_id", "user_id", k.alias("k"))


def record_json(prefix: str, given: Column | None = None) -> Column:
    """An order as a JSON document of the eleven-field record; where ``given`` is false, fields are missing."""
    values = {
        "String": F.col("o_orderpriority"), "Int": F.col("o_orderkey"), "Date": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "Timestamp": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), "Boolean": F.col("o_orderkey") % 2 == 0,
        "Numeric": (F.col("o_custkey").cast("decimal(20,2)") / 100).cast("decimal(20,2)"), "Double": F.col("o_totalprice"),
        "Time": F.lit("12:34:56.789"), "Bytes": F.col("o_orderstatus"), "Float": F.lit(7.5), "Long": F.col("o_custkey")}
    return F.to_json(F.struct(*[(v if given is None else F.when(given, v)).alias(prefix + k) for k, v in values.items()]))


def record_text(record: str, prefix: str) -> Column:
    """All fields of a typed record as one text, ``-`` for a missing one."""
    f = {k: F.col(f"{record}.{prefix}{k}") for k in ("String", "Int", "Date", "Timestamp", "Boolean", "Numeric", "Double", "Time", "Bytes", "Float", "Long")}
    f["Timestamp"], f["Bytes"] = F.date_format(f["Timestamp"], "yyyy-MM-dd HH:mm:ss"), F.decode(f["Bytes"], "UTF-8")
    f["Numeric"] = f["Numeric"].cast("decimal(20,2)")
    return F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("-")) for v in f.values()])


RECORD_TEXT_SQL = """o_orderpriority || '|' || o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    || '|' || (o_orderkey % 2 = 0) || '|' || CAST(o_custkey / 100.0 AS DECIMAL(20,2)) || '|' || CAST(o_totalprice AS DOUBLE) || '|12:34:56.789|'
    || o_orderstatus || '|7.5|' || o_custkey"""


@query("route_by_type", f"""
    SELECT o_orderkey % 3 = 0 AS required, {RECORD_TEXT_SQL} AS text FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 <> 0
    UNION ALL SELECT false, '-|-|-|-|-|-|-|-|-|-|-' FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 = 0""")
def route_by_type(t: Tables) -> DataFrame:
    """Records parsed by the schema their type names, each type in a table of its own, all written in one pass."""
    is_required = F.col("o_orderkey") % 3 == 0
    source = t("orders").select(
        F.when(is_required, "required_record").otherwise("optional_record").alias("table"),
        F.when(is_required, record_json("myRequired")).otherwise(record_json("myOptional", F.col("o_orderkey") % 5 != 0)).alias("json"))
    schemas = {"required_record": REQUIRED_RECORD, "optional_record": OPTIONAL_RECORD}
    tables = write_by_type(source, "table", "json", schemas, scratch_path(t.spark, "routes"))
    return union_all([tables[name].select(F.lit(name == "required_record").alias("required"), record_text(name, prefix).alias("text"))
                      for name, prefix in (("required_record", "myRequired"), ("optional_record", "myOptional"))])


@query("record_to_json_row", """
    SELECT o_orderkey, '{"myRequiredString":"' || o_orderpriority || '","myRequiredInt":"' || o_orderkey
      || '","myRequiredDate":"' || strftime(o_orderdate, '%Y-%m-%d') || '","myRequiredTimestamp":"'
      || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.000 UTC","myRequiredBoolean":' || (o_orderkey % 2 = 0)
      || ',"myRequiredNumeric":"' || CAST(CAST(o_custkey AS DECIMAL(38,9)) / 100 AS DECIMAL(38,9))
      || '","myRequiredDouble":' || CAST(o_totalprice AS DOUBLE)
      || ',"myRequiredTime":"12:34:56.789","myRequiredBytes":"' || base64(encode(o_orderstatus))
      || '","myRequiredFloat":7.5,"myRequiredLong":"' || o_custkey || '"}' AS json
    FROM orders""")
def record_to_json_row(t: Tables) -> DataFrame:
    """JSON documents parsed into typed records and written as warehouse rows, all eleven fields."""
    record = typed_record(record_json("myRequired"), REQUIRED_RECORD)
    return t("orders").select("o_orderkey", json_row(record, REQUIRED_RECORD).alias("json"))


# --- messages --------------------------------------------------------------

def messages(t: Tables, copies: int = 1) -> DataFrame:
    """Events as bus messages, each published ``copies`` times under the same id attribute; one in ten has none."""
    ts = F.col("ts").cast("timestamp")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    rows = t("events").select(
        F.encode(F.col("event_id").cast("string"), "UTF-8").alias("payload"),
        F.map_filter(F.create_map(
            F.lit("msgAttrName"), F.when(F.col("event_id") % 10 != 3, F.concat(F.lit("m"), F.col("event_id").cast("string"))),
            F.lit("et"), F.date_format(ts, iso),
            F.lit("pt"), F.date_format(ts + F.expr("INTERVAL 3 SECONDS"), iso)), lambda k, v: v.isNotNull()).alias("attrs"),
        F.col("event_id").alias("n"))
    if copies > 1:
        rows = rows.withColumn("copy", F.explode(F.array(*[F.lit(i) for i in range(copies)])))
        return rows.select("payload", "attrs", F.concat_ws("-", F.col("n").cast("string"), F.col("copy").cast("string")).alias("msg_id"))
    return rows.select("payload", "attrs", F.col("n").cast("string").alias("msg_id"))


MESSAGE_SQL = """'body=' || event_id || ', attrs={et=' || strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%g')
      || 'Z' || CASE WHEN event_id % 10 <> 3 THEN ', msgAttrName=m' || event_id ELSE '' END || ', pt='
      || strftime(date_trunc('milliseconds', ts) + INTERVAL 3 SECOND, '%Y-%m-%dT%H:%M:%S.%g') || 'Z}, msgId='"""


@query("message_concat", f"""
    SELECT {MESSAGE_SQL} || event_id || ', dataFreshnessMs=3000, customPublishTimeDataFreshnessMs=0'
      || ', customEventTimeDataFreshnessMs=3000' AS value FROM events""")
def message_concat(t: Tables) -> DataFrame:
    published, event = F.to_timestamp(F.col("attrs")["pt"]), F.to_timestamp(F.col("attrs")["et"])
    return messages(t).select(message_text(
        F.col("payload"), F.col("attrs"), F.col("msg_id"), dataFreshnessMs=freshness_ms(published, event),
        customPublishTimeDataFreshnessMs=freshness_ms(published, F.to_timestamp(F.col("attrs")["pt"])),
        customEventTimeDataFreshnessMs=freshness_ms(published, event)).alias("value"))
