"""Readers and writers: every query writes what it derives from the tables and reads it back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.temporal import date_parts
from millrace.plans.registry import Tables, query
from millrace.session import scratch_path, scratch_table
from millrace.sources import avro
from millrace.sources import files as fl
from millrace.sources import tables as tb


@query("scan_parquet", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_shipdate >= TIMESTAMP '1997-01-01'""")
def scan_parquet(t: Tables) -> DataFrame:
    rows = t("lineitem").where((F.col("l_quantity") > 45) & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


def subscriptions(t: Tables) -> DataFrame:
    """Orders in the shape of the nested subscription record."""
    ts = F.col("o_orderdate")
    at = ts + F.expr("make_dt_interval(0, 0, 0, o_orderkey % 86400)")
    return t("orders").select(
        F.concat(F.lit("id"), F.col("o_orderkey").cast("string")).alias("id"),
        at.cast("timestamp").alias("creation_timestamp"), ts.cast("date").alias("expiration_date"),
        at.alias("my_datetime"), F.to_time(F.date_format(at, "HH:mm:ss")).alias("my_time"),
        F.col("o_totalprice").cast("decimal(38,9)").alias("my_numeric"),
        F.array(F.col("o_orderkey"), F.col("o_custkey"), F.lit(None).cast("bigint")).alias("numbers"),
        F.struct((F.col("o_custkey") % 100).cast("int").alias("myRequiredInt"),
                 F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("myNullableLong"),
                 (F.col("o_orderstatus") == "F").alias("myRequiredBoolean")).alias("myRequiredSubRecord"),
        F.when(F.col("o_orderkey") % 3 == 0, F.array(
            F.struct(F.lit(1.2).alias("myRequiredDouble"), F.lit(None).cast("float").alias("myOptionalFloat")),
            F.struct(F.lit(3.4).alias("myRequiredDouble"), F.lit(5.5).cast("float").alias("myOptionalFloat"))))
        .alias("myOptionalArraySubRecords"))


def subscription_text(rows: DataFrame) -> DataFrame:
    """Every field as text."""
    sub = F.col("myRequiredSubRecord")
    return rows.select(
        "id", F.concat_ws("|", F.date_format("creation_timestamp", "yyyy-MM-dd HH:mm:ss"), F.date_format("expiration_date", "yyyy-MM-dd"),
                          F.date_format("my_datetime", "HH:mm"), F.col("my_time").cast("string"),
                          F.col("my_numeric").cast("decimal(18,2)").cast("string"),
                          F.array_join("numbers", ",", "null"), sub["myRequiredInt"].cast("string"),
                          F.coalesce(sub["myNullableLong"].cast("string"), F.lit("-")),
                          sub["myRequiredBoolean"].cast("string"),
                          F.coalesce(F.array_join(F.transform("myOptionalArraySubRecords", lambda r: F.concat(
                              r["myRequiredDouble"].cast("string"), F.lit(":"), F.coalesce(r["myOptionalFloat"].cast("string"), F.lit("-")))), ","),
                              F.lit("-"))).alias("text"))


SUBSCRIPTION_SQL = """
    SELECT 'id' || o_orderkey AS id, strftime(a, '%Y-%m-%d %H:%M:%S') || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || strftime(a, '%H:%M') || '|' || strftime(a, '%H:%M:%S')
      || '|' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '|' || o_orderkey || ',' || o_custkey || ',null|'
      || o_custkey % 100 || '|' || CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE '-' END || '|'
      || (o_orderstatus = 'F') || '|' || CASE WHEN o_orderkey % 3 = 0 THEN '1.2:-,3.4:5.5' ELSE '-' END AS text
    FROM (SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS a FROM orders)"""


@query("scan_nested", SUBSCRIPTION_SQL)
def scan_nested(t: Tables) -> DataFrame:
    """Nested records of all types, written and read."""
    path = scratch_path(t.spark, "nested")
    fl.write_records(subscriptions(t), path)
    return subscription_text(t.spark.read.parquet(path))


@query("avro_nested", SUBSCRIPTION_SQL)
def avro_nested(t: Tables) -> DataFrame:
    """The same through Avro container files, read in splits that end anywhere; times of day travel as text."""
    path, fmt = scratch_path(t.spark, "avro"), avro.register(t.spark)
    rows = subscriptions(t)
    rows.withColumn("my_time", F.col("my_time").cast("string")).write.format(fmt).mode("append").options(path=path, codec="snappy").save()
    read = t.spark.read.format(fmt).options(path=path, splitBytes="200000").load()
    return subscription_text(read.withColumn("my_time", F.col("my_time").cast(rows.schema["my_time"].dataType)))


@query("avro_schema_resolution", """
    SELECT o_orderkey AS id, CAST(o_custkey AS DOUBLE) AS customer, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'none' END AS status FROM orders""")
def avro_schema_resolution(t: Tables) -> DataFrame:
    """Files of two schemas read as a third: a field renamed and widened, one that the older files lack, one left out."""
    path, fmt = scratch_path(t.spark, "avro-two"), avro.register(t.spark)
    even = F.col("o_orderkey") % 2 == 0
    new = t("orders").where(even).select("o_orderpriority", F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("long").alias("customer"),
                                         F.col("o_orderstatus").alias("status"))
    old = t("orders").where(~even).select(F.col("o_custkey").cast("int").alias("cust"), F.col("o_orderkey").alias("id"))
    for part, codec in ((new, "deflate"), (old, "zstandard")):
        part.write.format(fmt).mode("append").options(path=path, codec=codec).save()
    wanted = {"type": "record", "name": "order", "fields": [
        {"name": "id", "type": ["null", "long"]}, {"name": "customer", "aliases": ["cust"], "type": ["null", "double"]},
        {"name": "status", "type": ["string", "null"], "default": "none"}]}
    return t.spark.read.format(fmt).options(path=path, avroSchema=json.dumps(wanted)).load()


@query("load_ndjson_nested", SUBSCRIPTION_SQL)
def load_ndjson_nested(t: Tables) -> DataFrame:
    """JSON lines with quoted integers and two timestamp spellings into the nested type."""
    path = scratch_path(t.spark, "ndjson")
    rows = subscriptions(t)
    zone = F.when(F.col("id").endswith("1"), " UTC").otherwise("")
    spelled = rows.withColumns({
        "creation_timestamp": F.concat(F.date_format("creation_timestamp", "yyyy-MM-dd HH:mm:ss"), zone),
        "my_datetime": F.date_format("my_datetime", "yyyy-MM-dd HH:mm:ss"), "my_time": F.col("my_time").cast("string"),
        "numbers": F.transform("numbers", lambda x: x.cast("string"))})
    fl.write_records(spelled, path, fmt="json", codec="gzip")
    return subscription_text(fl.nested_json(t.spark, path, rows.schema))


@query("scan_csv_gz", """
    SELECT o_orderpriority, count(*) AS cnt, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           CAST(sum(o_custkey) AS BIGINT) AS keys FROM orders GROUP BY 1""")
def scan_csv_gz(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    line = fl.csv_line(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority"), F.col("o_totalprice").cast("decimal(18,2)"))
    fl.write_text(t("orders").select(line.alias("value")), path, compression="gzip")
    schema = T.StructType([T.StructField("orderkey", T.LongType()), T.StructField("custkey", T.LongType()),
                           T.StructField("priority", T.StringType()), T.StructField("price", T.DecimalType(18, 2))])
    return fl.csv_records(fl.read_lines(t.spark, path), schema).groupBy(F.col("priority").alias("o_orderpriority")).agg(
        F.count("*").alias("cnt"), F.sum("price").cast("double").alias("total"), F.sum("custkey").alias("keys"))


@query("scan_binary_files", """
    SELECT count(*) AS files_lines, CAST(sum(length(CAST(event_id AS VARCHAR) || ',' || coalesce(event_type, '')) + 1) AS BIGINT) AS bytes,
           CAST(bool_and(true) AS BOOLEAN) AS named FROM events""")
def scan_binary_files(t: Tables) -> DataFrame:
    """Files of bounded size read whole, with their names."""
    path = scratch_path(t.spark, "whole")
    lines = t("events").select(fl.csv_line(F.col("event_id"), F.col("event_type")).alias("value"))
    lines.write.option("maxRecordsPerFile", 1_000_000).text(path)
    files = fl.whole_files(t.spark, f"{path}/*.txt")
    text = F.decode("content", "UTF-8")
    return files.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).alias("files_lines"),
                     F.sum(F.length("content")).alias("bytes"), F.bool_and(F.col("name").endswith(".txt")).alias("named"))


@query("scan_hive_partitioned", """
    SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM events
    WHERE strftime(ts, '%d') >= '05' AND strftime(ts, '%d') < '08'""")
def scan_hive_partitioned(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "hive")
    parts = date_parts(F.col("ts"))
    rows = t.events.select("event_id", *[parts[p].alias(p) for p in ("year", "month", "day")])
    fl.write_by_destination(rows, path, ["year", "month", "day"])
    stored = fl.hive_partitioned(t.spark, path, "event_id BIGINT, year STRING, month STRING, day STRING")
    return stored.where("day >= '05' AND day < '08'")


@query("scan_external_empty", """
    SELECT 'before' AS at, 0 AS cnt, 0 AS total UNION ALL SELECT 'after', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders
    UNION ALL SELECT 'inferred', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders""")
def scan_external_empty(t: Tables) -> DataFrame:
    """Tables over an empty seed file, with given and with inferred schema, seen again after files arrive."""
    path = scratch_path(t.spark, "external")
    orders = t("orders").select("o_orderkey", "o_custkey")
    orders.limit(0).coalesce(1).write.parquet(path)
    name, inferred = scratch_table(t.spark, "external"), scratch_table(t.spark, "inferred")

    def counted(rows: DataFrame, label: str) -> DataFrame:
        return rows.agg(F.count("*").alias("cnt"), F.coalesce(F.sum("o_custkey"), F.lit(0)).alias("total")).select(
            F.lit(label).alias("at"), "cnt", "total")

    before = counted(tb.external_table(t.spark, name, path, "o_orderkey BIGINT, o_custkey BIGINT"), "before")
    seen_before = t.spark.createDataFrame(before.collect(), before.schema)
    orders.write.mode("append").parquet(path)
    after = counted(tb.refresh(t.spark, name), "after")
    return seen_before.unionByName(after).unionByName(counted(tb.external_table(t.spark, inferred, path), "inferred"))


@query("scan_merge_schema", """
    SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '-' ELSE c_mktsegment END AS segment FROM customer""")
def scan_merge_schema(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "evolved")
    customer = t("customer")
    customer.where("c_custkey % 2 = 0").select("c_custkey").write.parquet(f"{path}/v=1")
    customer.where("c_custkey % 2 = 1").select("c_custkey", "c_mktsegment").write.parquet(f"{path}/v=2")
    return fl.merged_schema(t.spark, path).select("c_custkey", F.coalesce("c_mktsegment", F.lit("-")).alias("segment"))


@query("scan_wildcard", """
    SELECT event_id, strftime(ts, '%Y%m%d') AS table_suffix FROM events WHERE regexp_matches(strftime(ts, '%Y%m%d'), '^2024010[2-4]$')""")
def scan_wildcard(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "wildcard")
    rows = t.events.select("event_id", F.concat(F.lit("job_message_"), F.date_format("ts", "yyyyMMdd")).alias("t"))
    fl.write_by_destination(rows, root, ["t"])
    schema = T.StructType([T.StructField("event_id", T.LongType())])
    return fl.wildcard(t.spark, root, "t=job_message_202401*", "^2024010[2-4]$", schema)


# --- sinks -----------------------------------------------------------------

@query("sink_text_shards", """
    SELECT 'fixed' AS kind, 4 AS shards, count(*) AS lines, CAST(sum(length(coalesce(c_name, '')) + 1 + length(coalesce(c_mktsegment, ''))) AS BIGINT) AS chars FROM customer
    UNION ALL SELECT 'auto', 0, count(*), CAST(sum(length(coalesce(c_name, '')) + 1 + length(coalesce(c_mktsegment, ''))) AS BIGINT) FROM customer""")
def sink_text_shards(t: Tables) -> DataFrame:
    lines = t("customer").select(fl.csv_line(F.col("c_name"), F.col("c_mktsegment")).alias("value"))
    fixed, auto = scratch_path(t.spark, "fixed"), scratch_path(t.spark, "auto")
    fl.write_text(lines, fixed, shards=4)
    fl.write_text(lines, auto)

    def counted(path: str, kind: str, shards) -> DataFrame:
        rows = fl.read_lines(t.spark, path).withColumn("f", F.col("_metadata.file_name"))
        return rows.agg(F.countDistinct("f").cast("int").alias("f"), F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars")).select(
            F.lit(kind).alias("kind"), shards.alias("shards"), "lines", "chars")

    return counted(fixed, "fixed", F.col("f")).unionByName(counted(auto, "auto", F.lit(0)))


@query("sink_dynamic_partition", """
    SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour,
           count(*) AS cnt, min(event_id) AS first_id FROM events GROUP BY 1, 2, 3, 4""")
def sink_dynamic_partition(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "dated")
    parts = date_parts(F.col("ts"))
    fl.write_by_destination(t.events.select("event_id", *[c.alias(n) for n, c in parts.items()]), path, list(parts))
    stored = fl.hive_partitioned(t.spark, path, "event_id BIGINT, year STRING, month STRING, day STRING, hour STRING")
    return stored.groupBy(*parts).agg(F.count("*").alias("cnt"), F.min("event_id").alias("first_id"))


@query("sink_windowed", """
    SELECT strftime(time_bucket(INTERVAL 12 HOUR, ts), '%Y-%m-%d_%H-%M-%S') AS win_start, count(*) AS cnt,
           CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1""")
def sink_windowed(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "windowed")
    start = F.date_format(F.window("ts", "12 hours")["start"], "yyyy-MM-dd_HH-mm-ss")
    fl.write_by_destination(t.events.select("event_id", start.alias("win_start")), path, ["win_start"])
    stored = fl.hive_partitioned(t.spark, path, "event_id BIGINT, win_start STRING")
    return stored.groupBy("win_start").agg(F.count("*").alias("cnt"), F.sum("event_id").alias("total"))


@query("sink_table_modes", """
    SELECT 'append' AS mode, 2 * count(*) AS cnt FROM customer UNION ALL SELECT 'truncate', count(*) FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'create never', -1""")
def sink_table_modes(t: Tables) -> DataFrame:
    customer = t("customer").select("c_custkey", "c_acctbal")
    appended, replaced = scratch_table(t.spark, "append"), scratch_table(t.spark, "truncate")
    paths = [scratch_path(t.spark, "table") for _ in range(2)]
    for _ in range(2):
        tb.load_table(customer, appended, paths[0])
    tb.load_table(customer, replaced, paths[1])
    tb.load_table(customer.where("c_acctbal < 0"), replaced, paths[1], write="truncate", create=False)
    try:
        tb.load_table(customer, scratch_table(t.spark, "missing"), scratch_path(t.spark, "missing"), create=False)
        refused = 0
    except ValueError:
        refused = -1
    counts = [t.spark.table(n).agg(F.count("*").alias("cnt")).select(F.lit(m).alias("mode"), "cnt")
              for n, m in ((appended, "append"), (replaced, "truncate"))]
    last = t.spark.range(1).select(F.lit("create never").alias("mode"), F.lit(refused).cast("bigint").alias("cnt"))
    return counts[0].unionByName(counts[1]).unionByName(last)


@query("sink_fanout", """
    SELECT 'table' AS sink, count(*) AS cnt, CAST(sum(o_custkey) AS BIGINT) AS total FROM orders
    UNION ALL SELECT 'dated', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders
    UNION ALL SELECT 'json', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders""")
def sink_fanout(t: Tables) -> DataFrame:
    """One collection in three sinks; the first is written once and feeds the others."""
    root = scratch_path(t.spark, "fanout")
    rows = t("orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy").alias("year"))
    fl.write_records(rows, f"{root}/table")
    stored = t.spark.read.parquet(f"{root}/table")
    fl.write_by_destination(stored, f"{root}/dated", ["year"])
    fl.write_records(stored, f"{root}/json", fmt="json", codec="gzip")
    schema = "o_orderkey BIGINT, o_custkey BIGINT, year STRING"
    sinks = {"table": stored, "dated": t.spark.read.schema(schema).parquet(f"{root}/dated"),
             "json": t.spark.read.schema(schema).json(f"{root}/json")}
    counted = [rows.agg(F.count("*").alias("cnt"), F.sum("o_custkey").alias("total")).select(F.lit(n).alias("sink"), "cnt", "total")
               for n, rows in sinks.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("dml_insert_delete", """
    SELECT 'inserted' AS step, count(*) + 2 AS cnt, CAST(sum(s_suppkey) AS BIGINT) - 3 AS total FROM supplier
    UNION ALL SELECT 'deleted', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier WHERE s_acctbal >= 1000
    UNION ALL SELECT 'emptied', 0, 0""")
def dml_insert_delete(t: Tables) -> DataFrame:
    spark, name, path = t.spark, scratch_table(t.spark, "dml"), scratch_path(t.spark, "dml")
    tb.load_table(t("supplier").select("s_suppkey", "s_acctbal"), name, path)
    spark.sql(f"INSERT INTO {name} VALUES (-1, 0.0), (-2, 10.0)")
    kept, none = scratch_path(spark, "dml-kept"), scratch_path(spark, "dml-none")
    tb.delete_where(spark.table(name), F.col("s_acctbal") < 1000, kept)
    tb.delete_where(spark.table(name), F.lit(True), none)
    steps = {"inserted": spark.table(name), "deleted": spark.read.parquet(kept),
             "emptied": spark.read.schema("s_suppkey BIGINT").parquet(none)}
    counted = [rows.agg(F.count("*").alias("cnt"), F.coalesce(F.sum("s_suppkey"), F.lit(0)).alias("total")).select(
        F.lit(n).alias("step"), "cnt", "total") for n, rows in steps.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])
