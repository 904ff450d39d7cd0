"""Web-archive records: not-modified revisits find the full response they stand for.

A revisit record says that a server answered "not modified". It is joined as of its date to the latest earlier full response
of the same canonical url; the validators that both carry (entity tag by weak comparison, Last-Modified, payload digest) must
all agree; then the stored headers are updated with those of the revisit that an answer without a body may update.

Status of a revisit: ``resolved``; ``mismatch`` (a common validator differs: the resource had changed unseen); ``unchecked`` (no
validator in common); ``orphan`` (no earlier response). Only ``resolved`` rows have merged headers.

The as-of join is two levels of windows over narrow rows without payloads: inside (url, day), and over each url's days, of
which only the last response is carried on. So a url with a third of all captures is split by day, and no window holds more
than one day of a url or one row per day.

Canonical url: scheme, ``www.``, default port, fragment, an empty query and case of the host don't count; an empty path is
``/``. Defined cases: a null or unusable url makes its own canonical url ``""``, which is never matched; records without a date
are orphans and never found; of responses at one instant the one with the largest ``record_id`` counts, and a response at
the same instant as the revisit is not earlier; null headers are none; header names are compared in lower case, of
names that differ in case only the greatest spelling counts; repeated revisits get a row each. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEADERS = "map<string,string>"

# fixed values: headers that describe the body or the connection and are not updated by an answer without a body
NOT_UPDATED = ["connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
               "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade"]


def canonical(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    usable = u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, r"^[^:]*://([^/?#]*)", 1)), r":(?:80|443)?$", ""), r"^www\d*\.", "")
    rest = F.regexp_replace(F.regexp_extract(u, r"(?s)^[^:]*://[^/?#]*([^#]*)", 1), r"\?$", "")
    return F.when(usable, F.concat(host, F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))).otherwise(F.lit(""))


def lower_names(headers: Column) -> Column:
    entries = F.map_entries(F.coalesce(headers.cast(HEADERS), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(
        n.alias("key"), F.array_max(F.filter(entries, lambda e: F.lower(e["key"]) == n))["value"].alias("value"))))


def opaque(tag: Column) -> Column:
    """An entity tag without its weakness mark."""
    return F.regexp_replace(F.trim(tag), r"^[Ww]/", "")


def merged(stored: Column, update: Column) -> Column:
    allowed = F.map_filter(update, lambda k, v: ~k.isin(NOT_UPDATED))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k)), allowed)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit of ``records(record_id, warc_type, target_uri, warc_date, headers, payload_digest)`` with its resolution:
    ``record_id, canonical_uri, warc_date, status, refers_to, refers_to_date, headers`` (merged, null unless resolved)."""
    response = F.col("warc_type") == "response"
    rows = records.filter(F.col("warc_type").isin("response", "revisit")).select(
        "record_id", response.alias("full"), canonical(F.col("target_uri")).alias("uri"), F.col("warc_date").alias("date"),
        lower_names(F.col("headers")).alias("headers"), F.col("payload_digest").alias("digest"))
    usable = (F.col("uri") != "") & F.col("date").isNotNull()
    found = F.when(F.col("full"), F.struct("record_id", "date", "headers", "digest"))
    good = rows.filter(usable).withColumn("day", F.to_date("date"))

    # the last response of each day, then of all days before a day
    days = good.groupBy("uri", "day").agg(F.max_by(found, F.when(F.col("full"), F.struct("date", "record_id"))).alias("last"),
                                          F.max((~F.col("full")).cast("int")).alias("asked"))
    earlier = Window.partitionBy("uri").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.withColumn("carried", F.last("last", ignorenulls=True).over(earlier)).filter("asked = 1 and carried is not null") \
        .select("uri", "day", "carried")
    within = Window.partitionBy("uri", "day").orderBy("date", "full", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    asked = good.withColumn("same_day", F.last(found, ignorenulls=True).over(within)).filter(~F.col("full"))
    joined = asked.join(carried, ["uri", "day"], "left").select("record_id", "uri", "date", "headers", "digest", F.coalesce("same_day", "carried").alias("r"))
    lost = rows.filter(~usable & ~F.col("full")).select("record_id", "uri", "date", "headers", "digest")
    joined = joined.unionByName(lost, allowMissingColumns=True)

    both = [(opaque(F.col("headers")["etag"]), opaque(F.col("r.headers")["etag"])),
            (F.trim(F.col("headers")["last-modified"]), F.trim(F.col("r.headers")["last-modified"])), (F.col("digest"), F.col("r.digest"))]
    differs = F.lit(False)
    agrees = F.lit(False)
    for x, y in both:
        differs = differs | F.coalesce(x != y, F.lit(False))
        agrees = agrees | F.coalesce(x == y, F.lit(False))
    status = F.when(F.col("r").isNull(), "orphan").when(differs, "mismatch").when(agrees, "resolved").otherwise("unchecked")
    return joined.withColumn("status", status).select(
        "record_id", F.col("uri").alias("canonical_uri"), F.col("date").alias("warc_date"), "status", F.col("r.record_id").alias("refers_to"),
        F.col("r.date").alias("refers_to_date"), F.when(F.col("status") == "resolved", merged(F.col("r.headers"), F.col("headers"))).alias("headers"))


def captures(pages: DataFrame, revisits: int = 3) -> DataFrame:
    """A crawl of ``pages(page_id, url, html)`` as records: a response for each page and ``revisits`` not-modified answers at other
    times, under spellings of the url that mean the same, with agreeing, differing or missing validators."""
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    first = F.col("page_id") * 7919 % 1000003
    modified = F.concat(F.lit("day "), (F.col("page_id") % 365).cast("string"))
    digest = F.concat(F.lit("sha1:"), F.sha1(F.coalesce("html", F.lit(""))))

    def headers(**values: Column) -> Column:
        pairs = [F.struct(F.lit(k.replace("_", "-")).alias("key"), v.alias("value")) for k, v in values.items()]
        return F.map_from_entries(F.filter(F.array(*pairs), lambda e: e["value"].isNotNull()))

    def instant(seconds: Column) -> Column:
        return F.timestamp_seconds(seconds + 1_700_000_000)

    full = pages.select(F.concat(F.lit("response-"), F.col("page_id")).alias("record_id"), F.lit("response").alias("warc_type"), F.col("url").alias("target_uri"),
                        instant(first).alias("warc_date"), digest.alias("payload_digest"),
                        headers(Content_Type=F.lit("text/html"), Content_Length=F.octet_length("html").cast("string"), ETag=tag, Last_Modified=modified,
                                Server=F.lit("origin"), Cache_Control=F.lit("max-age=600")).alias("headers"))
    k = F.col("k")
    kind = (F.col("page_id") + k) % 6
    uri = F.when(k == 1, F.concat("url", F.lit("#again"))).when(k == 2, F.regexp_replace("url", "^http:", "HTTPS:")).otherwise(F.col("url"))
    again = pages.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(revisits - 1)))).select(
        F.concat(F.lit("revisit-"), F.col("page_id"), F.lit("-"), k).alias("record_id"), F.lit("revisit").alias("warc_type"), uri.alias("target_uri"),
        instant((F.col("page_id") * 7919 + (k + 1) * 104729 * (F.col("page_id") % 7 + 1)) % 1000003).alias("warc_date"),
        F.when(kind == 4, digest).alias("payload_digest"),
        headers(ETag=F.when(kind == 0, tag).when(kind == 1, F.concat(F.lit("W/"), tag)).when(kind == 3, F.concat(F.lit('"new'), F.substring(tag, 2, 40))),
                Last_Modified=F.when(kind == 2, modified), Server=F.concat(F.lit("edge-"), k.cast("string")), content_length=F.lit("0"),
                CACHE_CONTROL=F.concat(F.lit("max-age="), k.cast("string"))).alias("headers"))
    return full.unionByName(again)
