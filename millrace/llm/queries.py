"""One query per operator, over the whole table it is meant for, with the SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, mixing, near, pages, periodic, quality, sharding, spelling, substrings, tokens, urls, warc
from millrace.llm.common import table, words_of
from millrace.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare(spark), folder)
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return function
    return keep


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality_sql() -> str:
    bits = " | ".join(f"(CASE WHEN {condition} THEN {quality.BITS[name]} ELSE 0 END)" for name, condition in quality.RULES)
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS body, {WORDS_SQL} AS w FROM documents),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i:i + 4], ' ')) AS n
        FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM win, (SELECT unnest([0, 1, 2, 3, 4]) AS k) WHERE win.n > 1 GROUP BY r),
lines AS (SELECT r, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x FROM d),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
      length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
      len(x) - len(list_distinct(x)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, len(x) AS n_lines,
      length(regexp_replace(body, '\P{{Lu}}+', '', 'g')) AS n_upper, length(regexp_replace(body, '\P{{L}}+', '', 'g')) AS n_letters,
      length(regexp_replace(body, '[^0-9]+', '', 'g')) AS n_digits, length(regexp_replace(body, '[^!]+', '', 'g')) AS n_exclaims,
      length(regexp_replace(body, '[^.!?。！？…]+', '', 'g')) AS n_stops, length(regexp_replace(body, '[^�]+', '', 'g')) AS n_broken
      FROM d JOIN lines USING (r) LEFT JOIN covered USING (r)),
b AS (SELECT *, CAST({bits} AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (failed_bits & {quality.POLICIES['base']}) <> 0 AS base_failed,
       (failed_bits & {quality.POLICIES['v1'] | quality.POLICIES['base']}) = 0 AS kept, failed_bits
FROM b"""


@query("op8_quality_rules", _quality_sql())
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements, failure bits and the verdict of policy ``v1`` for every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.apply_policy(quality.ledger(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_bits")


@query("op6_order_minhash")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query("op4_template_leaks")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that contains a benchmark item, or one with exchanged numbers, names or units."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op1_pivotal_mix")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    plan = mixing.plan_mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies",
                       F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("nth_equal_row"))


@query("op9_longest_first_shards")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """The shard and slot of every document under the law of near equal bytes."""
    body = F.coalesce(F.col("text"), F.lit(""))
    # what is taken from the text is taken before the rows move, so that texts stay where they are
    docs = table(spark, folder, "documents").select("doc_id", "text", (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32"))
    return sharding.shard(docs, shards=8).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                                 F.lit(None).cast("int").alias("grown_shard"))


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op3_suffix_trees")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without word sequences that came before."""
    kept = substrings.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op7_style_tree_text")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    out = pages.extract(table(spark, folder, "pages"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


RULES = [urls.Rule("allow", "com"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
         urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/")]


@query("op5_url_models")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every url, by rule or by the two character models."""
    return urls.judge(table(spark, folder, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict", "score")


@query("op11_recompression_runs")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of which are made periodic first."""
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = table(spark, folder, "documents").select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    # the documents to be made periodic, with their words; others keep their text
    words, n = F.col("words"), F.size("words")
    docs = docs.withColumn("words", F.when(F.col("h") % 10 == 0, words_of(F.col("text"))))
    docs = docs.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    docs = docs.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.transform(F.sequence("a", n - 1), lambda i: F.get(words, F.col("a") + (i - F.col("a")) % F.col("p")))
    made = F.when(F.col("a").isNotNull(), F.array_join(F.concat(F.slice(words, 1, F.col("a")), tail), " ")).otherwise(F.col("text"))
    out = periodic.collapse_runs(docs.select("doc_id", made.alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return out.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.back")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.less")).alias("period"), F.floor(1000 * F.col("longest.length") / -F.col("longest.less")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


@query("op12_bpe")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = bpe.decode(bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), path), path)
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
                      F.sha2("decoded_text", 256).alias("decoded_sha256"))


_SPELLING_SQL = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n FROM runs GROUP BY ALL),
spelled AS (SELECT w, n, list_transform(string_split(doc_id || ':' || w, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [195, ord(c) - 64] END) AS b
            FROM low WHERE length(w) >= 7),
hashed AS (SELECT w, n, xor(list_reduce([4294967295] || list_transform(flatten(b), lambda x: CAST(x AS BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM spelled, crc),
made AS (SELECT CASE WHEN h % 31 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM words, unnest(generate_series(1, length(word))) AS u(i)),
links AS (SELECT a.word, b.word AS near, b.n AS m FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM words a JOIN holes b ON a.word = b.rest
    UNION SELECT b.word, a.word, a.n FROM words a JOIN holes b ON a.word = b.rest),
best AS (SELECT word, count(*) AS n_near, min({'less': -m, 'near': near}) AS best FROM links GROUP BY word),
judged AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 10 * n THEN best.near END AS form,
    CASE WHEN -best.less >= 10 * n THEN -best.less END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, coalesce(form, word) AS root, form IS NULL AS last FROM judged
    UNION ALL SELECT chain.word, coalesce(j.form, chain.root), j.form IS NULL FROM chain JOIN judged j ON j.word = chain.root WHERE NOT chain.last)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM judged JOIN chain USING (word) WHERE chain.last"""


@query("op13_spelling_forms", _SPELLING_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """The frequent form and the root of every word of the documents, some of which lose a letter first."""
    runs = table(spark, folder, "documents").select("doc_id", F.explode(spelling.letter_runs(F.col("text"))).alias("run"))
    # a run and what may be left of it has at least seven letters
    runs = runs.filter(F.length("run") >= 7).withColumn("h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run"))))
    lost = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % 31 == 0, F.overlay("run", F.lit(""), lost + 1, F.lit(1))).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).filter(F.length("word") >= 7).groupBy("word").agg(F.count("*").alias("n")).filter("n >= 2")
    return spelling.forms(words)


_WARC_SQL = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
canon AS (SELECT *, CASE WHEN regexp_matches(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]') THEN
    regexp_replace(regexp_replace(lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)), ':(80|443)?$', ''), '^www\d*\.', '') ||
    CASE WHEN regexp_replace(regexp_extract(url, '(?s)^[^:]*://[^/?#]*([^#]*)', 1), '\?$', '') LIKE '/%' THEN '' ELSE '/' END ||
    regexp_replace(regexp_extract(url, '(?s)^[^:]*://[^/?#]*([^#]*)', 1), '\?$', '') ELSE '' END AS uri FROM p),
r AS (SELECT uri, page_id * 7919 % 1000003 AS sec, 'response-' || page_id AS rid, md5(html) AS tag, 'day ' || (page_id % 365) AS modified,
      sha1(html) AS digest, strlen(html) AS size FROM canon WHERE uri <> ''),
v AS (SELECT uri, (page_id * 7919 + (k + 1) * 104729 * (page_id % 7 + 1)) % 1000003 AS sec, 'revisit-' || page_id || '-' || k AS record_id, page_id, k,
      (page_id + k) % 6 AS kind, md5(html) AS tag, 'day ' || (page_id % 365) AS modified, sha1(html) AS digest
      FROM canon, (SELECT unnest([0, 1, 2]) AS k)),
best AS (SELECT v.record_id, max(struct_pack(sec := r.sec, rid := r.rid, tag := r.tag, modified := r.modified, digest := r.digest, size := r.size)) AS r
         FROM v JOIN r ON v.uri = r.uri AND r.sec < v.sec GROUP BY v.record_id),
s AS (SELECT v.*, best.r, CASE WHEN best.r IS NULL THEN 'orphan' WHEN kind = 3 OR (kind IN (0, 1) AND v.tag <> best.r.tag)
      OR (kind = 2 AND v.modified <> best.r.modified) OR (kind = 4 AND v.digest <> best.r.digest) THEN 'mismatch'
      WHEN kind = 5 THEN 'unchecked' ELSE 'resolved' END AS status FROM v LEFT JOIN best USING (record_id))
SELECT record_id, uri AS canonical_uri, CAST(sec + 1700000000 AS BIGINT) AS date_s, status, r.rid AS refers_to,
       CASE WHEN status = 'resolved' THEN 'cache-control: max-age=' || k || chr(10) || 'content-length: ' || r.size || chr(10) || 'content-type: text/html'
       || chr(10) || 'etag: ' || CASE WHEN kind = 1 THEN 'W/' ELSE '' END || '"' || r.tag || '"' || chr(10) || 'last-modified: ' || r.modified
       || chr(10) || 'server: edge-' || k END AS merged_headers
FROM s"""


@query("op10_revisits", _WARC_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Every not-modified revisit of a crawl of the pages with the response it stands for and the merged headers."""
    out = warc.resolve_revisits(warc.captures(table(spark, folder, "pages").select("page_id", "url", "html")))
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return out.select("record_id", "canonical_uri", F.unix_seconds("warc_date").alias("date_s"), "status", "refers_to", lines.alias("merged_headers"))
