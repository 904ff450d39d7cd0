"""URL filter by the ratio of two character models.

Rules decide first: a rule fits its host and all subdomains if the url's path starts with the rule's path, the longest rule
wins. The urls that rules decide are also what the models learn from: one variable-order Markov model of the characters of
accepted urls, one of rejected ones. A character's probability after its context of ``ORDER`` characters is smoothed by the
next shorter context, weighted by how many different characters were seen there (Witten-Bell), down to even odds over
``ALPHABET`` characters. A url's score is its log-likelihood difference per character; it is allowed from a threshold on that
is calibrated on labelled urls left out of the fitting (those whose hash is in one of ``FOLDS`` folds): the cut with the
largest balanced accuracy over score steps of ``1 / STEPS``, in the middle between the nearest scores on both sides.

Everything is aggregations and joins. Urls become their ``ORDER + 1``-character grams with counts; both models are counts of
(context, character) over all labelled urls of the fold's complement; each distinct gram of the corpus gets one score, and a url sums the
scores of its grams. A gram that a third of all urls have is combined before each shuffle of counts; the join of urls with
gram scores is broadcast while there are at most ``BROADCAST_GRAMS`` grams, and beyond that shuffled with skewed partitions split.

Defined cases: a null url or one without ``://`` has an empty host and path and, without characters, score 0; its verdict
follows the threshold. Without labelled urls on both sides, scores are 0 and everything undecided is allowed. Repeated rows are judged
each; columns of the input pass through, result names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name, let, without
from millrace.session import stored

ORDER = 4
ALPHABET = 256
FOLDS = 5
STEPS = 1000
BROADCAST_GRAMS = 500_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substring(u, at + 3, F.length(u)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(rest_of(url), F.lit("")), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(rest_of(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``(name, verdict)`` of the longest rule that fits, else null. Equal lengths: the first rule."""
    out = None
    for r in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<name:string,verdict:string>")


def grams_of(text: Column) -> Column:
    """Per character of a text: the ``ORDER`` characters before it (spaces before the start) and the character."""
    padded = F.concat(F.lit(" " * ORDER), text)
    return let(F.struct(padded.alias("t"), F.length(text).alias("n")), lambda s: F.when(s["n"] > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(s["n"], F.lit(1))), lambda i: F.substr(s["t"], i, F.lit(ORDER + 1)))).otherwise(F.array().cast("array<string>")))


def gram_scores(urls: DataFrame) -> DataFrame:
    """``(gram, score)``: log-likelihood difference of each gram, from ``urls(id, gram, n, label)``; label 1 accepted, 0 rejected, null neither."""
    seen = stored(urls.groupBy("gram").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("yes"),
                                           F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("no")), "grams")
    scores = seen.select("gram", F.lit(1.0 / ALPHABET).alias("p_yes"), F.lit(1.0 / ALPHABET).alias("p_no"))
    char = F.substring("gram", ORDER + 1, 1)
    for order in range(ORDER + 1):
        context = F.substring("gram", ORDER + 1 - order, order)
        pairs = seen.groupBy(context.alias("context"), char.alias("char")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        totals = pairs.groupBy("context").agg(F.sum("yes").alias("yes_all"), F.sum("no").alias("no_all"),
                                              F.sum((F.col("yes") > 0).cast("long")).alias("yes_kinds"), F.sum((F.col("no") > 0).cast("long")).alias("no_kinds"))
        model = pairs.join(totals, "context")
        scores = scores.withColumn("context", context).withColumn("char", char).join(model, ["context", "char"])

        def smoothed(side: str) -> Column:
            n, everything, kinds = F.col(side), F.col(f"{side}_all"), F.col(f"{side}_kinds")
            return F.when(everything > 0, (n + kinds * F.col(f"p_{side}")) / (everything + kinds)).otherwise(F.col(f"p_{side}"))

        scores = scores.select("gram", smoothed("yes").alias("p_yes"), smoothed("no").alias("p_no"))
    return scores.select("gram", (F.log("p_yes") - F.log("p_no")).alias("score"))


def scored(texts: DataFrame) -> DataFrame:
    """``(id, score)`` per different ``texts(id, text, label)``; text not empty."""
    grams = stored(texts.select("id", "label", F.explode(grams_of(F.col("text"))).alias("gram"))
                   .groupBy("id", "label", "gram").agg(F.count("*").alias("n")), "url-grams")
    table = stored(gram_scores(grams), "gram-scores")
    if table.limit(BROADCAST_GRAMS + 1).count() <= BROADCAST_GRAMS:
        table = F.broadcast(table)
    sums = grams.join(table, "gram").groupBy("id").agg(F.sum(F.col("score") * F.col("n")).alias("s"), F.sum("n").alias("n"))
    # rounded: sums of floating-point numbers depend on the order of their parts
    return sums.select("id", F.round(F.col("s") / F.col("n"), 9).alias("score"))


def threshold(labelled: DataFrame) -> float:
    """The cut of ``labelled(score, accepted)`` with the largest balanced accuracy; 0 without both kinds."""
    step = F.floor(F.col("score") * STEPS)
    bins = labelled.groupBy(step.alias("step")).agg(F.sum(F.col("accepted").cast("long")).alias("yes"), F.sum((~F.col("accepted")).cast("long")).alias("no"))
    # scores lie within log(ALPHABET) times a small factor of 0, so the steps are bounded whatever the table
    rows = sorted((r["step"], r["yes"], r["no"]) for r in bins.collect())
    yes, no = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not yes or not no:
        return 0.0
    best, cut, below_yes, below_no = -1.0, 0.0, 0, 0
    for before, (at, y, n) in zip([rows[0][0] - 1, *[r[0] for r in rows]], rows, strict=False):
        accuracy = (yes - below_yes) / yes + below_no / no
        if accuracy > best + 1e-12:
            best, cut = accuracy, (before + 1 + at) / 2 / STEPS
        below_yes, below_no = below_yes + y, below_no + n
    return cut


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``score`` (null where a rule decides)."""
    names = ("host", "path", "rule", "verdict", "score")
    base = without(pages, [n for n in names if n != url])
    found, key = free_name(base, "url_rule"), free_name(base, "url_key")
    host, path = host_of(F.col(url)), path_of(F.col(url))
    keyed = base.withColumn("host", host).withColumn("path", path).withColumn(found, ruled(F.col("host"), F.col("path"), rules)) \
        .withColumn(key, F.xxhash64("host", "path"))
    label = F.when(F.col(f"{found}.verdict") == "allow", 1).when(F.col(f"{found}.verdict") == "block", 0)
    texts = keyed.filter("host <> '' or path <> ''").groupBy(F.col(key).alias("id")).agg(
        F.first(F.concat("host", "path")).alias("text"), F.first(label).alias("label"))
    held = F.pmod(F.col("id"), F.lit(FOLDS)) == 0
    texts = stored(texts.withColumn("accepted", F.col("label") == 1).withColumn("label", F.when(~held, F.col("label"))), "urls")
    scores = stored(scored(texts.select("id", "text", "label")), "url-scores")
    tests = scores.join(texts.filter(held & F.col("accepted").isNotNull()).select("id", "accepted"), "id")
    cut = threshold(tests)
    out = keyed.join(scores.select(F.col("id").alias(key), "score"), key, "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    verdict = F.coalesce(F.col(f"{found}.verdict"), F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return out.withColumn("verdict", verdict).withColumn("rule", F.col(f"{found}.name")) \
        .withColumn("score", F.when(F.col("rule").isNull(), F.col("score"))).drop(found, key)
