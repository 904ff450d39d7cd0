"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is 1.7 times its size wants 1.7 copies of each of its documents: one for certain and another with
probability 0.7. Independent draws would miss the target by chance; here the probabilities of two documents are settled
together: a random amount of words moves from one to the other until one of them is 0 or 1, which leaves the expected
copies of both and the words of the two together as they were. The other goes on to the next document. So each source
ends within one document's words of its target. So that this document is a small one, documents of more than 1 % of
their source's words are settled first (at most 100 a source), then those of more than 0.1 %, then all others; what one
group missed is part of the next one's target.

The pairs form a reduction tree: blocks of about ``BLOCK`` documents of a source are folded side by side by
``aggregate`` over an array, what remains of each block (at most one document) goes into a block of the next level, until
one document of each source is left, which is rounded by its own probability. The levels grow with the logarithm of the
number of documents; each is written to the shared folder. Randomness is a hash of document, level and seed, so reruns agree.

Defined cases: rows that agree in ``doc_id``, source and text are one unit with one decision and count their number of
times; documents without words take ``floor`` of their copies and no words. Null is a source of its own and comes last.
Without any words all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import free_name, if_small, words_of
from millrace.session import stored

BLOCK = 128
MOST_COPIES = 3
TIERS = (0.01, 0.001)


def default_weights(sources: DataFrame) -> DataFrame:
    """``sources(source)`` with ``weight`` 1, 2, 3, 1, ... by code point, null last. One row per source passes one task."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    return sources.withColumn("weight", ((place - 1) % 3 + 1).cast("double"))


def targets(sizes: DataFrame, weights: DataFrame, most: float = MOST_COPIES) -> DataFrame:
    """``sizes(source, source_size)`` with ``target``: all words shared by weight, none above ``most`` times its size.

    What a capped source can't take is shared again among the others. All rounds at once: with sources in the order of
    size per weight, ``level`` is the words per weight if exactly the sources before are capped; it rises up to the first
    source that is not capped and falls from there, so the largest level is the final one. One row per source passes one task.
    """
    df = sizes.join(weights.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    cap = F.col("source_size") * F.lit(float(most))
    order = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), "source")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    return df.withColumn("level", level).withColumn("level", F.max("level").over(whole)).select(
        "source", "source_size", F.least(cap, F.col("level") * F.col("weight")).alias("target"))


def unit_draw(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def _fold(items: Column) -> Column:
    """``items(key, mass, p, u)`` settled one after the other: ``done(key, up)`` and the one that is left, ``open``."""
    done_type, first = "array<struct<key:bigint,up:boolean>>", F.get(items, F.lit(0))
    start = F.struct(first.alias("open"), F.array().cast(done_type).alias("done"))

    def step(state: Column, new: Column) -> Column:
        old = state["open"]
        to_old = F.least(old["mass"] * (1 - old["p"]), new["mass"] * new["p"])      # words that can move either way
        to_new = F.least(old["mass"] * old["p"], new["mass"] * (1 - new["p"]))
        rises = F.coalesce(new["u"] * (to_old + to_new) < to_new, F.lit(False))      # so that expectations stay
        fills = old["mass"] * (1 - old["p"]) <= new["mass"] * new["p"]
        empties = old["mass"] * old["p"] <= new["mass"] * (1 - new["p"])
        old_done = F.when(rises, fills).otherwise(empties)

        def settle(x: Column, up: Column) -> Column:
            return F.array(F.struct(x["key"].alias("key"), up.alias("up")))

        def stays(x: Column, p: Column) -> Column:
            p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))
            return F.struct(x["key"].alias("key"), x["mass"].alias("mass"), p.alias("p"), x["u"].alias("u"))

        # the old one is settled (up when it rises) and the new one keeps the rest, or the other way round
        moved = F.when(rises, to_old).otherwise(-to_new)
        return F.struct(
            F.when(old_done, stays(new, new["p"] - moved / new["mass"])).otherwise(stays(old, old["p"] + moved / old["mass"])).alias("open"),
            F.concat(state["done"], F.when(old_done, settle(old, rises)).otherwise(settle(new, ~rises))).alias("done"))

    rest = F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0)))
    return F.aggregate(rest, start, step)


def rounded(units: DataFrame, seed: int = 0) -> DataFrame:
    """``units(source, key, mass, p)`` with 0 < p < 1 and mass > 0 as ``(key, up)``; one row per key."""
    settled = []
    level, rows = 0, units
    while True:
        rows = stored(rows, f"mix-level{level}")
        counts = rows.groupBy("source").agg(F.count("*").alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            last = rows.select("key", (unit_draw(F.col("key"), F.lit(seed), F.lit(-1)) < F.col("p")).alias("up"))
            settled.append(last)
            break
        draw = unit_draw(F.col("key"), F.lit(seed), F.lit(level))
        blocks = F.ceil(F.col("n") / F.lit(float(BLOCK)))
        item = F.struct("key", "mass", "p", draw.alias("u"))
        blocked = (rows.join(if_small(counts.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of")))
                   .groupBy("source", F.pmod(F.xxhash64("key", F.lit(seed + 7919 * (level + 1))), blocks).alias("block"))
                   .agg(F.sort_array(F.collect_list(item)).alias("items")))
        folded = stored(blocked.select("source", _fold(F.col("items")).alias("f")), f"mix-fold{level}")
        settled.append(folded.select(F.explode("f.done").alias("d")).select("d.key", "d.up"))
        rows = folded.select("source", "f.open.key", "f.open.mass", "f.open.p")
        level += 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def plan_mix(docs: DataFrame, weights: DataFrame | None = None, seed: int = 0, doc_id: str = "doc_id", text: str = "text",
             source: str = "source") -> DataFrame:
    """One row per different ``(doc_id, source, text)``: ``key, doc_id, source, n, size, source_size, target, copies``.

    ``size`` is the number of words of one document, ``n`` how many equal rows there are, ``copies`` how often each of them is taken.
    ``weights(source, weight)`` default to ``default_weights``. Sources are a catalogue: their table must fit one task.
    """
    size = F.size(words_of(F.col(text))).cast("long")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"),
                       unit_key(doc_id, source, text).alias("key"))
    units = stored(rows.groupBy("key", "doc_id", "source", "size").agg(F.count("*").alias("n")), "mix-units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = stored(targets(sizes, weights if weights is not None else default_weights(sizes.select("source"))), "mix-targets")
    mass = F.col("size") * F.col("n")
    of = F.col("source").eqNullSafe(F.col("of"))
    share = if_small(goal.withColumnRenamed("source", "of"))
    tier = F.lit(len(TIERS))
    for i, part in reversed(list(enumerate(TIERS))):
        tier = F.when(mass > F.col("source_size") * part, F.lit(i)).otherwise(tier)
    units = stored(units.join(share, of).drop("of").withColumn("tier", tier), "mix-tiers")
    open_sizes = units.groupBy("source", "tier").agg(F.sum(mass).alias("words"))
    done = None
    for i in range(len(TIERS) + 1):
        rest = open_sizes.filter(F.col("tier") >= i).groupBy(F.col("source").alias("of")).agg(F.sum("words").alias("rest"))
        if done is None:
            rest = rest.withColumn("taken", F.lit(0))
        else:
            taken = done.groupBy(F.col("source").alias("by")).agg(F.sum(mass * F.col("copies")).alias("taken"))
            rest = rest.join(taken, F.col("of").eqNullSafe(F.col("by")), "left").drop("by")
        want = (F.col("target") - F.coalesce("taken", F.lit(0))) / F.col("rest")
        ratio = F.when(F.col("rest") > 0, F.least(F.greatest(want, F.lit(0.0)), F.lit(float(MOST_COPIES)))).otherwise(0.0)
        wanted = units.filter(F.col("tier") == i).join(if_small(rest), of).withColumn("ratio", ratio) \
            .withColumn("whole", F.floor("ratio")).withColumn("p", F.col("ratio") - F.col("whole"))
        wanted = stored(wanted.drop("of", "rest", "taken", "ratio"), f"mix-tier{i}")
        up = rounded(wanted.filter("p > 0 and size > 0").select("source", "key", mass.cast("double").alias("mass"), "p"), seed)
        copies = (F.col("whole") + F.coalesce(F.col("up"), F.lit(False)).cast("int")).cast("int")
        new = wanted.join(up, "key", "left").select("key", "doc_id", "source", "n", "size", "source_size", "target", copies.alias("copies"))
        new = stored(new, f"mix-done{i}")
        done = new if done is None else done.unionByName(new)
    return done


def unit_key(doc_id: str, source: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id).isNull(), doc_id, F.col(source).isNull(), source, F.col(text).isNull(), text)


def mix(docs: DataFrame, weights: DataFrame | None = None, seed: int = 0, doc_id: str = "doc_id", text: str = "text",
        source: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    key = free_name(docs, "mix_key")
    copies = plan_mix(docs, weights, seed, doc_id, text, source).filter("copies > 0").select(
        F.col("key").alias(key), F.sequence(F.lit(1), F.col("copies")).alias("mix_times"))
    keyed = docs.withColumn(key, unit_key(doc_id, source, text)).select(*[F.col(f"`{c}`") for c in docs.columns], F.col(key))
    taken = keyed.join(copies.withColumnRenamed("mix_times", times := free_name(docs, "mix_times")), key)
    return taken.withColumn(times, F.explode(times)).select(*[F.col(f"`{c}`") for c in docs.columns])
