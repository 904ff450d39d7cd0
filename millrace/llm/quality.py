"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document; what is kept are the measurements and one bit per failed rule. Policies
are versioned masks over these bits, so a new policy or an ablation reads the ledger and never the texts again.
All of it is column expressions: no shuffle and no Python for the ledger, one small aggregation for ablations.

Null and empty texts have no words: all counts are 0 and the rule ``too_few_words`` fails. Repeated rows are judged
one by one; columns of the input that have the name of a measurement are replaced by it, all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, let, without, words_of

WINDOW = 5

# rule -> condition over the measurements; the position in this list is the bit
RULES: list[tuple[str, str]] = [
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("shouting", "2 * n_upper > n_letters and n_letters > 0"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("few_letters", "2 * n_letters < word_chars"),
    ("digits", "4 * n_digits > word_chars"),
    ("exclamations", "3 * n_exclaims > n_words"),
    ("no_sentence", "n_stops = 0 and n_words >= 50"),
    ("mojibake", "100 * n_broken > word_chars"),
]
# rules of later policies; their bits follow
LATER_RULES: list[tuple[str, str]] = [
    ("long_spaced_words", "word_chars > 20 * n_words and 2 * n_unspaced <= n_letters"),
    ("no_terminal", "n_terminals = 0 and n_words >= 50 and n_words >= 20 * n_lines and 2 * n_unspaced <= n_letters"),
]
ALL_RULES = RULES + LATER_RULES
BITS = {name: 1 << i for i, (name, _) in enumerate(ALL_RULES)}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
            "n_digits", "n_exclaims", "n_stops", "n_broken"]
LATER_MEASURES = ["n_unspaced", "n_terminals"]
# sentence terminals of Unicode, and the ellipsis
TERMINALS = ".!?…" + "".join(chr(int(x, 16)) for x in """37e 589 61d 61e 61f 6d4 700 701 702 7f9 837 839 83d 83e 964 965 f0d f0e 104a 104b 1362
1367 1368 166e 1735 1736 17d4 17d5 1803 1809 1944 1945 1aa8 1aa9 1aaa 1aab 1b5a 1b5b 1b5e 1b5f 1c3b 1c3c 1c7e 1c7f 203c 203d 2047 2048 2049
2e2e 2e3c 3002 a4ff a60e a60f a6f3 a6f7 a876 a877 a8ce a8cf a92f a9c8 a9c9 aa5d aa5e aa5f aaf0 aaf1 abeb fe52 fe56 fe57 ff01 ff0e ff1f
ff61""".split())
# scripts written without spaces between words
UNSPACED = "".join(rf"\p{{Is{script}}}" for script in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan", "Yi"))


def mask(*names: str) -> int:
    return sum(BITS[name] for name in names)


# version -> rules that reject; versions are never changed, only added
POLICIES = {
    "base": mask("too_few_words", "repeated_windows"),
    "v1": mask(*[name for name, _ in RULES]),
    # as v1 for all scripts: any sentence terminal, none needed in lists and verse, no length of words where words have no spaces
    "v2": mask(*[name for name, _ in ALL_RULES if name not in ("long_words", "no_sentence")]),
}


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of five that the text has twice or more.

    Windows are compared by 64-bit hash. Only texts with a repeated window are sorted: equal hashes become
    neighbours, their places are sorted back, and overlapping windows are counted once.
    """
    hashes = let(words, lambda w: F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - (WINDOW - 1))),
                    lambda i: F.xxhash64(F.slice(w, i, WINDOW)))))

    def covered(h: Column) -> Column:
        places = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = let(places, lambda p: F.sort_array(F.transform(
            F.filter(F.transform(p, lambda x, i: F.struct(
                x["i"].alias("i"),
                (F.coalesce(F.get(p, i - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
                lambda x: x["twice"]), lambda x: x["i"])))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(starts, zero, lambda a, s: F.struct(
            (a["n"] + s + WINDOW - F.greatest(a["end"], s)).alias("n"), (s + WINDOW).alias("end")), lambda a: a["n"])

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements of ``MEASURES`` (all long), one read of each text."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    word_counts = let(words_of(F.col(text)), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("again")))
    letters = F.regexp_replace(body, r"\P{L}+", "")
    upper_letters = F.regexp_replace(body, r"\P{Lu}+", "")
    kept = without(docs, [m for m in MEASURES if m != text])
    out = kept.withColumns({
        "__words": word_counts, "__lines": line_counts,
        "word_chars": F.length(F.regexp_replace(body, SPACE, "")).cast("long"),
        "n_symbols": removed(body, "#*$%&|<>").cast("long"),
        "n_letters": F.length(letters).cast("long"), "n_upper": F.length(upper_letters).cast("long"),
        "n_digits": removed(body, "0123456789").cast("long"),
        "n_exclaims": removed(body, "!").cast("long"),
        "n_stops": removed(body, ".!?。！？…").cast("long"),
        "n_broken": removed(body, "�").cast("long"),
    })
    return out.withColumns({
        "n_words": F.col("__words.n").cast("long"), "n_repeat_words": F.col("__words.again").cast("long"),
        "n_lines": F.col("__lines.n").cast("long"), "n_dup_lines": F.col("__lines.again").cast("long"),
    }).drop("__words", "__lines")


def ledger(docs: DataFrame, text: str = "text", policy: str = "v1") -> DataFrame:
    """``docs`` with the measurements and ``failed_bits``, bit ``BITS[rule]`` set for each failed rule.

    A ledger for ``policy`` ``v2`` has the bits and measurements of the later rules too and serves every policy; one for
    ``v1`` serves ``v1`` and ``base`` only.
    """
    later = bool(POLICIES[policy] & mask(*[name for name, _ in LATER_RULES]))
    out = measured(without(docs, ["failed_bits"]), text)
    if later:
        body = F.coalesce(F.col(text), F.lit(""))
        out = without(out, [m for m in LATER_MEASURES if m != text]).withColumns({
            "n_unspaced": F.length(F.regexp_replace(body, rf"[^{UNSPACED}]+|\P{{L}}+", "")).cast("long"),
            "n_terminals": removed(body, TERMINALS).cast("long")})
    bits = None
    for name, condition in ALL_RULES if later else RULES:
        bit = F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long")
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return out.withColumn("failed_bits", bits)


def passes(policy: str) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(POLICIES[policy])) == 0


def apply_policy(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """A ledger with ``base_failed`` and ``kept``; a document that fails the base is rejected by every policy."""
    failed = F.col("failed_bits").bitwiseAND(F.lit(POLICIES["base"])) != 0
    return without(entries, ["base_failed", "kept"]).withColumns({"base_failed": failed, "kept": ~failed & passes(policy)})


def ablation(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that the policy keeps without it.

    One pass: documents are counted per distinct combination of bits (at most 2^rules rows), the rest is bit
    arithmetic on those combinations.
    """
    combos = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(POLICIES[policy])).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(BITS[name]).cast("long").alias("bit"))
                                for name, _ in ALL_RULES if POLICIES[policy] & BITS[name]]))
    n = F.col("n")
    return (combos.select("bits", "n", rules.alias("r")).groupBy(F.col("r.rule").alias("rule"), F.col("r.bit").alias("bit"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, n).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), n).otherwise(0)).alias("n_only"),
                 F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, n).otherwise(0)).alias("n_kept_without")))
