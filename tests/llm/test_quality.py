"""Rule ledger against plain counting."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SENTENCE = "The quick brown fox jumps over the lazy dog near the river bank today."


def plain(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


CASES = [None, "", "  \n\t ", "one", SENTENCE, SENTENCE + "\n" + SENTENCE, "a b c d e f a b c d e f g a b c d e", "x x x x x x x x", "line\nline\n\nline\n \nother",
         "#### $$ |||| <b> & %", "é" * 50 + " 東京 \U0001f600", "a b c d e\x0b\x0ca b c d\re", ("w%d " * 40) % tuple(range(40)) * 30]


def test_measures_equal_plain_counts(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    for row in quality.apply_policy(quality.ledger(docs)).collect():
        want = plain(CASES[row.doc_id])
        assert {k: row[k] for k in want} == want, CASES[row.doc_id]
        assert row.base_failed == (want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"])
        assert not (row.kept and row.base_failed)


def test_clean_text_is_kept_and_junk_is_not(spark):
    clean = "The committee met on Monday. It heard three reports about water, roads and schools, and voted on two of them."
    junk = ["Thnd*** iner*** ther*** that*** other### more### word$$$ here%%% and&&& so&&&", "BUY!! NOW!! THIS!! IS!! A!! GREAT!! OFFER!! FOR!! ALL!! OF!! YOU!!"]
    docs = spark.createDataFrame(list(enumerate([clean, *junk])), "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality.apply_policy(quality.ledger(docs)).collect()}
    assert kept == {0: True, 1: False, 2: False}


def test_clashing_columns_repeated_rows_and_empty_tables(spark):
    rows = [(1, SENTENCE, 7, "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, FAILED_BITS string")
    out = quality.apply_policy(quality.ledger(docs)).collect()
    assert len(out) == 2 and all(r.n_words == 14 and r.failed_bits == 0 for r in out)
    assert quality.ledger(docs.limit(0)).count() == 0


def test_ablation_counts_from_the_bits(spark):
    a, b = quality.BITS["symbols"], quality.BITS["shouting"]
    entries = spark.createDataFrame([(0,), (a,), (a,), (a | b,), (b,)], "failed_bits long")
    got = {r.rule: (r.n_failed, r.n_only, r.n_kept_without) for r in quality.ablation(entries).collect()}
    assert got["symbols"] == (3, 2, 3) and got["shouting"] == (2, 1, 2) and got["digits"] == (0, 0, 1)


def test_no_python_and_no_shuffle(spark, capsys):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = quality.apply_policy(quality.ledger(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("policy", list(quality.POLICIES))
def test_policies_are_masks_over_the_rules(policy):
    assert quality.POLICIES[policy] & ~sum(quality.BITS.values()) == 0
    assert F.lit(quality.POLICIES[policy]) is not None


def test_second_policy_keeps_clean_text_of_other_scripts(spark):
    hindi = ("समिति ने सोमवार को अपनी बैठक में पानी और सड़क के बारे में तीन रिपोर्ट सुनीं। गाँव के लोगों ने कहा कि पुराना कुआँ अब सूख गया है और "
             "नया कुआँ बनाना चाहिए। अध्यक्ष ने उत्तर दिया कि अगले महीने काम शुरू होगा। बच्चों के विद्यालय की छत भी टूटी हुई थी इसलिए "
             "दो शिक्षक शहर से सामान लाने गए। शाम तक सबने मिलकर चाय पी और अपने घर लौट आए।")
    chinese = "\n".join(f"委员会在星期一开会讨论了第{x}份关于供水和道路的报告并且通过了其中的两份建议。" for x in "一二三四五六七八九十百千")
    thai = "\n".join(f"คณะกรรมการประชุมเมื่อวันจันทร์และรับฟังรายงานเรื่องน้ำและถนน{x}" for x in "กขคงจฉชซญดตถ")
    verse = "\n".join(f"the {a} river runs below the {b} hill" for a, b in zip("abcdefghij", "klmnopqrst", strict=True))
    junk = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    docs = spark.createDataFrame(list(enumerate([hindi, chinese, thai, verse, SENTENCE, junk, "x" * 50 + " " + "y" * 300 + " a b c d e f g h."])), "doc_id long, text string")
    entries = quality.ledger(docs, policy="v2")
    kept = {p: {r.doc_id for r in quality.apply_policy(entries, p).collect() if r.kept} for p in ("v1", "v2")}
    assert kept == {"v1": {4}, "v2": {0, 1, 2, 3, 4}}
    first = {r.doc_id for r in quality.apply_policy(quality.ledger(docs)).collect() if r.kept}
    assert first == {4}
