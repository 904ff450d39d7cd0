"""Leaks of benchmark items, also re-parameterised ones."""

import itertools
import random
from collections import Counter, defaultdict

import pyarrow as pa

from millrace.llm import decontaminate as d

ITEM = "A train leaves Boston at 9 and travels 120 miles in 3 hours before it meets another train coming from Albany at the bridge."
OTHER = "Mary has five red apples and gives two of them to her brother before lunch and then counts what is left in the basket."
FILLER = "It was a quiet evening and nobody expected the letter that came with the last post of that long and rainy week. "


def run(spark, texts, items=((1, ITEM), (2, OTHER)), **kw):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in d.leaks(docs, bench, **kw).collect()}


def test_verbatim_changed_and_clean_texts(spark):
    changed = ITEM.replace("120", "75").replace("3", "2").replace("Albany", "Denver")
    clash = ITEM.replace("120", "75") + " " + FILLER
    torn = ITEM[:45] + FILLER
    got = run(spark, [(1, FILLER + ITEM + " " + FILLER), (2, FILLER + changed + FILLER), (3, FILLER), (4, ITEM.upper() + OTHER), (5, clash), (6, torn)])
    assert set(got) == {(1, 1), (2, 1), (4, 1), (4, 2), (5, 1)}
    assert not got[1, 1].changed and got[2, 1].changed and got[1, 1].coverage > 0.9


def test_inconsistent_slots_are_no_leak(spark):
    item = "there are 5 boxes with 5 balls each and 5 children who take 5 balls from 5 of these boxes every day until none is left"
    same = item.replace("5", "8")
    mixed = "there are 6 boxes with 7 balls each and 8 children who take 9 balls from 4 of these boxes every day until none is left"
    got = run(spark, [(1, same), (2, mixed)], [(1, item)])
    assert set(got) == {(1, 1)}


def test_nulls_empty_short_repeated_and_no_rows(spark):
    short = "tiny secret question here"
    rows = [(1, None), (2, ""), (3, "so the tiny secret question here is known"), (None, ITEM), (4, ITEM), (4, ITEM), (5, ITEM + " " + ITEM)]
    got = run(spark, rows, [(1, ITEM), (7, None), (8, ""), (9, short), (10, ITEM)])
    assert set(got) == {(3, 9), *((i, k) for i in (None, 4, 5) for k in (1, 10))}
    assert run(spark, rows, []) == {} and run(spark, [], [(1, ITEM)]) == {}
    docs = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert sorted(r.doc_id for r in d.decontaminated(docs, bench).collect()) == [1, 2, 3]


def test_a_benchmark_beyond_the_bound_gives_the_same(spark, monkeypatch):
    texts = [(1, FILLER + ITEM), (2, FILLER), (3, OTHER)]
    small = run(spark, texts)
    monkeypatch.setattr(d, "BROADCAST_WINDOWS", 3)
    assert run(spark, texts) == small


def test_verbatim_items_of_slots_are_leaks(spark):
    sums = "12 plus 30 is 42 and 7 times 8 is 56 and 9 minus 4 is 5"
    names = "Anna Bell Carl Dorn Emil Fox Greta Hill Ida Jones"
    mid = "Boston lies by the sea"
    texts = [(i, FILLER + "they wrote " + t + " " + FILLER) for i, t in enumerate([sums, names, mid])]
    assert set(run(spark, texts, list(enumerate([sums, names, mid])))) == {(0, 0), (1, 1), (2, 2)}


def test_one_edited_value_keeps_the_rest(spark):
    item = ("the clerk gave John a form and 120 euros before he left for the old station where a man was waiting with the parcel "
            "that the driver had taken from John on the way to the harbour with all of its lights out")
    got = run(spark, [(1, FILLER + item.replace("from John", "from Peter")), (2, item)], [(1, item)])
    assert set(got) == {(1, 1), (2, 1)} and got[1, 1].coverage >= 0.9 and got[2, 1].coverage == 1


def test_only_leaking_rows_go(spark):
    rows = [(None, ITEM), (None, FILLER), (None, None), (1, FILLER), (1, FILLER + ITEM), (2, ITEM)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    got = [tuple(r) for r in d.decontaminated(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([(None, FILLER), (None, None), (1, FILLER)], key=str)


def plain_leak(doc, item):
    """``(covered words, changed)`` of an item in a document by definition: every window against every window."""
    (shape, values, slot), (s2, v2, _) = (d.template(next(d.word_hashes(pa.array([t]), d.Words()))[1]) for t in (item, doc))
    n = len(shape)
    size = min(d.WINDOW, n)
    aligned = defaultdict(set)
    for p, q in itertools.product(range(n - size + 1), range(len(s2) - size + 1)):
        if (values[p:p + size] == v2[q:q + size]).all():
            aligned[q - p].add((p, ()))
        if (shape[p:p + size] == s2[q:q + size]).all() and 2 * slot[p:p + size].sum() <= size:
            aligned[q - p].add((p, tuple((int(values[p + k].view("int64")), int(v2[q + k].view("int64"))) for k in range(size) if slot[p + k])))
    covered, changed = set(), False
    for windows in aligned.values():
        counts = Counter(pair for _, pairs in windows for pair in pairs)
        best = {i: min((-n, i != x, x) for (j, x), n in counts.items() if j == i)[2] for i, _ in counts}
        for p, pairs in windows:
            if all(best[i] == x for i, x in pairs):
                covered |= set(range(p, p + size))
                changed |= any(i != x for i, x in pairs)
    return len(covered), changed, n


def test_equals_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    words = "the red box of and in a blue house stands".split()

    def text(n):
        return " ".join(rng.choice(words) if rng.random() < 0.8 else str(rng.randint(1, 4)) for _ in range(n))
    shared = text(9)
    items = [(i, (shared + " " if rng.random() < 0.5 else "") + text(rng.choice([3, 8, 15, 24]))) for i in range(25)]
    items += [(100, items[0][1]), (101, None)]
    docs = []
    for i in range(60):
        _, item = items[i % 25]
        w = item.split()
        if rng.random() < 0.8:
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice([*words, "7", "9"])
        docs.append((i, f"{text(12)} {' '.join(w[rng.randint(0, 4):])} {shared if i % 3 else ''} {text(5)}"))
    want = {}
    for (i, doc), (k, item) in itertools.product(docs, items):
        if item:
            covered, changed, n = plain_leak(doc, item)
            if covered / n >= d.COVERAGE:
                want[i, k] = covered, changed
    got = {key: (r.n_covered, r.changed) for key, r in run(spark, docs, items).items()}
    assert got == want and len(want) > 60 and any(c for _, c in want.values())
    monkeypatch.setattr(d, "BROADCAST_WINDOWS", 3)
    assert {key: (r.n_covered, r.changed) for key, r in run(spark, docs, items).items()} == want


def test_a_shared_instruction_makes_no_pairs(spark):
    from pyspark.sql import functions as F
    shared = "Read the following question with care and write down the letter of the one right answer below it please."
    own = [" ".join(f"w{i}x{j}y" for j in range(25)) for i in range(600)]
    docs = spark.createDataFrame([(i, f"{own[300 + i]} {shared} {own[300 + i][::-1]}") for i in range(300)] + [(900, f"{shared} {own[7]}")], "doc_id long, text string")
    bench = spark.createDataFrame([(i, f"{shared} {own[i]}") for i in range(300)], "item_id long, text string")
    texts = bench.select(F.xxhash64("text").alias("id"), "text")
    items = d._mapped(texts, d.LongType(), None, None, True).withColumnsRenamed({"id": "item", "place": "item_place", "slots": "item_slots"}).drop("text_hash")
    assert d.matches(docs, items, "doc_id", "text", d.COVERAGE).count() < 1_000
    assert [(r.doc_id, r.item_id) for r in d.leaks(docs, bench).collect()] == [(900, 7)]


def test_placeholders_of_other_languages(spark):
    items = ["Le train part de la gare et roule pendant trois heures avant de rencontrer un autre train qui vient du nord.",
             "Der Bauer verkauft am Markt zwölf Eier und bringt danach sieben Kilometer weiter seine letzten Körbe zu der alten Mühle.",
             "El tren sale de la estación y viaja durante cinco horas antes de llegar al puente que cruza el gran río."]
    texts = [items[0].replace("trois", "huit"), items[1].replace("zwölf", "zwanzig").replace("sieben", "drei"), items[2].replace("cinco", "nueve")]
    got = run(spark, list(enumerate(texts)), list(enumerate(items)))
    assert set(got) == {(i, i) for i in range(3)} and all(r.changed and r.coverage == 1 for r in got.values())
