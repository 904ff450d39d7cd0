"""Benchmark passages in documents, also where numbers, names and units were exchanged.

Texts become templates: numbers, units and names inside sentences turn into typed placeholders, all other words are
lower-cased and lose surrounding punctuation. Windows of ``WINDOW`` template words are joined by hash with those of the
benchmark. A match says only that the templates agree; so the matches of a document with an item are put on alignments
(document place - item place), and a template match counts only if its slots are consistent in its alignment: one value of the
item is replaced by one value in the document, the most frequent one. Verbatim matches always count. A document leaks an item if consistent alignments cover at least ``COVERAGE`` of
the item's template words.

Each window is also joined by its words as they are (lower-cased, bare), so that verbatim cover counts whatever the words are. As
templates, windows with fewer than half literal words are not used. An item shorter than a window is one window of its own length.
Document windows are looked up in the benchmark's set of hashes inside the tasks while this set has at most
``BROADCAST_WINDOWS`` entries; a larger benchmark is joined by a shuffle of all windows, with the same result.

Windows that many items share, such as an instruction, make no pairs. Of each item the windows of most items are set aside as
long as they cover less than ``COVERAGE`` of it together (``rare_windows``). A leak has to contain one of the others, so only these
are joined; the documents and items that meet there are then compared by all their windows. Items of equal text are compared once.

Defined cases: an empty table on either side gives no rows; very long texts are read in blocks; other columns are not looked at, whatever their names; null and empty texts on either side have no windows and no rows. Repeated documents give one row per
``doc_id`` and item, that of the largest coverage; a null ``doc_id`` counts as one id. Equal items are reported each.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from millrace.llm.common import if_small, let, mixed, span_hashes, window_hashes, word_hashes
from millrace.session import stored

WINDOW = 8
COVERAGE = 0.5
BROADCAST_WINDOWS = 1 << 22
VERBATIM = 1 << 8  # sets the hashes of words as they are apart from those of templates

# fixed values: units and number words that become placeholders, in the languages of the documents; words with another common
# meaning (French "un", Spanish "once") are left out
UNITS = set("""kg g mg lb lbs oz km m cm mm mi ft in l ml s ms min h hr hrs mph kmh w kw v a hz mb gb tb c f k usd eur gbp % $ € £
kilogram kilograms gram grams pound pounds ounce ounces kilometer kilometers kilometre kilometres meter meters metre metres
centimeter centimeters mile miles foot feet inch inches yard yards liter liters litre litres gallon gallons second seconds
minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents degree degrees
percent watt watts volt volts
kilo kilos kilogramme kilogrammes gramme grammes livre livres kilomètre kilomètres mètre mètres centimètre centimètres litre litres
seconde secondes heure heures jour jours semaine semaines mois année années degré degrés pourcent
kilogramm gramm pfund kilometer meter zentimeter meile meilen liter sekunde sekunden minuten stunde stunden tag tage tagen woche wochen
monat monate monaten jahr jahre jahren grad prozent
kilogramo kilogramos gramo gramos libra libras kilómetro kilómetros metro metros centímetro centímetros milla millas litro litros
segundo segundos minuto minutos hora horas día días semana semanas mes meses año años euros dólar dólares grado grados""".split()) - {"a", "in", "s", "c", "f", "k", "m", "v", "w", "h", "l", "g"}
NUMBERS = set("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen
eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion
deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante mille
millions milliard milliards
zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn zwanzig dreißig
vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend millionen milliarden
dos tres cuatro cinco seis siete ocho nueve diez doce trece catorce quince dieciséis diecisiete dieciocho diecinueve veinte treinta
cuarenta cincuenta sesenta setenta ochenta noventa cien mil millón millones""".split())

LITERAL, NUMBER, UNIT, NAME = range(4)
_NUMBER = re.compile(r"[$€£]?[+-]?(?:\d[\d.,:/]*)(?:%|st|nd|rd|th)?")
_MEASURE = re.compile(r"[+-]?\d[\d.,]*([a-z]+)")


# a word is one number: the hash of its bare lower-case form with the kind and three marks in the lowest bits
KIND, CAPITAL, ENDS, WORD, MARKS = np.uint64(3), np.uint64(4), np.uint64(8), np.uint64(16), np.uint64(31)
PLACEHOLDERS = mixed(np.arange(4, dtype=np.uint64)) & ~MARKS


def _bytes(chars: str | bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars.encode() if isinstance(chars, str) else chars)] = True
    return out


_UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _bytes("abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 128)
_DIGIT = _bytes("0123456789")
_CORE = _UPPER | _LOWER | _DIGIT | _bytes("_$%")
_QUOTE, _END = _bytes("\"')]"), _bytes(".!?:;")


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with the capitals of ASCII and Latin-1 in lower case."""
    up = _UPPER[data]
    up[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return data + (up * np.uint8(32))


def _hash_of(word: str) -> int:
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])


class Words:
    """The numbers of words; those with a digit or a sign are looked at one by one, all others as whole blocks of bytes."""

    def __init__(self):
        self.units = np.sort(np.array([_hash_of(w) & ~31 for w in UNITS], dtype=np.uint64))
        self.number_words = np.sort(np.array([_hash_of(w) & ~31 for w in NUMBERS], dtype=np.uint64))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.empty(0, dtype=np.uint64)
        low, core = lowered(data), np.flatnonzero(_CORE[data])
        at, to = np.searchsorted(core, starts), np.searchsorted(core, ends)
        good = to > at                                    # words of punctuation only have no core
        core = np.r_[core, 0]
        first, last = np.where(good, core[at], starts), np.where(good, core[to - 1] + 1, ends)
        values = span_hashes(low, first, last) & ~MARKS
        kind = np.zeros(len(starts), dtype=np.uint64)
        kind[np.isin(values, self.units)] = UNIT
        kind[np.isin(values, self.number_words)] = NUMBER
        signs = np.r_[0, np.cumsum(_DIGIT[data])]
        for i in np.flatnonzero(signs[ends] > signs[starts]).tolist():
            word = low[first[i]:last[i]].tobytes().decode("utf-8", "replace")
            if _NUMBER.fullmatch(word) or ((m := _MEASURE.fullmatch(word)) and m[1] in UNITS):
                kind[i] = NUMBER
        second = np.minimum(first + 1, len(data) - 1)
        capital = _UPPER[data[first]] & (last > first + 1) & _LOWER[data[second]] & (kind == LITERAL)
        final = np.where(_QUOTE[data[ends - 1]] & (ends > starts + 1), ends - 2, ends - 1)
        return values | kind | capital * CAPITAL | _END[data[final]] * ENDS | good * WORD


def template(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(template hashes, slot values, is slot)`` of a text's words, without words of punctuation only."""
    named = (numbers[1:] & CAPITAL > 0) & (numbers[:-1] & ENDS == 0)
    kind = numbers & KIND
    kind[1:][named] = NAME
    kept = numbers & WORD > 0
    values, kind = (numbers & ~MARKS)[kept], kind[kept]
    slot = kind > 0
    return np.where(slot, PLACEHOLDERS[kind.astype(np.int64)], values), values, slot


HIT = StructType([StructField("window", LongType()), StructField("place", IntegerType()), StructField("slots", ArrayType(LongType()))])


def _rows(words: Words, texts: pa.Array, sizes, known: np.ndarray | None, whole_short: bool):
    """Row number, window, place, slot values and number of template words of every window that may match."""
    bitmap = None
    if known is not None:
        bits = min(24, max(16, int(len(known)).bit_length() + 5))
        bitmap, shift = np.zeros(1 << bits, dtype=bool), np.uint64(64 - bits)
        bitmap[(known >> shift).astype(np.int64)] = True
    for row, numbers in word_hashes(texts, words):
        shape, values, slot = template(numbers)
        n = len(shape)
        before = np.r_[0, np.cumsum(slot)]
        for size, verbatim in itertools.product((min(WINDOW, n),) if whole_short else sizes, (False, True)):
            if not size or n < size:
                continue
            hashes = window_hashes(values if verbatim else shape, size) ^ np.uint64(size + VERBATIM * verbatim)
            if bitmap is None:
                places = np.arange(len(hashes))
            else:
                places = np.flatnonzero(bitmap[(hashes >> shift).view(np.int64)])
                if len(places):
                    at = np.minimum(np.searchsorted(known, hashes[places]), len(known) - 1)
                    places = places[known[at] == hashes[places]]
            if len(places) and not verbatim:  # templates with enough literal words
                places = places[2 * (before[places + size] - before[places]) <= size]
            for p in places.tolist():
                slots = [] if verbatim else values[p:p + size][slot[p:p + size]].view(np.int64).tolist()
                yield row, int(hashes[p].view(np.int64)), p, slots, n, size


def _mapped(df: DataFrame, id_type, sizes, known, whole_short: bool) -> DataFrame:
    """``df(id, text)`` as ``(id, window, place, slots, n, size)``."""
    schema = StructType([StructField("id", id_type), *HIT.fields, StructField("n", IntegerType()), StructField("size", IntegerType()),
                         StructField("text_hash", LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        hashes = known.value if known is not None else None
        for batch in batches:
            part: list[tuple] = []

            def out() -> pa.RecordBatch:
                cols = list(zip(*part, strict=True)) or [[]] * 6
                rows = pa.array(cols[0], pa.int32())
                got = pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.list_(pa.int64())),
                     pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.int32()), batch.column(2).take(rows)], names=schema.names)
                part.clear()
                return got

            for hit in _rows(words, batch.column(1), sizes, hashes, whole_short):
                part.append(hit)
                if len(part) == 20_000:
                    yield out()
            yield out()

    text = F.coalesce(F.col("text"), F.lit(""))
    return df.select("id", text.alias("text"), F.xxhash64("text").alias("text_hash")).mapInArrow(work, schema)


def _covered(places: Column, size: Column) -> Column:
    """Words under windows that start at sorted different ``places``."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(places, zero, lambda a, s: F.struct((a["n"] + s + size - F.greatest(a["end"], s)).alias("n"), (s + size).alias("end")),
                       lambda a: a["n"])


def _chosen(pairs: Column) -> Column:
    """The different ``pairs(i, d)``, of each ``i`` only the most frequent one, then the one with equal sides, then the least ``d``."""
    def ranked(all_pairs: Column, different: Column) -> Column:
        counted = F.transform(different, lambda p: F.struct(
            p["i"].alias("i"), F.struct((-F.size(F.filter(all_pairs, lambda q: q == p))).alias("n"), (p["i"] != p["d"]).alias("other"), p["d"].alias("d")).alias("rank")))
        first = let(F.sort_array(counted), lambda c: F.filter(c, lambda x, k: (k == 0) | (F.get(c, k - 1)["i"] != x["i"])))
        return F.transform(first, lambda x: F.struct(x["i"].alias("i"), x["rank"]["d"].alias("d")))

    return let(pairs, lambda a: let(F.array_distinct(a), lambda d: F.when(
        F.size(d) == F.size(F.array_distinct(F.transform(d, lambda p: p["i"]))), d).otherwise(ranked(a, d))))


def rare_windows(coverage: float):
    """Of an item's ``[(number of items, place, window)]`` the windows that a leak has to share one of."""
    @arrow_udf(ArrayType(LongType()))
    def chosen(windows: pa.Array, n: pa.Array, size: pa.Array) -> pa.Array:
        out = []
        for found, words, width in zip(windows.to_pylist(), n.to_pylist(), size.to_pylist(), strict=True):
            aside, covered, needed = np.zeros(words, dtype=bool), 0, set()
            for x in sorted(found, key=lambda x: (-x["items"], x["place"], x["window"])):
                part = aside[x["place"]:x["place"] + width]
                more = covered + int(np.count_nonzero(~part))
                if more / words < coverage:
                    part[:], covered = True, more
                else:
                    needed.add(x["window"])
            out.append(sorted(needed))
        return pa.array(out, pa.list_(pa.int64()))
    return chosen


def matches(docs: DataFrame, items: DataFrame, doc_id: str, text: str, coverage: float) -> DataFrame:
    """The equal windows of every document and item that can reach ``coverage``: ``items`` of distinct texts as ``(item, window, ...)``."""
    spark = docs.sparkSession
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most WINDOW different ones
    keys = items.groupBy("window").agg(F.count_distinct("item").alias("items"))
    small = keys.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    known = None
    if small:
        known = spark.sparkContext.broadcast(np.sort(np.array(keys.select("window").toPandas()["window"], dtype=np.int64).view(np.uint64)))
    hits = _mapped(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), docs.schema[doc_id].dataType, sizes, known, False)
    if not small:
        hits = hits.join(keys, "window", "left_semi")
    hits = stored(hits.select(F.col("id").alias("doc_id"), "text_hash", "window", "place", "slots"), "hits")
    windows = items.join(keys, "window").groupBy("item", "n", "size").agg(
        F.collect_set(F.struct("items", F.col("item_place").alias("place"), "window")).alias("windows"))
    needed = stored(windows.select("item", F.explode(rare_windows(coverage)("windows", "n", "size")).alias("window")), "rare-windows")
    candidates = hits.select("doc_id", "text_hash", "window").distinct().join(if_small(needed), "window").select("doc_id", "text_hash", "item").distinct()
    # the candidates' items bring their windows along: their number does not depend on what else the document contains
    wanted = stored(candidates, "candidates").join(items, "item")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")) & (F.col("window") == F.col("w"))
    return wanted.join(hits.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), F.col("window").alias("w"), "place", "slots"), same).drop("d", "t", "w")


def _covers(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, coverage: float) -> DataFrame:
    """``(doc_id, text_hash, item_id, n_words, n_covered, changed)`` per text and item it contains."""
    names = benchmark.select(F.col(item_id).alias("item_id"), F.xxhash64(F.col(item_text)).alias("item")).filter(F.col(item_text).isNotNull())
    texts = benchmark.select(F.xxhash64(F.col(item_text)).alias("id"), F.col(item_text).alias("text")).dropDuplicates(["id"])
    items = stored(_mapped(texts, LongType(), None, None, True).withColumnsRenamed({"id": "item", "place": "item_place", "slots": "item_slots"})
                   .drop("text_hash"), "items")
    joined = matches(docs, items, doc_id, text, coverage)
    pairs = F.zip_with("item_slots", "slots", lambda i, d: F.struct(i.alias("i"), d.alias("d")))
    aligned = (joined.groupBy("doc_id", "text_hash", "item", "n", "size", (F.col("place") - F.col("item_place")).alias("shift"))
               .agg(F.collect_set(F.struct("item_place", pairs.alias("pairs"))).alias("windows")))
    chosen = aligned.withColumn("chosen", _chosen(F.flatten(F.transform("windows", lambda w: w["pairs"]))))
    kept = chosen.withColumn("windows", F.filter("windows", lambda w: F.forall(w["pairs"], lambda p: F.array_contains("chosen", p)))) \
        .filter(F.size("windows") > 0)
    consistent = kept.withColumns({"places": F.array_distinct(F.transform("windows", lambda w: w["item_place"])),
                                   "pairs": F.flatten(F.transform("windows", lambda w: w["pairs"]))})
    found = consistent.groupBy("doc_id", "text_hash", "item", "n", "size").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
        F.max(F.exists("pairs", lambda p: p["i"] != p["d"])).alias("changed"))
    share = found.withColumn("n_covered", _covered(F.col("places"), F.col("size")).cast("long"))
    return share.filter(F.col("n_covered") / F.col("n") >= coverage).join(names, "item").select("doc_id", "text_hash", "item_id", F.col("n").cast("long").alias("n_words"), "n_covered", "changed")


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """``(doc_id, item_id, n_covered, n_words, coverage, changed)`` per document and item it contains.

    ``changed`` says that some slot of the covered words has another value in the document than in the item.
    """
    best = _covers(docs, benchmark, doc_id, text, item_id, item_text, coverage).groupBy("doc_id", "item_id", "n_words").agg(
        F.max(F.struct("n_covered", "changed")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_covered", "n_words", (F.col("best.n_covered") / F.col("n_words")).alias("coverage"), "best.changed")


def decontaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text leaks an item; other texts under the same or no ``doc_id`` stay."""
    leaking = _covers(docs, benchmark, doc_id, text, "item_id", "text", COVERAGE).select(
        F.col("doc_id").alias("__leaking"), F.col("text_hash").alias("__leaking_text")).distinct()
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__leaking")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("__leaking_text"))
    return docs.join(leaking, same, "left_anti")
