"""Token counts against the library."""

import public_tokenizers
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CASES = ["Hello <|endoftext|>World foo<|endoftext|>bar <|ENDOFTEXT|>", "don't I'LL 's '' ''' it's' a'sb 12ab3", "İstanbul ΣΑΣ ﬀ ½ \x1c\x1dfoo\x85bar　x", "",
         "   ", None, "<| x <|y '<|startoftext|>' é ́x", "a b \U0001f600\U0001f600 naïve-café", "\x00\x01a\x7f b\x00", "x" * 5000, "!!!!! ???'s $$$ '''s &amp;<|",
         "ﷺ ǅ ẞ K Å", "word " * 3000]


def of_library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(CASES)] * 2, "doc_id long, text string, n_tokens int")
    got = tokens.count_tokens(docs, PATH).collect()
    assert len(got) == 2 * len(CASES)
    for r in got:
        want = of_library(CASES[r.doc_id])
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (want, len((r.text or "").encode()), want > 2048), r.text
    assert tokens.count_tokens(docs.limit(0), PATH).count() == 0


WHOLE = tokens.whole_tokens(PATH)
COUNTS = tokens.Counts(tokens.load(PATH), WHOLE, limit=50)


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(max_size=60) | st.text(alphabet="abcXYZ019'.,<|>stmrelvd \n\x1c\x85é", max_size=60))
def test_any_text_equals_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert COUNTS.of(text.encode()) == of_library(text)


def test_whole_tokens_are_proven():
    assert len(WHOLE) > 20_000 and all(of_library(w.decode()) == 1 for w in list(WHOLE)[::97])
