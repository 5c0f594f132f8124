"""Cleaning and tokenizing against plain Python."""

import html
import re
import unicodedata
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nearkin.functions import text as tx

ALPHABET = list("abzAZ09_ .,'’`<>&;/:\t\n  \x1cé½²ñÜß😀中")
PIECES = st.sampled_from([
    "http://a.b/c?d=1", "www.x.org", "HTTPS://Q", "&amp;", "&lt;b&gt;", "&nbsp;", "&#8217;", "&copy", "<p>", "</p>",
    "don't", "WON'T", "it’s", "they`re", "dog's", "hello", "World", "Python 3.12", "not",
])
TEXTS = st.lists(st.one_of(PIECES, st.text(ALPHABET, max_size=8)), max_size=8).map(" ".join)


def py_html(t):
    return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", html.unescape(t))).strip()


def py_urls(t):
    return re.sub(r"https?://\S+|www\.\S+", "<URL>", t, flags=re.I)


def py_transformer(t):
    return re.sub(r"\s+", " ", py_urls(py_html(t))).strip()


def run(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["o"] for r in df.select("i", column(F.col("t")).alias("o")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXTS, min_size=40, max_size=80))
def test_cleaning_equals_python(spark, texts):
    assert run(spark, texts, tx.remove_html) == [py_html(t) for t in texts]
    assert run(spark, texts, tx.remove_urls) == [py_urls(t) for t in texts]
    assert run(spark, texts, tx.clean_transformer) == [py_transformer(t) for t in texts]
    assert run(spark, texts, tx.words) == [t.split() for t in texts]
    assert run(spark, texts, tx.strip) == [t.strip() for t in texts]
    assert run(spark, texts, tx.bm25_tokens) == [re.findall(r"\w+", t.lower()) for t in texts]
    plain = [t for t in texts if not re.search("['’`]", py_urls(py_html(t)))]
    expected = [re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", py_urls(py_html(t)).lower())).strip() for t in plain]
    assert run(spark, plain, tx.clean_classical) == expected


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXTS, min_size=40, max_size=80))
def test_terms_and_counts_equal_python(spark, texts):
    def terms(t):
        bare = "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c))
        words = re.findall(r"\b\w\w+\b", bare)
        return words + [f"{a} {b}" for a, b in zip(words, words[1:])]

    texts = [t.replace("½", "") for t in texts]  # one-to-many decompositions are a known deviation
    assert run(spark, texts, tx.tfidf_terms) == [terms(t) for t in texts]
    counted = run(spark, texts, lambda c: tx.term_counts(tx.tfidf_terms(c)))
    assert [{r["term"]: r["tf"] for r in row} for row in counted] == [dict(Counter(terms(t))) for t in texts]


def test_contractions(spark):
    cases = {
        "I can't go": "I cannot go", "They WON'T": "They will not", "it's he’s": "it is he is", "dog's bone": "dog's bone",
        "we`re you've I'd": "we are you have I would", "doesn't": "does not", "plain text": "plain text", "rock 'n' roll": "rock 'n' roll",
    }
    assert run(spark, list(cases), tx.expand_contractions) == list(cases.values())


def test_classical_edge_cases(spark):
    cases = {
        "": "", " \t\n": "", "She did not buy Atlas 7.5": "she did not buy atlas 7 5",
        "What, when?": "what when", "Salt&amp;Oil cost &lt; 5": "salt oil cost 5",
        "see http://a.b and www.c.d": "see url and url", "😀 !!": "", "¡Mañana será, Íñigo!": "mañana será íñigo",
    }
    assert run(spark, list(cases), tx.clean_classical) == list(cases.values())
    assert run(spark, [None], tx.clean_classical) == [""]
    assert run(spark, [None], tx.bm25_tokens) == [[]]
    assert run(spark, ["word " * 1000], tx.clean_classical)[0].count("word") == 1000


def test_bm25_tokens_keep_codes(spark):
    tokens = run(spark, ["Fault 0xC0FFEE11 from shop.load_orders"], tx.bm25_tokens)[0]
    assert "0xc0ffee11" in tokens and "load_orders" in tokens


def test_strip_accents_over_all_code_points(spark):
    """Every code point between two letters, and a mark behind it, against the standard library."""
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    width = 64
    texts = [" ".join(f"a{chr(c)}́b" for c in codes[at:at + width]) for at in range(0, len(codes), width)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    wrong = []
    for t, got in df.select("text", tx.strip_accents(F.col("text"))).collect():
        wanted = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        if got != wanted:
            wrong += [w for w, x, y in zip(t.split(" "), got.split(" "), wanted.split(" ")) if x != y]
    assert not wrong, (len(wrong), [hex(ord(w[1])) for w in wrong[:20] if len(w) > 1])


def test_tfidf_terms_take_characters_apart(spark):
    df = spark.createDataFrame([("ﬁne ½ cup, ①st 한글 \U0001d42bun",), (None,), ("",)], "text string")
    rows = [r[0] for r in df.select(tx.tfidf_terms(F.col("text"))).collect()]
    assert rows[0][0] == "fine"
    assert "1st" in rows[0] and unicodedata.normalize("NFKD", "한글") in rows[0] and "run" in rows[0] and rows[1] == rows[2] == []
