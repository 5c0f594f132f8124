"""Edit similarity and overlap against direct definitions."""

import random

import pytest
from pyspark.sql import functions as F

from nearkin.functions.similarity import (
    fuzzy_features, indel_ratio, jaccard, lcs_length, length_features, overlap_features,
)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b, 1):
            row[j], previous = (previous + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def ratio(a, b):
    return 1.0 if not a and not b else 2 * lcs(a, b) / (len(a) + len(b))


def token_set(a, b):
    sa, sb = set(a.split()), set(b.split())
    if not sa or not sb:
        return 0.0
    both = " ".join(sorted(sa & sb))
    da, db = " ".join(sorted(sa - sb)), " ".join(sorted(sb - sa))
    if both and (not da or not db):
        return 1.0
    full_a, full_b = (both + " " + da).strip(), (both + " " + db).strip()
    distance = len(da) + len(db) - 2 * lcs(da, db)
    scores = [1 - distance / (len(full_a) + len(full_b))]
    if both:
        scores += [ratio(both, full_a), ratio(both, full_b)]
    return max(scores)


def test_lcs_equals_dynamic_program():
    rng = random.Random(1)
    for _ in range(2000):
        a = "".join(rng.choice("abcé ") for _ in range(rng.randrange(40)))
        b = "".join(rng.choice("abcé ") for _ in range(rng.randrange(40)))
        assert lcs_length(a, b) == lcs(a, b)


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(2)
    words = ["how", "to", "cook", "rice", "not", "python", "3", "é", "😀x"]
    rows = [("", ""), (" ", "a"), ("a", " "), ("same text", "same text"), ("i like it", "i do not like it"),
            ("abc def", "xyz uvw")]
    rows += [(" ".join(rng.choices(words, k=rng.randrange(9))), " ".join(rng.choices(words, k=rng.randrange(9)))) for _ in range(150)]
    return rows


def test_fuzzy_features_equal_definitions(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    for r in fuzzy_features(df, "a", "b").collect():
        a, b = r["a"], r["b"]
        assert r["fuzz_ratio"] == pytest.approx(ratio(a, b))
        assert r["fuzz_token_sort_ratio"] == pytest.approx(ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))
        assert r["fuzz_token_set_ratio"] == pytest.approx(token_set(a, b)), (a, b)
    first = df.select(indel_ratio(F.col("a"), F.col("b")).alias("r"), "a", "b").collect()
    assert all(x["r"] == pytest.approx(ratio(x["a"], x["b"])) for x in first)


def test_published_expectations(spark):
    df = spark.createDataFrame(
        [("same words here", "same words here"), ("i like to cook", "i do not like to cook"),
         ("quantum field theory", "banana bread jumps")], "a string, b string")
    same, negated, unrelated = fuzzy_features(df, "a", "b").collect()
    assert same["fuzz_ratio"] == same["fuzz_token_set_ratio"] == 1.0
    assert negated["fuzz_token_set_ratio"] == 1.0
    assert unrelated["fuzz_ratio"] < 0.4
    assert [r[0] for r in df.select(jaccard(F.col("a"), F.col("b"))).collect()] == [1.0, 4 / 6, 0.0]


def test_length_and_overlap_without_gaps(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    rows = df.withColumns({**length_features(a, b), **overlap_features(a, b)}).collect()
    for r in rows:
        x, y = set(r["a"].lower().split()), set(r["b"].lower().split())
        assert r["common_word_count"] == len(x & y)
        assert r["common_word_ratio"] == pytest.approx(len(x & y) / len(x | y) if x | y else 0.0)
        assert r["len_q1_words"] == len(r["a"].split()) and r["len_diff_chars"] == abs(len(r["a"]) - len(r["b"]))


def test_subsequences_whose_carries_pass_the_highest_bit():
    """Every step may carry out of the bits of a text; none of it counts, whatever follows."""
    rng = random.Random(3)
    for a, b in [("ab" * 40, "b" * 70 + "a" * 70), ("x" + "a" * 64 + "y", "z" + "a" * 200 + "w"), ("a" * 31 + "b", "c" + "ba" * 50 + "d")]:
        assert lcs_length(a, b) == lcs_length(b, a) == lcs(a, b)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcé") for _ in range(rng.randrange(140))) for _ in range(2))
        assert lcs_length(a, b) == lcs(a, b)
