"""Exploratory aggregates over labelled pairs."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearkin.functions.similarity import jaccard
from nearkin.functions.text import WORD, bigrams, let, word_count
from nearkin.operators.ranking import top_k

MAX_LENGTH_BIN = 50


def class_balance(pairs: DataFrame, by: str, label: str = "is_duplicate") -> DataFrame:
    """Rows, positives and positive rate per split."""
    return pairs.groupBy(by).agg(
        F.count("*").alias("n"), F.sum(label).cast("long").alias("n_positive"),
        F.round(F.avg(label), 4).alias("positive_rate"))


def label_shares(pairs: DataFrame, label: str = "is_duplicate") -> DataFrame:
    """Share of each label value, rounded to 3 digits."""
    counts = pairs.groupBy(label).agg(F.count("*").alias("n"))
    # one row per label value
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 3))


def _side_lengths(pairs: DataFrame, q1: str, q2: str, label: str) -> DataFrame:
    return pairs.select(label, F.explode(F.array(
        F.struct(F.lit("q1").alias("side"), word_count(F.col(q1)).alias("n_words")),
        F.struct(F.lit("q2").alias("side"), word_count(F.col(q2)).alias("n_words")),
    )).alias("s"))


def length_histogram(pairs: DataFrame, q1: str, q2: str, label: str = "is_duplicate") -> DataFrame:
    """Word counts per label and side; the last bin holds everything longer."""
    sides = _side_lengths(pairs, q1, q2, label)
    return sides.groupBy(label, "s.side", F.least(F.col("s.n_words"), F.lit(MAX_LENGTH_BIN)).alias("n_words")).agg(
        F.count("*").alias("n"))


def length_quantiles(pairs: DataFrame, q1: str, q2: str, label: str = "is_duplicate") -> DataFrame:
    """Quartiles of the word count per label and side, from the histogram of exact counts."""
    sides = _side_lengths(pairs, q1, q2, label)
    quartiles = F.percentile("n_words", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    counted = sides.groupBy(label, "s.side", "s.n_words").agg(F.count("*").alias("n"))
    return counted.groupBy(label, "side").agg(quartiles.alias("q")).select(
        label, "side", *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(("p25", "p50", "p75"))])


def jaccard_by_class(pairs: DataFrame, q1: str, q2: str, label: str = "is_duplicate") -> DataFrame:
    """Mean word overlap per label, rounded to 3 digits."""
    return pairs.groupBy(label).agg(
        F.count("*").alias("n"), F.round(F.avg(jaccard(F.col(q1), F.col(q2))), 3).alias("mean_jaccard"))


def top_bigrams(pairs: DataFrame, q1: str, q2: str, label: str = "is_duplicate", k: int = 15) -> DataFrame:
    """Most frequent word pairs per label; stop words leave before pairs are formed."""
    stop = StopWordsRemover.loadDefaultStopWords("english")
    texts = pairs.select(label, F.explode(F.array(q1, q2)).alias("text"))
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(f"({WORD}{{2,}})"), F.lit(1))
    grams = texts.select(label, F.explode(
        let(F.filter(tokens, lambda t: ~t.isin(stop)), bigrams)).alias("bigram"))
    counts = grams.groupBy(label, "bigram").agg(F.count("*").alias("n"))
    return top_k(counts, [label], "n", k, ["bigram"])
