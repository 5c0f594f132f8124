"""Data quality, leakage and index integrity checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearkin.operators.corpus import blank_rows
from nearkin.operators.ranking import seeded_sample

# Bounds of the quality gate.
MAX_DUPLICATE_PAIRS = 100
POSITIVE_RATE = (0.25, 0.50)
MAX_SHARED_PAIRS = 300
MAX_SHARED_QUESTIONS = 0.45


def digest(text: Column) -> Column:
    """16 bytes that stand for a text, so that texts stay where they are; null stays null."""
    return F.unhex(F.md5(text.cast("binary")))


def duplicate_pairs(splits: DataFrame) -> DataFrame:
    """``split, n_duplicates``: rows that repeat an earlier pair of their split."""
    named = splits.select("split", digest(F.col("question1")).alias("a"), digest(F.col("question2")).alias("b"))
    counts = named.groupBy("split", "a", "b").agg(F.count("*").alias("n"))
    return counts.groupBy("split").agg(F.sum(F.col("n") - 1).alias("n_duplicates"))


def ordered_pairs(pairs: DataFrame) -> DataFrame:
    """Both orders of every lower-cased pair, as digests."""
    named = pairs.select(digest(F.lower("question1")).alias("a"), digest(F.lower("question2")).alias("b"))
    return named.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select("p.*")


def shared_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ordered pairs found in both tables, as digests: a shared pair of different texts counts twice."""
    return ordered_pairs(left).intersect(ordered_pairs(right))


def questions_of(pairs: DataFrame) -> DataFrame:
    """Digests of the distinct texts of both sides."""
    named = pairs.select(digest(F.col("question1")).alias("a"), digest(F.col("question2")).alias("b"))
    return named.select(F.explode(F.array("a", "b")).alias("question")).distinct()


def question_overlap(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: distinct test texts, those also in train, and their share (0 without test texts).

    Only digests are shuffled; at sizes where it pays Spark filters the larger side by a Bloom
    filter of the smaller one before that.
    """
    seen = questions_of(train).withColumn("in_train", F.lit(1))
    return questions_of(test).join(seen, "question", "left").agg(
        F.count("*").alias("n_test"), F.count("in_train").alias("n_shared"),
        F.coalesce(F.try_divide(F.count("in_train").cast("double"), F.count("*")), F.lit(0.0)).alias("overlap"))


def quality_report(splits: DataFrame) -> DataFrame:
    """``check, split, value, bound, passed`` over a table with a ``split`` column."""
    def line(df: DataFrame, check: str, split: Column, value: Column, bound: str, passed: Column) -> DataFrame:
        return df.select(F.lit(check).alias("check"), split.alias("split"), value.cast("double").alias("value"),
                         F.lit(bound).alias("bound"), passed.alias("passed"))

    blanks = blank_rows(splits, ["question1", "question2"])
    missing = F.col("n_null") + F.col("n_blank")
    rates = splits.groupBy("split").agg(F.avg("is_duplicate").alias("rate"))
    train, test = splits.filter(F.col("split") == "train"), splits.filter(F.col("split") == "test")
    leaked = shared_pairs(train, test).agg(F.count("*").alias("n"))
    overlap = question_overlap(train, test)
    low, high = POSITIVE_RATE
    checks = [
        line(blanks, "blank_texts", F.col("column_name"), missing, "= 0", missing == 0),
        line(duplicate_pairs(splits), "duplicate_pairs", F.col("split"), F.col("n_duplicates"),
             f"<= {MAX_DUPLICATE_PAIRS}", F.col("n_duplicates") <= MAX_DUPLICATE_PAIRS),
        line(rates, "positive_rate", F.col("split"), F.round("rate", 6), f"{low} .. {high}",
             F.col("rate").between(low, high)),
        line(leaked, "pair_leakage", F.lit("train/test"), F.col("n"), f"<= {MAX_SHARED_PAIRS}",
             F.col("n") <= MAX_SHARED_PAIRS),
        line(overlap, "question_overlap", F.lit("train/test"), F.round("overlap", 6), f"< {MAX_SHARED_QUESTIONS}",
             F.col("overlap") < MAX_SHARED_QUESTIONS),
    ]
    return reduce(DataFrame.unionByName, checks)


def inspection_sample(pairs: DataFrame, key: str, n: int = 10, seed: int = 42) -> DataFrame:
    """A few labelled pairs to look at, the same ones on every run."""
    return seeded_sample(pairs, n, key, seed)


def index_reconcile(questions: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row of counts: both tables, and ids that the other table lacks."""
    both = questions.select(F.col("question_id").alias("id"), F.lit(1).alias("q"), F.lit(0).alias("v")).unionByName(
        vectors.select("id", F.lit(0).alias("q"), F.lit(1).alias("v")))
    per_id = both.groupBy("id").agg(F.sum("q").alias("q"), F.sum("v").alias("v"))
    return per_id.agg(
        F.coalesce(F.sum("q"), F.lit(0)).alias("n_questions"), F.coalesce(F.sum("v"), F.lit(0)).alias("n_vectors"),
        F.count(F.when((F.col("q") > 0) & (F.col("v") == 0), 1)).alias("without_vector"),
        F.count(F.when((F.col("q") == 0) & (F.col("v") > 0), 1)).alias("without_question"),
        F.count(F.when((F.col("q") > 1) | (F.col("v") > 1), 1)).alias("repeated_ids"),
    )


def unmatched_ids(questions: DataFrame, vectors: DataFrame) -> DataFrame:
    """``id, missing_in``: the ids behind the counts of ``index_reconcile``."""
    q, v = questions.select(F.col("question_id").alias("id")), vectors.select("id")
    return q.join(v, "id", "left_anti").withColumn("missing_in", F.lit("vectors")).unionByName(
        v.join(q, "id", "left_anti").withColumn("missing_in", F.lit("questions")))
