"""From labelled pairs to a deduplicated, cleaned corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from nearkin.functions.similarity import jaccard
from nearkin.functions.text import (
    CLEANERS, NON_WS, classical_of, clean_transformer, is_blank, plain_text, strip, transformer_of, word_count,
)
from nearkin.operators.ranking import with_row_index


def normalize_pairs(raw: DataFrame) -> DataFrame:
    """Bring the flat and the nested pair layout to one table, rows untouched otherwise.

    The layout is read once from the schema. Output: ``row_index, qid1, qid2, question1,
    question2, is_duplicate``. In the flat layout the ids come from ``idx`` (``2·idx`` and
    ``2·idx + 1``); without ``idx`` it defaults to twice the row number.
    """
    label = "is_duplicate" if "is_duplicate" in raw.columns else "label"
    if "questions" in raw.columns:
        indexed = raw if "row_index" in raw.columns else with_row_index(raw)
        return indexed.select(
            F.col("row_index").cast("long").alias("row_index"),
            F.get("questions.id", F.lit(0)).cast("long").alias("qid1"),
            F.get("questions.id", F.lit(1)).cast("long").alias("qid2"),
            F.get("questions.text", F.lit(0)).alias("question1"),
            F.get("questions.text", F.lit(1)).alias("question2"),
            F.coalesce(F.col(label).cast("int"), F.lit(0)).alias("is_duplicate"),
        )
    if "idx" in raw.columns:
        indexed = raw.withColumn("row_index", F.col("idx").cast("long"))
        number = F.col("row_index")
    else:
        indexed = raw if "row_index" in raw.columns else with_row_index(raw)
        number = F.col("row_index") * 2
    label_col = F.coalesce(F.col(label).cast("int"), F.lit(0)) if label in raw.columns else F.lit(0)
    return indexed.select(
        F.col("row_index").cast("long").alias("row_index"),
        (number * 2).cast("long").alias("qid1"),
        (number * 2 + 1).cast("long").alias("qid2"),
        "question1", "question2",
        label_col.alias("is_duplicate"),
    )


def build_pairs(normalized: DataFrame) -> DataFrame:
    """Stripped texts; rows with an empty side are dropped."""
    return normalized.filter(F.col("question1").rlike(NON_WS) & F.col("question2").rlike(NON_WS)).select(
        "qid1", "qid2", strip(F.col("question1")).alias("question1"), strip(F.col("question2")).alias("question2"),
        "is_duplicate")


def build_corpus(normalized: DataFrame, one_text_per_id: bool = False) -> DataFrame:
    """Distinct stripped texts, each with the id of its first occurrence.

    First means lowest row, then first side. ``min_by`` over two long columns stays in the
    hash aggregate, so copies of a hot text are folded before the shuffle.
    ``one_text_per_id`` also lets an id contribute its first text only.
    """
    sides = normalized.select(F.explode(F.array(
        F.struct(F.col("qid1").alias("question_id"), strip(F.col("question1")).alias("question_text"),
                 (F.col("row_index") * 2).alias("position")),
        F.struct(F.col("qid2").alias("question_id"), strip(F.col("question2")).alias("question_text"),
                 (F.col("row_index") * 2 + 1).alias("position")),
    )).alias("side")).select("side.*").filter(F.length("question_text") > 0)
    if one_text_per_id:
        sides = sides.groupBy("question_id").agg(
            F.min_by("question_text", "position").alias("question_text"),
            F.min("position").alias("position"),
        )
    return (
        sides.groupBy("question_text")
        .agg(F.min_by("question_id", "position").alias("question_id"))
        .select("question_id", "question_text")
    )


def canonicalize_ids(pairs: DataFrame, corpus: DataFrame) -> DataFrame:
    """Opt-in: give both sides of a pair the corpus id of their text."""
    ids1 = corpus.select(F.col("question_text").alias("question1"), F.col("question_id").alias("_id1"))
    ids2 = corpus.select(F.col("question_text").alias("question2"), F.col("question_id").alias("_id2"))
    return (
        pairs.join(ids1, "question1", "left").join(ids2, "question2", "left")
        .withColumns({"qid1": F.coalesce("_id1", "qid1"), "qid2": F.coalesce("_id2", "qid2")})
        .select(*pairs.columns)
    )


def apply_cleaning(pairs: DataFrame, mode: str = "transformer", dropped: Observation | None = None) -> DataFrame:
    """Add ``q1_{mode}`` and ``q2_{mode}`` and drop rows with an empty result.

    An ``Observation`` receives ``rows_in`` and ``rows_dropped`` from the same pass.
    """
    clean = CLEANERS[mode]
    q1, q2 = f"q1_{mode}", f"q2_{mode}"
    # a generator keeps the optimizer from cleaning a second time inside the filter below
    cleaned = pairs.select("*", F.inline(F.array(F.struct(
        clean(F.col("question1")).alias(q1), clean(F.col("question2")).alias(q2)))))
    filled = (F.col(q1) != "") & (F.col(q2) != "")
    if dropped is not None:
        cleaned = cleaned.observe(
            dropped, F.count("*").alias("rows_in"), F.sum(F.when(filled, 0).otherwise(1)).alias("rows_dropped"))
    return cleaned.filter(filled)


def clean_pairs(pairs: DataFrame) -> DataFrame:
    """Both cleaning modes; a row empty in either mode is dropped. Markup and URLs are removed once for both."""
    # generators keep the optimizer from cleaning again wherever a result is used
    plain = pairs.select("*", F.inline(F.array(F.struct(
        plain_text(F.col("question1")).alias("_plain1"), plain_text(F.col("question2")).alias("_plain2")))))
    a, b = F.col("_plain1"), F.col("_plain2")
    cleaned = plain.select(*pairs.columns, F.inline(F.array(F.struct(
        classical_of(a).alias("q1_classical"), classical_of(b).alias("q2_classical"),
        transformer_of(a).alias("q1_transformer"), transformer_of(b).alias("q2_transformer")))))
    return cleaned.filter((F.col("q1_classical") != "") & (F.col("q2_classical") != "") & (F.col("q1_transformer") != "") & (F.col("q2_transformer") != ""))


def clean_corpus(corpus: DataFrame) -> DataFrame:
    """Add ``question_clean``; rows stay even when it is empty."""
    return corpus.withColumn("question_clean", clean_transformer(F.col("question_text")))


def positive_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("is_duplicate") == 1)


def training_examples(pairs: DataFrame, q1: str = "q1_transformer", q2: str = "q2_transformer") -> DataFrame:
    """``(text1, text2, label)`` with a floating label, as pair encoders expect."""
    return pairs.select(F.col(q1).alias("text1"), F.col(q2).alias("text2"),
                        F.col("is_duplicate").cast("double").alias("label"))


def hard_negatives(pairs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Non-duplicates whose word overlap exceeds ``threshold``."""
    return (
        pairs.withColumn("jaccard", jaccard(F.col("question1"), F.col("question2")))
        .filter((F.col("jaccard") > threshold) & (F.col("is_duplicate") == 0))
    )


def length_slice(q1: Column, q2: Column) -> Column:
    """``short``, ``medium`` or ``long`` by the mean word count of both sides."""
    mean = (word_count(q1) + word_count(q2)) / 2.0
    return F.when(mean < 8, "short").when(mean <= 15, "medium").otherwise("long")


def truth_from_pairs(pairs: DataFrame) -> DataFrame:
    """Symmetric ``(query_id, relevant_id)`` rows of the positive pairs, duplicates kept."""
    return positive_pairs(pairs).select(F.explode(F.array(
        F.struct(F.col("qid1").alias("query_id"), F.col("qid2").alias("relevant_id")),
        F.struct(F.col("qid2").alias("query_id"), F.col("qid1").alias("relevant_id")),
    )).alias("t")).select("t.*")


def blank_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null and blank counts of several columns in one pass: ``column_name, n_null, n_blank``."""
    counted = df.agg(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.when(F.col(c).isNull(), 1)).alias("n_null"),
            F.count(F.when(F.col(c).isNotNull() & is_blank(F.col(c)), 1)).alias("n_blank"),
        ).alias(c) for c in columns
    ])
    return counted.select(F.inline(F.array(*[F.col(c) for c in columns])))
