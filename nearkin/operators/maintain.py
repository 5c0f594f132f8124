"""Upkeep of the search tables: drift, incremental add, rebuild, growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.functions.encoders import Encoder
from nearkin.functions.text import clean_transformer
from nearkin.operators.ranking import latest_per_key
from nearkin.operators.vectors import VectorIndex, assign_cells, build_vector_index, mean_similarity, similarity_to
from nearkin.session import materialize
from nearkin.sources.versions import read_version, write_addition, write_version

# Drift alarm, growth that asks for a rebuild, tag of added rows.
DRIFT_THRESHOLD = 0.7
GROWTH_LIMIT = 0.10
NEW_SOURCE = "new_batch"


def detect_drift(new_vectors: DataFrame, centroid: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """One-row drift report of new vectors against the corpus centroid."""
    return mean_similarity(new_vectors, centroid).select(
        F.round("mean_similarity", 4).alias("mean_similarity"),
        (F.col("mean_similarity") < threshold).alias("drift_detected"),
        F.lit(threshold).alias("threshold"),
        F.col("n").alias("n_new_questions"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )


def drift_by_window(new_vectors: DataFrame, centroid: DataFrame, ts: str = "ts", window: str = "30 days",
                    threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Drift per time window of arrival; works on a batch table and on a watermarked stream."""
    timed = new_vectors.withColumn("ts", F.col(ts).cast("timestamp"))
    return timed.groupBy(F.window("ts", window)).agg(
        F.avg(similarity_to(centroid)).alias("mean_similarity"), F.count("*").alias("n_new_questions"),
    ).select(
        F.col("window.start").alias("window_start"),
        F.round("mean_similarity", 4).alias("mean_similarity"),
        (F.col("mean_similarity") < threshold).alias("drift_detected"), "n_new_questions")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def remap_vector_ids(questions: DataFrame, mapping: DataFrame) -> DataFrame:
    """Forget all vector ids, then set those of ``mapping(question_id, vec_id)``."""
    return questions.drop("vec_id").join(mapping, "question_id", "left").select(*questions.columns)


def incremental_add(spark: SparkSession, root: str, new_questions: DataFrame, encoder: Encoder,
                    sequence: list[str] | None = None) -> int:
    """Add ``new_questions(question_id, question_text)`` to the newest version.

    Cells stay as they are and stored rows are not rewritten. An id that is already stored
    gets the new text and the new vector; within the batch the row with the highest
    ``sequence`` wins, by default the last text in alphabetical order. Returns the number of
    the addition.
    """
    index, questions, manifest = read_version(spark, root)
    newest = latest_per_key(new_questions, "question_id", sequence or ["question_text"])
    cleaned = newest.withColumn("question_clean", clean_transformer(F.col("question_text")))
    # vectors must be computed once: they go into two tables
    encoded = materialize(
        encoder(cleaned, "question_clean", "embedding").select(
            F.col("question_id").alias("id"), "question_text", "embedding"), "encoded")
    known = index.vectors.select("id").join(encoded.select("id"), "id", "left_semi").count()
    n = manifest.select("n").first()["n"] + encoded.count() - known
    rows = encoded.select(F.col("id").alias("question_id"), "question_text", F.col("id").alias("vec_id"),
                          F.lit(NEW_SOURCE).alias("source"))
    return write_addition(assign_cells(encoded.select("id", "embedding"), index.centroids),
                          rows.select(*questions.columns), root, n)


def full_rebuild(spark: SparkSession, questions: DataFrame, encoder: Encoder, root: str,
                 cells: int | None = None, seed: int = 42) -> int:
    """Clean, encode and cluster the whole metadata table into a new version."""
    cleaned = questions.select("question_id", "question_text", "source").withColumn(
        "question_clean", clean_transformer(F.col("question_text")))
    encoded = materialize(encoder(cleaned, "question_clean", "embedding").select(
        F.col("question_id").alias("id"), "embedding"), "encoded")
    index = build_vector_index(encoded, cells, seed)
    mapping = index.vectors.select(F.col("id").alias("question_id"), F.col("id").alias("vec_id"))
    return write_version(index, remap_vector_ids(questions, mapping), root)


def growth_report(spark: SparkSession, root: str, limit: float = GROWTH_LIMIT) -> DataFrame:
    """One row ``built_n, n, growth, rebuild``: has the corpus outgrown its clustering?"""
    _, _, manifest = read_version(spark, root)
    growth = F.coalesce(F.try_divide((F.col("n") - F.col("built_n")).cast("double"), F.col("built_n")), F.lit(0.0))
    return manifest.select("built_n", "n", F.round(growth, 6).alias("growth"), (growth > limit).alias("rebuild"))
