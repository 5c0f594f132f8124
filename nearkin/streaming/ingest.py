"""Streaming ingest of new questions into the search tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nearkin.functions.encoders import Encoder
from nearkin.functions.text import clean_transformer
from nearkin.operators.ranking import dense_index
from nearkin.operators.requests import accepted, quarantined, validate_ingest
from nearkin.operators.vectors import VectorIndex, assign_cells
from nearkin.session import materialize
from nearkin.sources import segments
from nearkin.streaming.batches import run_stream, write_batch


@dataclass(frozen=True)
class IngestTarget:
    """Where ingested rows go and where their numbering starts.

    ``questions``, ``vectors``, ``rejects`` and ``ledger`` below ``root`` have one partition
    per micro-batch. ``first_id`` and ``first_vec_id`` follow the base tables. ``keywords`` is the
    folder of a segmented keyword index that grows with every micro-batch.
    """

    root: str
    centroids: DataFrame
    encoder: Encoder
    first_id: int = 1
    first_vec_id: int = 0
    keywords: str | None = None

    @classmethod
    def after(cls, questions: DataFrame, root: str, centroids: DataFrame, encoder: Encoder,
              keywords: str | None = None) -> "IngestTarget":
        last = questions.agg(F.max("question_id").alias("id"), F.count("vec_id").alias("n"),
                             F.max("vec_id").alias("vec")).first()
        next_vec = max(last["n"] or 0, -1 if last["vec"] is None else last["vec"] + 1)
        return cls(root, centroids, encoder, (last["id"] or 0) + 1, next_vec, keywords)


def _start(spark: SparkSession, target: IngestTarget, batch_id: int) -> tuple[int, int]:
    """Next question id and vector id, from the ledger of the earlier micro-batches."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{target.root}/ledger")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return target.first_id, target.first_vec_id
    last = (
        spark.read.parquet(f"{target.root}/ledger").filter(F.col("batch_id") < batch_id)
        .agg(F.max("next_id").alias("id"), F.max("next_vec_id").alias("vec")).first()
    )
    return (target.first_id if last["id"] is None else last["id"],
            target.first_vec_id if last["vec"] is None else last["vec"])


def ingest_batch(batch: DataFrame, batch_id: int, target: IngestTarget, order_by: list[str]) -> None:
    """Validate, number, encode and store one micro-batch.

    Ids follow ``order_by`` within the batch and the ledger across batches, so a replay gives
    the same rows the same ids and overwrites them. The ledger is written last.
    """
    spark = batch.sparkSession
    checked = validate_ingest(batch)
    write_batch(quarantined(checked), target.root, "rejects", batch_id)
    next_id, next_vec = _start(spark, target, batch_id)
    # vectors and metadata must describe the same rows: number and encode once
    numbered = dense_index(accepted(checked), order_by, "_n").select(
        (F.col("_n") + next_id).alias("question_id"), "question_text", (F.col("_n") + next_vec).alias("vec_id"))
    cleaned = numbered.withColumn("_clean", clean_transformer(F.col("question_text")))
    encoded = materialize(target.encoder(cleaned, "_clean", "embedding").drop("_clean"), "ingest")
    vectors = assign_cells(encoded.select(F.col("question_id").alias("id"), "embedding"), target.centroids)
    write_batch(vectors, target.root, "vectors", batch_id)
    write_batch(encoded.select("question_id", "question_text", "vec_id", F.lit("ingest").alias("source")),
                target.root, "questions", batch_id)
    if target.keywords:
        segments.append(encoded.select("question_id", "question_text"), batch_id, target.keywords)
        segments.merge_due(spark, target.keywords)
    ledger = encoded.agg(
        (F.count("*") + next_id).alias("next_id"), (F.count("*") + next_vec).alias("next_vec_id"))
    write_batch(ledger.coalesce(1), target.root, "ledger", batch_id)


def start_ingest(stream: DataFrame, target: IngestTarget, checkpoint: str, order_by: list[str], **options) -> StreamingQuery:
    """Run ``ingest_batch`` on every micro-batch of ``stream(question_text, …)``."""
    return run_stream(stream, lambda df, batch_id: ingest_batch(df, batch_id, target, order_by), checkpoint, **options)


def with_ingested(index: VectorIndex, questions: DataFrame, root: str) -> tuple[VectorIndex, DataFrame]:
    """Base tables together with everything ingested so far, ready for search.

    An ingested row replaces the base row of the same id, so no hit meets two texts.
    """
    spark = questions.sparkSession
    vectors = spark.read.parquet(f"{root}/vectors").select("id", "embedding", "cell")
    rows = spark.read.parquet(f"{root}/questions").select(*questions.columns)
    kept = index.vectors.select("id", "embedding", "cell").join(vectors.select("id"), "id", "left_anti")
    older = questions.join(rows.select("question_id"), "question_id", "left_anti").select(*questions.columns)
    return VectorIndex(index.centroids, kept.unionByName(vectors)), older.unionByName(rows)
