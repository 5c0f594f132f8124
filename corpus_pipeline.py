"""From raw documents to training text: five stages, each written and read again by the next.

A stage takes (spark, docs, folder of the tables) and returns a DataFrame; all but the last
return the columns of ``docs``. Rows without text go the way of empty text: the quality model
scores them and the later stages leave what it keeps unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.llm import bottom_k, bpe, fm_index, quality_gam, secret_scan
from nearkin.llm.common import free_name, id_remainder, table
from nearkin.llm.queries import VOCABULARY
from nearkin.session import materialize


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` set to the length of the text after a stage changed it."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.select(*[F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars").alias(c) if c == "n_chars" else c for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality model accepts."""
    model = quality_gam.fit(docs, table(spark, folder, "labels"), held_out=id_remainder("doc_id", 4) == 2)
    score = free_name(docs, "score")
    return quality_gam.score(docs, model).filter(F.col(score) >= quality_gam.THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies."""
    return bottom_k.keep_one(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the passages that also stand in the benchmark."""
    return _counted(fm_index.remove(docs, table(spark, folder, "benchmark")))


def remove_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts with a mark in place of each secret."""
    return _counted(secret_scan.redact(docs))


def tokenize(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Number and digest of the ids of each text, and the digest of what they decode to."""
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("remove_secrets", remove_secrets),
    ("tokenize", tokenize),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)


# Learned scores, hashed shingles and merges of ids are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None
