"""Retrieval metrics over long tables.

``queries(query_id)``, ``retrieved(query_id, rank, question_id)``, ``truth(query_id, relevant_id)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.operators.corpus import truth_from_pairs

K_VALUES = (1, 5, 10)


def first_hits(queries: DataFrame, retrieved: DataFrame, truth: DataFrame) -> DataFrame:
    """``query_id, first_hit``: rank of the first relevant row; null when there is none.

    Queries that retrieved nothing stay in, because they count as misses.
    """
    relevant = truth.select("query_id", F.col("relevant_id").alias("question_id")).distinct()
    hits = (
        retrieved.select("query_id", "question_id", "rank")
        .join(relevant, ["query_id", "question_id"], "left_semi")
        .groupBy("query_id").agg(F.min("rank").alias("first_hit"))
    )
    return queries.select("query_id").distinct().join(hits, "query_id", "left")


def evaluate_retrieval(queries: DataFrame, retrieved: DataFrame, truth: DataFrame,
                       k_values: Sequence[int] = K_VALUES) -> DataFrame:
    """One row ``n_queries, recall_at_k…, mrr``, rounded to 4 digits; 0 without queries.

    A query counts for recall at k when any relevant row is among its first k.
    """
    first = first_hits(queries, retrieved, truth)
    zero = F.lit(0.0)
    return first.agg(
        F.count("*").alias("n_queries"),
        *[
            F.round(F.coalesce(F.avg(F.when(F.col("first_hit") <= k, 1.0).otherwise(0.0)), zero), 4).alias(f"recall_at_{k}")
            for k in k_values
        ],
        F.round(F.coalesce(F.avg(F.coalesce(1.0 / F.col("first_hit"), zero)), zero), 4).alias("mrr"),
    )


def retrieval_queries(pairs: DataFrame, corpus_ids: DataFrame, n: int | None = None,
                      fallback: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(queries, truth)`` for the retrieval evaluation.

    Truth is the symmetric closure of the positive pairs. Queries are its ids that exist in
    ``corpus_ids(question_id)``, all or the first ``n`` by id. Without any, all or the first
    ``fallback`` corpus ids serve as queries, each relevant to itself.
    """
    truth = truth_from_pairs(pairs)
    ids = corpus_ids.select(F.col("question_id").alias("query_id"))
    queries = truth.select("query_id").distinct().join(ids, "query_id", "left_semi")
    if queries.isEmpty():
        queries = ids if fallback is None else ids.orderBy("query_id").limit(fallback)
        return queries, queries.select("query_id", F.col("query_id").alias("relevant_id"))
    return (queries if n is None else queries.orderBy("query_id").limit(n)), truth
