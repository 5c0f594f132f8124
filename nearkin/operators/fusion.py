"""Fusion, reranking and thresholding of ranked lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.functions.encoders import PairScorer
from nearkin.operators.ranking import top_k

# Fixed value: rank damping of the fusion.
RRF_K = 60


def reciprocal_rank_fusion(lists: list[DataFrame], k: int = RRF_K, top: int = 10) -> DataFrame:
    """Sum of ``1 / (k + rank)`` over the lists that hold a document.

    Lists have ``query_id, rank, question_id`` and may carry further columns, which are taken
    from the last list holding the document. Equal sums keep the order of first appearance.
    """
    payload = sorted({c for df in lists for c in df.columns} - {"query_id", "rank", "question_id", "score"})
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.drop("score").withColumn("list_no", F.lit(i)) for i, df in enumerate(lists)],
    )
    fused = stacked.groupBy("query_id", "question_id").agg(
        F.sum(1.0 / (F.lit(k) + F.col("rank"))).alias("score"),
        F.min(F.col("list_no").cast("long") * (1 << 32) + F.col("rank")).alias("_first"),
        *[F.max_by(c, "list_no").alias(c) for c in payload],
    )
    return top_k(fused, ["query_id"], "score", top, ["_first"]).select(
        "query_id", "rank", "question_id", *payload, F.round("score", 6).alias("score"))


def rerank(candidates: DataFrame, scorer: PairScorer | None, k: int = 5,
           query_col: str = "query_text", text_col: str = "question_text") -> DataFrame:
    """Replace the score by a pair score and keep the best ``k``; ties keep their old order.

    Without a scorer the first ``k`` candidates pass through.
    """
    if scorer is None:
        return candidates.filter(F.col("rank") <= k)
    rescored = candidates.withColumn("score", F.round(scorer(F.col(query_col), F.col(text_col)), 4))
    rescored = rescored.withColumnRenamed("rank", "_old_rank")
    return top_k(rescored, ["query_id"], "score", k, ["_old_rank"]).select(*candidates.columns)


def threshold_and_cut(ranked: DataFrame, threshold: float | str, k: int | str) -> DataFrame:
    """Rows scoring at least ``threshold`` and then the first ``k``.

    Scores fall with the rank, so the rows kept are a prefix and keep their rank. Both bounds
    may name a column that carries the value of each query.
    """
    at_least = F.col(threshold) if isinstance(threshold, str) else F.lit(threshold)
    at_most = F.col(k) if isinstance(k, str) else F.lit(k)
    return ranked.filter((F.col("score") >= at_least) & (F.col("rank") <= at_most))
