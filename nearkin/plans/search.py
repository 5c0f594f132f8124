"""Search jobs: vector search with threshold and rerank, and hybrid search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearkin.functions.encoders import Encoder, PairScorer
from nearkin.functions.text import clean_transformer
from nearkin.operators import bm25
from nearkin.operators.fusion import RRF_K, reciprocal_rank_fusion, rerank, threshold_and_cut
from nearkin.operators.requests import DEFAULT_THRESHOLD, DEFAULT_TOP_K, MAX_TOP_K
from nearkin.operators.vectors import VectorIndex, attach_questions, knn_clustered

OVERFETCH = 2
# Above any candidate count, so that comparing scorers keeps all candidates.
MAX_CANDIDATES = 1 << 30


def encode_queries(queries: DataFrame, encoder: Encoder) -> DataFrame:
    """Add ``query_embedding`` to ``queries(query_id, query_text)``, cleaned like stored texts."""
    cleaned = queries.withColumn("_clean", clean_transformer(F.col("query_text")))
    return encoder(cleaned, "_clean", "query_embedding").drop("_clean")


def find_similar(queries: DataFrame, index: VectorIndex, questions: DataFrame, k: int = DEFAULT_TOP_K,
                 threshold: float = DEFAULT_THRESHOLD, scorer: PairScorer | None = None,
                 probe: int | None = None) -> DataFrame:
    """Hits of every query: twice ``k`` candidates, optional rerank, threshold, first ``k``.

    ``queries(query_id, query_text, query_embedding)``; a batch of one is the single search.
    Candidates without a stored question vanish and those behind them move up.
    Output: ``query_id, rank, question_id, score, question_text``.
    """
    found = moved_up(attach_questions(knn_clustered(queries, index, OVERFETCH * k, probe), questions))
    if scorer is not None:
        texts = queries.select("query_id", "query_text")
        found = rerank(found.join(texts, "query_id"), scorer, OVERFETCH * k).drop("query_text")
    return threshold_and_cut(found, threshold, k)


def find_similar_requests(requests: DataFrame, index: VectorIndex, questions: DataFrame, scorer: PairScorer | None = None,
                          probe: int | None = None) -> DataFrame:
    """Hits of requests that carry their own ``top_k`` and ``score_threshold``.

    ``requests(query_id, query_text, query_embedding, top_k, score_threshold)``, as validated;
    ``encode_queries`` adds the vectors. All requests are searched at once for the widest of
    them (``MAX_TOP_K`` bounds it) and each keeps twice its own number before the rerank.
    """
    own = requests.select("query_id", "query_text", "top_k", "score_threshold")
    found = knn_clustered(requests.select("query_id", "query_embedding"), index, OVERFETCH * MAX_TOP_K, probe)
    found = found.join(own, "query_id").filter(F.col("rank") <= OVERFETCH * F.col("top_k"))
    found = moved_up(attach_questions(found, questions))
    if scorer is not None:
        found = rerank(found, scorer, OVERFETCH * MAX_TOP_K)
    return threshold_and_cut(found, "score_threshold", "top_k").select("query_id", "rank", "question_id", "score", "question_text")


def moved_up(found: DataFrame) -> DataFrame:
    """Ranks from 1 without gaps, in the order of the old ones."""
    order = Window.partitionBy("query_id").orderBy("rank", "question_id")
    return found.withColumn("rank", F.row_number().over(order))


def responses(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per query: ``query_id, query_text, results, result_count``; no hits give count 0.

    ``results`` holds at most ``k`` entries in rank order.
    """
    packed = hits.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "question_id", "question_text", "score"))).alias("results"))
    joined = queries.select("query_id", "query_text").join(packed, "query_id", "left")
    return joined.select(
        "query_id", "query_text", "results",
        F.when(F.col("results").isNull(), 0).otherwise(F.size("results")).cast("int").alias("result_count"))


def hybrid_search(queries: DataFrame, index: VectorIndex, keywords: bm25.Bm25Index, k: int = 10,
                  candidates: int | None = None, probe: int | None = None, rrf_k: int = RRF_K) -> DataFrame:
    """Vector hits and keyword hits fused by reciprocal rank."""
    width = candidates or k
    dense = knn_clustered(queries.select("query_id", "query_embedding"), index, width, probe)
    sparse = bm25.search(keywords, queries.select("query_id", "query_text"), width)
    return reciprocal_rank_fusion([dense, sparse], rrf_k, k)


def compare_rerank(candidates: DataFrame, scorer: PairScorer) -> DataFrame:
    """Rank and score of every candidate before and after the pair scorer."""
    after = rerank(candidates, scorer, MAX_CANDIDATES).select(
        "query_id", "question_id", F.col("rank").alias("scorer_rank"), F.col("score").alias("scorer_score"))
    before = candidates.select(
        "query_id", "question_id", F.col("rank").alias("vector_rank"), F.col("score").alias("vector_score"))
    return before.join(after, ["query_id", "question_id"])
