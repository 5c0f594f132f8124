"""Queries of a log linked to the first earlier query that was nearly the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nearkin.operators.vectors import first_similar
from nearkin.streaming import batches

# Fixed value: cosine from which an earlier result may be used again.
REUSE_THRESHOLD = 0.95


def link_queries(queries: DataFrame, log: DataFrame, threshold: float = REUSE_THRESHOLD) -> DataFrame:
    """``query_id, matched_query_id, similarity, was_cached`` of ``queries(query_id, ts, query_embedding)``."""
    def placed(df: DataFrame) -> DataFrame:
        return df.select("query_id", F.col("query_embedding").cast("array<double>").alias("query_embedding"),
                         F.unix_micros(F.col("ts").cast("timestamp")).alias("place"))

    return first_similar(placed(queries), placed(log), threshold).withColumn("was_cached", F.col("matched_query_id").isNotNull())


def start_reuse(stream: DataFrame, root: str, checkpoint: str, threshold: float = REUSE_THRESHOLD, **options) -> StreamingQuery:
    """Store the log and the links of each micro-batch against all that came so far."""
    def handle(df: DataFrame, batch_id: int) -> None:
        batches.write_batch(df.select("query_id", "ts", "query_embedding"), root, "log", batch_id)
        spark = df.sparkSession
        own = spark.read.parquet(batches.batch_path(root, "log", batch_id))
        log = batches.rows_of(spark, root, "log").filter(F.col("batch_id") <= batch_id)
        batches.write_batch(link_queries(own, log, threshold), root, "links", batch_id)

    return batches.run_stream(stream, handle, checkpoint, **options)


def reused_results(links: DataFrame, ranked: DataFrame, k: int) -> DataFrame:
    """The stored hits of every query, or those of the query that it is linked to."""
    source = links.select("query_id", F.coalesce("matched_query_id", "query_id").alias("source_id"))
    hits = ranked.filter(F.col("rank") <= k).withColumnRenamed("query_id", "source_id")
    return source.join(hits, "source_id").drop("source_id")


def reuse_summary(links: DataFrame) -> DataFrame:
    """One row ``n_queries, n_cached, hit_rate``."""
    cached = F.count(F.when(F.col("was_cached"), 1))
    return links.agg(F.count("*").alias("n_queries"), cached.alias("n_cached"),
                     F.round(F.coalesce(F.try_divide(cached.cast("double"), F.count("*")), F.lit(0.0)), 4).alias("hit_rate"))
