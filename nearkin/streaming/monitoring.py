"""Feedback, request metrics and click-through as windowed jobs.

The windowed functions run unchanged on a batch table and on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nearkin.operators.requests import accepted, quarantined, validate_feedback
from nearkin.session import materialize
from nearkin.streaming.batches import run_stream, write_batch

# Fixed value: click-through below this raises an alert.
MIN_CLICK_THROUGH = 0.15


def feedback_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """Store valid feedback with an id and a time stamp, the rest in quarantine."""
    checked = materialize(validate_feedback(batch), "feedback")
    write_batch(
        accepted(checked).select(F.expr("uuid()").alias("id"), F.current_timestamp().alias("timestamp"), "*"),
        root, "feedback", batch_id)
    write_batch(quarantined(checked), root, "feedback_rejects", batch_id)


def start_feedback(stream: DataFrame, root: str, checkpoint: str, **options) -> StreamingQuery:
    return run_stream(stream, lambda df, batch_id: feedback_batch(df, batch_id, root), checkpoint, **options)


def feedback_rates(feedback: DataFrame) -> DataFrame:
    """Feedback rows, relevance rate and mean rating per question."""
    return feedback.groupBy("retrieved_question_id").agg(
        F.count("*").alias("n"), F.round(F.avg("is_relevant"), 4).alias("relevance_rate"),
        F.round(F.avg("user_rating"), 4).alias("mean_rating"))


def request_metrics_by_window(log: DataFrame, window: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    """Requests, cache hit rate and mean latency per time window of ``ts``."""
    hits, misses = F.count(F.when(F.col("was_cached"), 1)), F.count(F.when(~F.col("was_cached"), 1))
    return (
        log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark).groupBy(F.window("ts", window)).agg(
            F.count("*").alias("n_requests"), hits.alias("cache_hits"), misses.alias("cache_misses"),
            F.sum(F.when(F.col("status") >= 400, 1).otherwise(0)).alias("n_errors"),
            F.avg("latency_ms").alias("mean_latency"))
        .select(
            F.col("window.start").alias("window_start"), "n_requests", "cache_hits", "cache_misses",
            F.round(F.coalesce(F.try_divide(F.col("cache_hits").cast("double"), F.col("cache_hits") + F.col("cache_misses")),
                               F.lit(0.0)), 4).alias("cache_hit_rate"),
            "n_errors", F.round("mean_latency", 4).alias("mean_latency"))
    )


def click_through_by_window(log: DataFrame, window: str = "1 day", watermark: str = "1 hour",
                            shown: str = "view", clicked: str = "click", dismissed: str = "dismiss") -> DataFrame:
    """Impressions, clicks and dismissals per window of ``ts`` with an alert below 15 % click-through."""
    def n(kind: str):
        return F.count(F.when(F.col("event_type") == kind, 1))

    return (
        log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark).groupBy(F.window("ts", window)).agg(
            n(shown).alias("n_shown"), n(clicked).alias("n_clicked"), n(dismissed).alias("n_dismissed"))
        .select(
            F.col("window.start").alias("window_start"), "n_shown", "n_clicked", "n_dismissed",
            F.round(F.try_divide(F.col("n_clicked").cast("double"), F.col("n_shown")), 4).alias("click_through"),
            F.round(F.try_divide(F.col("n_dismissed").cast("double"), F.col("n_shown")), 4).alias("dismissal_rate"),
        )
        .withColumn("alert", F.coalesce(F.col("click_through") < MIN_CLICK_THROUGH, F.lit(False)))
    )
