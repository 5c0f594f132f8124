"""Validation of search, ingest and feedback records.

Each function adds ``reject_reason``, an array that is empty for valid rows; ``accepted`` and
``quarantined`` split the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearkin.functions.text import is_blank, strip
from nearkin.operators.ranking import exact_quantiles

# Request rules.
MIN_TEXT, MAX_TEXT = 3, 1000
DEFAULT_TOP_K, MAX_TOP_K = 5, 20
DEFAULT_THRESHOLD = 0.3
MAX_BATCH = 100
MIN_RATING, MAX_RATING = 1, 5


def _reasons(**checks: Column) -> Column:
    named = F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in checks.items()])
    return F.filter(named, lambda r: r.isNotNull())


def _text_checks(text: Column, name: str) -> dict[str, Column]:
    return {
        f"{name}_too_short": text.isNull() | (F.length(text) < MIN_TEXT),
        f"{name}_too_long": text.isNotNull() & (F.length(text) > MAX_TEXT),
        f"{name}_blank": is_blank(text),
    }


def _with_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "top_k": F.coalesce("top_k", F.lit(DEFAULT_TOP_K)),
        "score_threshold": F.coalesce("score_threshold", F.lit(DEFAULT_THRESHOLD)),
    })


def _option_checks() -> dict[str, Column]:
    return {
        "top_k_out_of_range": ~F.col("top_k").between(1, MAX_TOP_K),
        "threshold_out_of_range": ~F.col("score_threshold").between(0.0, 1.0),
    }


def validate_requests(df: DataFrame) -> DataFrame:
    """Search requests: defaults filled in, text stripped after its length was checked."""
    filled = _with_defaults(df)
    checked = filled.withColumn("reject_reason", _reasons(**_text_checks(F.col("question"), "question"), **_option_checks()))
    return checked.withColumn("question", strip(F.col("question")))


def validate_batches(df: DataFrame) -> DataFrame:
    """Batch requests: 1 to 100 items; the items themselves are not checked."""
    size = F.size("questions")
    return _with_defaults(df).withColumn("reject_reason", _reasons(
        batch_empty=F.col("questions").isNull() | (size < 1), batch_too_large=size > MAX_BATCH, **_option_checks()))


def validate_batch_sizes(items: DataFrame, batch: str = "batch_id") -> DataFrame:
    """``batch, n_items, reject_reason`` for batches that come as one row per item."""
    sizes = items.groupBy(batch).agg(F.count("*").alias("n_items"))
    return sizes.withColumn("reject_reason", _reasons(batch_too_large=F.col("n_items") > MAX_BATCH))


def validate_ingest(df: DataFrame) -> DataFrame:
    checked = df.withColumn("reject_reason", _reasons(**_text_checks(F.col("question_text"), "question_text")))
    return checked.withColumn("question_text", strip(F.col("question_text")))


def validate_feedback(df: DataFrame) -> DataFrame:
    """Rating absent or 1 to 5; the relevance flag becomes 0/1."""
    rating = F.col("user_rating")
    return df.withColumn("reject_reason", _reasons(
        question_missing=F.col("retrieved_question_id").isNull(),
        relevance_missing=F.col("is_relevant").isNull(),
        rating_out_of_range=rating.isNotNull() & ~F.coalesce(rating.between(MIN_RATING, MAX_RATING), F.lit(True)),
    )).withColumn("is_relevant", F.col("is_relevant").cast("int"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reject_reason") == 0).drop("reject_reason")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reject_reason") > 0)


def request_summary(log: DataFrame) -> DataFrame:
    """Totals of a request log with ``status, latency_ms, was_cached``.

    Latency percentiles interpolate linearly; the hit rate is 0 without requests.
    """
    hits, misses = F.count(F.when(F.col("was_cached"), 1)), F.count(F.when(~F.col("was_cached"), 1))
    totals = log.agg(
        F.count("*").alias("total_requests"), hits.alias("cache_hits"), misses.alias("cache_misses"),
        F.round(F.coalesce(F.try_divide(hits.cast("double"), hits + misses), F.lit(0.0)), 4).alias("cache_hit_rate"),
        F.round(F.avg(F.when(F.col("status") < 400, 1.0).otherwise(0.0)), 4).alias("success_rate"),
    )
    latency = exact_quantiles(log, "latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    percentiles = totals.withColumn("_p", latency.select(F.struct("*")).scalar())
    return percentiles.select(*totals.columns, *[F.round(F.col(f"_p.{c}"), 4).alias(c) for c in latency.columns])


def per_query_latency(batches: DataFrame) -> DataFrame:
    """Latency of each query of a batch: elapsed time shared evenly."""
    return batches.withColumn("latency_ms", F.round(F.col("elapsed_ms") / F.size("questions"), 2))


def approximate_latency(log: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """p50, p95 and p99 with bounded memory, for logs with too many distinct latencies."""
    q = F.percentile_approx("latency_ms", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), F.lit(accuracy))
    return log.agg(q.alias("_p")).select(*[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(("p50", "p95", "p99"))])
