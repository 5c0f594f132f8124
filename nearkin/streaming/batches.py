"""Micro-batch output that a replay overwrites instead of repeating."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nearkin.operators.ranking import latest_per_key


def batch_path(root: str, table: str, batch_id: int) -> str:
    return f"{root}/{table}/batch_id={batch_id}"


def write_batch(df: DataFrame, root: str, table: str, batch_id: int) -> None:
    """Write one micro-batch as its own partition; a replay of the batch replaces it."""
    df.write.mode("overwrite").parquet(batch_path(root, table, batch_id))


def run_stream(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
               output_mode: str = "append", available_now: bool = False,
               interval: str = "1 minute") -> StreamingQuery:
    """Start a stream that hands its micro-batches to ``handle``."""
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def keep_updates(stream: DataFrame, root: str, table: str, checkpoint: str, **options) -> StreamingQuery:
    """Store the updated rows of a streaming aggregate; ``latest_updates`` reads the newest of each key."""
    return run_stream(stream, lambda df, batch_id: write_batch(df, root, table, batch_id), checkpoint,
                      output_mode="update", **options)


def latest_updates(spark: SparkSession, root: str, table: str, key: str) -> DataFrame:
    return latest_per_key(spark.read.parquet(f"{root}/{table}"), key, ["batch_id"]).drop("batch_id")


def rows_of(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All micro-batches of a table."""
    return spark.read.parquet(f"{root}/{table}").withColumn("batch_id", F.col("batch_id").cast("long"))
