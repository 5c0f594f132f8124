"""Versioned search tables.

Each version is a folder ``v=N`` holding ``centroids``, ``vectors`` (partitioned by cell),
``questions`` and, written last, a one-row ``manifest``. Later additions to a version lie in
``v=N/add=M`` with vectors, questions and a manifest of their own: adding costs as much as the
added rows, and reading puts the newest row of every id in front. Readers use the highest
version that has a manifest and its additions that have one, so a half-written part is never
seen.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.operators.vectors import VectorIndex, corpus_centroid


def children(spark: SparkSession, path: str) -> list[str]:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def numbers_of(spark: SparkSession, path: str, prefix: str) -> list[int]:
    return sorted(int(m.group(1)) for name in children(spark, path) if (m := re.fullmatch(rf"{prefix}=(\d+)", name)))


def complete_parts(spark: SparkSession, path: str, prefix: str) -> list[int]:
    return [n for n in numbers_of(spark, path, prefix) if "_SUCCESS" in children(spark, f"{path}/{prefix}={n}/manifest")]


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions."""
    return complete_parts(spark, root, "v")


def next_version(spark: SparkSession, root: str) -> int:
    """Above every folder present, complete or not."""
    return max(numbers_of(spark, root, "v"), default=0) + 1


def _write_vectors(vectors: DataFrame, path: str) -> None:
    """Range partitioning gives a few files per cell and splits a crowded cell over tasks."""
    vectors.select("id", "embedding", "cell").repartitionByRange("cell", "id").write.partitionBy("cell").parquet(path)


def write_version(index: VectorIndex, questions: DataFrame, root: str) -> int:
    """Write all tables of a new version and then its manifest; returns its number."""
    spark = questions.sparkSession
    number = next_version(spark, root)
    base = f"{root}/v={number}"
    index.centroids.write.parquet(f"{base}/centroids")
    _write_vectors(index.vectors, f"{base}/vectors")
    questions.write.parquet(f"{base}/questions")
    stored = spark.read.parquet(f"{base}/vectors")
    manifest = stored.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).select(
        F.lit(number).alias("version"), F.col("n").alias("built_n"), "n", "dim",
        corpus_centroid(stored).scalar().alias("corpus_centroid"),
        F.current_timestamp().alias("built_at"),
    )
    manifest.coalesce(1).write.parquet(f"{base}/manifest")
    return number


def write_addition(vectors: DataFrame, questions: DataFrame, root: str, n: int) -> int:
    """Add rows to the newest version, which then holds ``n`` vectors; returns the addition's number."""
    spark = questions.sparkSession
    base = f"{root}/v={versions(spark, root)[-1]}"
    number = max(numbers_of(spark, base, "add"), default=0) + 1
    _write_vectors(vectors, f"{base}/add={number}/vectors")
    questions.write.parquet(f"{base}/add={number}/questions")
    spark.range(1).select(F.lit(n).cast("long").alias("n"), F.current_timestamp().alias("added_at")).coalesce(1).write.parquet(
        f"{base}/add={number}/manifest")
    return number


def _newest_rows(spark: SparkSession, base: str, additions: list[int], name: str, key: str) -> DataFrame:
    """The base table with its additions; of rows with one key the latest addition wins.

    Only the keys of the additions are aggregated, and they meet the base table in one join.
    """
    table = spark.read.parquet(f"{base}/{name}")
    if not additions:
        return table
    added = reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{base}/add={m}/{name}").withColumn("_add", F.lit(m)) for m in additions])
    latest = added.groupBy(key).agg(F.max("_add").alias("_latest"))
    kept = table.join(latest.select(key), key, "left_anti")
    newest = added.join(latest, key).filter(F.col("_add") == F.col("_latest"))
    return kept.unionByName(newest.select(*table.columns))


def read_version(spark: SparkSession, root: str, number: int | None = None) -> tuple[VectorIndex, DataFrame, DataFrame]:
    """``(index, questions, manifest)`` of a version, by default the newest complete one."""
    complete = versions(spark, root)
    if not complete:
        raise FileNotFoundError(f"no complete version below {root}")
    base = f"{root}/v={number or complete[-1]}"
    additions = complete_parts(spark, base, "add")
    manifest = spark.read.parquet(f"{base}/manifest")
    if additions:
        n = spark.read.parquet(f"{base}/add={additions[-1]}/manifest").first()["n"]
        manifest = manifest.withColumn("n", F.lit(n).cast("long"))
    index = VectorIndex(
        spark.read.parquet(f"{base}/centroids"), _newest_rows(spark, base, additions, "vectors", "id"))
    return index, _newest_rows(spark, base, additions, "questions", "question_id"), manifest
