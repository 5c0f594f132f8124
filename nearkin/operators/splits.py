"""Train, validation and test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearkin.operators.ranking import join_null_safe

# Shares of the splits.
TEST_SHARE = 0.15
VAL_SHARE = 0.05


def _hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"|{seed}")))


def hash_split(df: DataFrame, key: str, seed: int = 42, test: float = TEST_SHARE, val: float = VAL_SHARE) -> DataFrame:
    """Assign ``split`` from a hash of the key: no shuffle, and a row never changes its split.

    Sizes and label ratios hold within sampling error; ``stratified_split`` hits them exactly.
    """
    digits = F.conv(F.substring(_hash(F.col(key), seed), 1, 8), 16, 10).cast("long")
    place = digits / F.lit(float(16 ** 8))
    return df.withColumn(
        "split", F.when(place < test, "test").when(place < test + val, "val").otherwise("train"))


def _quotas(sizes: DataFrame, label: str, share: float, out: str) -> DataFrame:
    """Rows per label for one split: ``ceil(share·N)`` in all, by largest remainder.

    ``sizes`` has one row per label, so its windows are tiny.
    """
    everything = Window.partitionBy()
    total = F.ceil(F.round(F.sum("n").over(everything) * share, 6))
    exact = F.col("n") * total / F.sum("n").over(everything)
    shares = sizes.withColumn("_total", total).withColumn("_exact", exact).withColumn("_floor", F.floor("_exact"))
    rest = F.col("_total") - F.sum("_floor").over(everything)
    place = F.row_number().over(Window.orderBy((F.col("_exact") - F.col("_floor")).desc(), label))
    return (
        shares.withColumn("_rest", rest).withColumn("_place", place)
        .withColumn(out, (F.col("_floor") + F.when(F.col("_place") <= F.col("_rest"), 1).otherwise(0)).cast("long"))
        .drop("_total", "_exact", "_floor", "_rest", "_place")
    )


def stratified_split(df: DataFrame, key: str, label: str = "is_duplicate", seed: int = 42,
                     test: float = TEST_SHARE, val: float = VAL_SHARE, prefix_digits: int = 3) -> DataFrame:
    """Split of exact size with the label ratio kept in every part.

    Rows of a label are ranked by a hash of their unique key. The leading hex digits cut the
    rows of a label into equal ranges: counts per range give the rank at which a range starts,
    and a row only needs its place within its own range. Rows without a label are a label of
    their own, and a null key hashes like an empty one.
    """
    hashed = df.withColumn("_hash", _hash(F.col(key), seed))
    hashed = hashed.withColumn("_range", F.substring("_hash", 1, prefix_digits))
    ranges = hashed.groupBy(label, "_range").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(label).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))

    quotas = _quotas(ranges.groupBy(label).agg(F.sum("_rows").alias("n")), label, test, "n_test")
    rest = quotas.withColumn("n", F.col("n") - F.col("n_test"))
    quotas = _quotas(rest, label, val / (1.0 - test), "n_val").select(label, "n_test", "n_val")
    plan = join_null_safe(starts, quotas, [label]).select(label, "_range", "_start", "n_test", "n_val")

    place = F.row_number().over(Window.partitionBy(label, "_range").orderBy("_hash", key)) + F.col("_start")
    return (
        # at most labels × 16^prefix_digits rows
        join_null_safe(hashed, F.broadcast(plan), [label, "_range"])
        .withColumn("_place", place)
        .withColumn("split", F.when(F.col("_place") <= F.col("n_test"), "test")
                    .when(F.col("_place") <= F.col("n_test") + F.col("n_val"), "val").otherwise("train"))
        .select(*df.columns, "split")
    )
