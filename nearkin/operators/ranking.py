"""Top-k, exact cumulative counts, dense ids and keep-latest, without one-task windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearkin.session import materialize

# Scores are compared at this many decimals, so that the order of equal scores does not
# depend on the order in which partial sums arrived.
RANK_DECIMALS = 9


def top_k(df: DataFrame, by: Sequence[str], score: str, k: int, ties: Sequence[str | Column],
          rank_col: str = "rank") -> DataFrame:
    """Best ``k`` rows per group by descending score, ranked from 1.

    The rank filter sits directly on the window, so Spark keeps ``k`` rows per group and task
    before the shuffle: a hot group never gathers in one task.
    """
    order = Window.partitionBy(*by).orderBy(F.round(F.col(score), RANK_DECIMALS).desc(), *ties)
    return df.withColumn(rank_col, F.row_number().over(order)).filter(F.col(rank_col) <= k)


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same ones on every run."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), F.col(key)).limit(n)


def with_row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Gapless index from 0 in the present row order.

    Partition-local positions are written once, then shifted by the row counts of the earlier
    partitions. Only one row per partition is aggregated.
    """
    tagged = materialize(df.withColumn("_position", F.monotonically_increasing_id()), "row-index")
    tagged = tagged.withColumn("_part", F.shiftright("_position", 33))
    sizes = tagged.groupBy("_part").agg(
        (F.max(F.col("_position").bitwiseAND((1 << 33) - 1)) + 1).alias("_size"))
    starts = sizes.select(
        "_part",
        F.coalesce(
            F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_start"),
    )
    # one row per input partition: small by construction
    return (
        tagged.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_position").bitwiseAND((1 << 33) - 1))
        .drop("_position", "_part", "_start")
    )


def dense_index(df: DataFrame, order_by: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """Gapless index from 0 in the order of ``order_by`` (a range-partitioned sort)."""
    return with_row_index(df.orderBy(*order_by), name)


def latest_per_key(df: DataFrame, key: str, sequence: Sequence[str]) -> DataFrame:
    """The row with the highest ``sequence`` of each key; partial aggregation absorbs hot keys."""
    columns = df.columns
    newest = df.groupBy(key).agg(
        F.max_by(F.struct(*[c for c in columns if c != key]), F.struct(*sequence)).alias("_row"))
    return newest.select(key, "_row.*").select(*columns)


def top_n_by_count(stored: DataFrame, count: str, n: int, tie: str) -> DataFrame:
    """The ``n`` rows of largest ``count`` of a stored table, for ``n`` in the tens of thousands.

    A histogram over quarter-octaves of the count tells from where on the rows can be in the
    result; only those reach the final ordering, instead of ``n`` rows of every partition.
    """
    grade = F.floor(F.log2(F.col(count)) * 4)
    counts = Window.orderBy(F.col("_grade").desc())
    # at most a few hundred grades exist, whatever the number of rows
    cut = (
        stored.groupBy(grade.alias("_grade")).agg(F.count("*").alias("_rows"))
        .withColumn("_above", F.sum("_rows").over(counts) - F.col("_rows"))
        .filter(F.col("_above") < n)
        .agg(F.min("_grade").alias("_cut"))
    )
    kept = stored.filter(grade >= F.coalesce(cut.scalar(), F.lit(0)))
    return kept.orderBy(F.col(count).desc(), tie).limit(n)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which a null key meets a null key; the keys come from the left."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    return left.join(renamed, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in keys]).drop(*[f"_right_{c}" for c in keys])


MIN_RANGES, MAX_RANGES, RANGE_ROWS = 200, 10_000, 1_000_000


def cumulative_from_top(points: DataFrame, by: Sequence[str], key: str, sums: dict[str, str]) -> DataFrame:
    """Running totals of columns in descending order of ``key``, per group, current row included.

    ``points`` holds one row per group and key; keys are numbers, groups may be null. Quantiles of the key cut it into ranges; the
    totals of the higher ranges are added to a running sum inside each range, so no task sees
    more than about one range of a group.
    """
    ranges = min(MAX_RANGES, max(MIN_RANGES, points.count() // RANGE_ROWS))
    probabilities = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(points.approxQuantile(key, probabilities, 0.2 / ranges)))
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol=key, outputCol="_range").transform(points)

    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_total_{c}") for c in sums])
    higher = Window.partitionBy(*by).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_range",
        *[F.coalesce(F.sum(f"_total_{c}").over(higher), F.lit(0)).alias(f"_above_{c}") for c in sums],
    )
    inside = (
        Window.partitionBy(*by, "_range").orderBy(F.col(key).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = join_null_safe(ranged, offsets, [*by, "_range"])
    return joined.select(
        *points.columns,
        *[(F.sum(c).over(inside) + F.col(f"_above_{c}")).alias(out) for c, out in sums.items()],
    )


def exact_quantiles(df: DataFrame, value: str, probabilities: dict[str, float]) -> DataFrame:
    """One row of linearly interpolated quantiles; null without values.

    Values are folded to counts and ranked by range totals, so no task holds all of them.
    """
    present = df.filter(F.col(value).isNotNull())
    points = materialize(
        present.groupBy(F.col(value).cast("double").alias("value")).agg(F.count("*").alias("n"), F.lit(0).alias("_all")),
        "quantile-points")
    total = points.agg(F.sum("n").alias("total")).first()["total"] or 0
    ranked = cumulative_from_top(points, ["_all"], "value", {"n": "at_or_above"})
    start = F.lit(total) - F.col("at_or_above")

    def at(position: int) -> Column:
        return F.max(F.when((start <= position) & (position < start + F.col("n")), F.col("value")))

    def quantile(p: float) -> Column:
        place = p * max(total - 1, 0)
        low = int(place)
        below, above = at(low), at(min(low + 1, max(total - 1, 0)))
        return below + (above - below) * (place - low)

    return ranked.agg(*[quantile(p).alias(name) for name, p in probabilities.items()])
