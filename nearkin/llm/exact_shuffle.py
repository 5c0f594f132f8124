"""Sharding: a uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows each source partition sends to each shard is drawn before anything moves. In a
uniform shuffle these counts follow a multivariate hypergeometric law, so they are drawn from
it exactly: partition after partition takes its rows from what is left of the shards. Every
partition then permutes its rows and deals them out by its row of the matrix, the rows are
exchanged, and every shard permutes what it has got. Shard sizes differ by one row at most.

Only the matrix is made on the driver. Its size is fixed: source partitions are taken together
until there are at most ``SOURCES`` of them. The rows go through joins, windows and hashes
alone. Windows never cover a whole shard: slots come from counts of hash ranges of about
``RANGE_ROWS`` rows plus the place within the range.

Defined results: null text has size 16 and the checksum of the empty text; repeated rows and
tied ids are rows of their own; ids may be null; empty shards occur when there are fewer rows
than shards; an empty table gives no rows. The same files and seed give the same shuffle.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearkin.llm.common import free_name
from nearkin.session import materialize

SHARDS = 40
SOURCES = 4096
RANGE_ROWS = 500_000
LIBRARY_LIMIT = 10**9


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows taken from ``good + bad`` are good."""
    if good + bad < LIBRARY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(draws, good)
    mean = draws * good / (good + bad)
    width = 14 * math.sqrt(mean * (1 - good / (good + bad))) + 14
    value = np.arange(max(low, math.floor(mean - width)), min(high, math.ceil(mean + width)) + 1, dtype=np.float64)
    # probabilities relative to the first value, from the ratios of neighbours
    ratio = (good - value[:-1]) * (draws - value[:-1]) / ((value[:-1] + 1) * (bad - draws + value[:-1] + 1))
    logs = np.concatenate([[0.0], np.cumsum(np.log(ratio))])
    weight = np.cumsum(np.exp(logs - logs.max()))
    return int(value[np.searchsorted(weight, rng.random() * weight[-1], side="right")])


def communication_matrix(sources: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows sent from each source to each shard; rows sum to the sources, columns to the shards."""
    rng = np.random.default_rng(seed)
    left, matrix = list(shards), []
    for size in sources:
        row, rest, total = [], size, sum(left)
        for capacity in left:
            total -= capacity
            taken = rest if total == 0 else _hypergeometric(rng, capacity, total, rest) if rest else 0
            row.append(taken)
            rest -= taken
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    """As equal as can be, the first ones larger by one."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shuffle(df: DataFrame, shards: int = SHARDS, seed: int = 42, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``df`` with the shard of each row and its place there, counted from 0.

    The columns of ``df`` move through two exchanges: give it keys rather than texts.
    """
    spark, columns = df.sparkSession, df.columns
    shard, slot = free_name(df, shard), free_name(df, slot)
    place, source, order = (free_name(df, n) for n in ("_place", "_source", "_order"))
    stored = materialize(df.withColumn(place, F.monotonically_increasing_id()), "shuffle-input")
    part = F.shiftright(place, 33)
    sizes = stored.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    parts = sizes.agg(F.max("part")).first()[0]
    width = 1 if parts is None else -(-(parts + 1) // SOURCES)
    grouped = stored.withColumn(source, F.floor(part / width).cast("int"))
    counts = grouped.groupBy(source).agg(F.count("*").alias("rows")).orderBy(source).collect()  # at most SOURCES rows
    total = sum(r["rows"] for r in counts)
    matrix = communication_matrix([r["rows"] for r in counts], shard_sizes(total, shards), seed)
    bounds = json.dumps([{"source": r[source], "bounds": np.cumsum(row).tolist()} for r, row in zip(counts, matrix)])
    dealt = (spark.range(1).select(F.explode(F.from_json(F.lit(bounds), "array<struct<source int, bounds array<long>>>")).alias("_m"))
             .select(F.col("_m.source").alias(source), F.col("_m.bounds").alias("_bounds")))

    def mixed(step: int) -> Column:
        return F.xxhash64(F.lit(seed), F.lit(step), F.col(place))

    local = Window.partitionBy(source).orderBy(mixed(1), place)
    sent = (
        grouped.withColumn(order, F.row_number().over(local)).join(F.broadcast(dealt), source)
        .withColumn(shard, F.size(F.filter("_bounds", lambda b: b < F.col(order))))
        .select(*columns, shard, place))
    # slots follow the unsigned order of the hashes, with or without ranges, so the size of the table does not matter
    unsigned = F.col(order).bitwiseXOR(F.lit(-(1 << 63)))
    ranges = max(1, -(-total // (shards * RANGE_ROWS)))
    ranged = sent.withColumn(order, mixed(2)).withColumn(source, F.floor((F.shiftrightunsigned(order, 32) * ranges) / F.lit(1 << 32)).cast("int"))
    if ranges == 1:
        inside = Window.partitionBy(shard).orderBy(unsigned, place)
        return ranged.withColumn(slot, F.row_number().over(inside).cast("long") - 1).select(*columns, shard, slot)
    ranged = materialize(ranged, "shuffle-ranges")
    before = Window.partitionBy(shard).orderBy(source).rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy(shard, source).agg(F.count("*").alias("_n"))
              .select(shard, source, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(shard, source).orderBy(unsigned, place)
    return (ranged.withColumn(slot, F.row_number().over(inside).cast("long") - 1).join(starts, [shard, source])
            .withColumn(slot, F.col(slot) + F.col("_start")).select(*columns, shard, slot))


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = 42) -> DataFrame:
    """Size, checksum and place of each document; the law that holds is ``rows``."""
    value = F.coalesce(F.col(text), F.lit(""))
    keys = df.select(
        F.col(doc_id), (F.octet_length(value) + 16).cast("long").alias("size"),
        F.crc32(value.cast("binary")).alias("text_crc32"))
    return shuffle(keys, shards, seed).select(
        doc_id, "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, seed: int = 42) -> None:
    """Write ``df`` as one folder per shard, each in the order of its slots."""
    placed = shuffle(df, shards, seed)
    shard, slot = placed.columns[-2:]
    placed.repartition(shards, shard).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
