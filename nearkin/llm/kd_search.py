"""Exact top-k by inner product over KD-trees, one per shard of vectors.

A shard is a slice of a partition of at most ``SHARD_ROWS`` vectors. Its tree halves the rows at
the median of the widest dimension until a leaf holds ``LEAF_ROWS`` at most; each leaf keeps
the tight box around its rows. The box bounds the inner product with a query from above, by its
upper corner where the query is positive and its lower corner where it is negative. A query
visits leaves from the best bound down and stops at the first bound below its k-th score so
far, which it carries from shard to shard. Queries that visit the same leaf are multiplied with
it at once. Trees are built once and stored; queries come in blocks of bounded size, each block
meeting every tree.

Defined results: vectors that are null or hold a null or a component that is not finite take no
part; vectors of different dimension never meet; a query id that repeats is answered once, for
its least vector, and none of its own rows is a candidate; other repeated rows are candidates
of their own; ties go to the smaller id; fewer candidates than ``k`` give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearkin.session import materialize

SHARD_ROWS = 1 << 14
LEAF_ROWS = 256
QUERY_BLOCK = 4096
SCALE = 64
_TREE = "dims int, ids binary, rows binary, ends binary, low binary, high binary"


def integer_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Ids and scaled integer vectors of the rows that take part."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return df.filter(F.col(embedding).isNotNull() & F.col(vec_id).isNotNull()).filter(finite).select(
        F.col(vec_id).cast("long").alias("id"),
        F.transform(embedding, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long")).alias("v"))


def leaves(rows: np.ndarray, least: int = LEAF_ROWS) -> list[np.ndarray]:
    """Row numbers of the leaves of a KD-tree with median splits of the widest dimension."""
    stack, found = [np.arange(len(rows))], []
    while stack:
        some = stack.pop()
        if len(some) <= least or not rows.shape[1]:
            found.append(some)
            continue
        part = rows[some]
        axis = int((part.max(0) - part.min(0)).argmax())
        middle = len(some) // 2
        order = np.argpartition(part[:, axis], middle)
        stack += [some[order[middle:]], some[order[:middle]]]
    return found


def tree_of(ids: np.ndarray, rows: np.ndarray) -> dict:
    """A stored tree: rows in leaf order, where leaves end, and their boxes."""
    parts = leaves(rows)
    order = np.concatenate(parts)
    low = np.array([rows[p].min(0) for p in parts])
    high = np.array([rows[p].max(0) for p in parts])
    ends = np.cumsum([len(p) for p in parts]).astype(np.int64)
    return {"dims": rows.shape[1], "ids": ids[order].tobytes(), "rows": rows[order].tobytes(), "ends": ends.tobytes(),
            "low": low.tobytes(), "high": high.tobytes()}


def build(vectors: DataFrame) -> DataFrame:
    """Trees over all vectors of an (id, v) table, in one narrow pass."""
    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("dims", pa.int32()), *[(n, pa.binary()) for n in ("ids", "rows", "ends", "low", "high")]])
        held: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}

        def flushed(dims: int) -> pa.RecordBatch:
            ids, rows = held.pop(dims)
            return pa.RecordBatch.from_pylist([tree_of(np.concatenate(ids), np.concatenate(rows))], schema)

        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for dims in np.unique(sizes).tolist():
                chosen = np.flatnonzero(sizes == dims)
                for some in np.split(chosen, np.arange(SHARD_ROWS, len(chosen), SHARD_ROWS)):
                    own = held.setdefault(dims, ([], []))
                    if sum(map(len, own[0])) + len(some) > SHARD_ROWS and own[0]:
                        yield flushed(dims)
                        own = held.setdefault(dims, ([], []))
                    own[0].append(ids[some])
                    own[1].append(values[starts[some][:, None] + np.arange(dims)].reshape(len(some), dims))
        for dims in list(held):
            yield flushed(dims)

    return vectors.mapInArrow(built, _TREE)


class Best:
    """The ``k`` best candidates of each query of one dimension so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.ids, self.queries, self.k = ids, queries, k
        self.scores = np.zeros((len(ids), 0), np.int64)
        self.found = np.zeros((len(ids), 0), np.int64)

    def least(self) -> np.ndarray:
        """The k-th score of each query, below all scores where there are fewer."""
        if self.scores.shape[1] < self.k:
            return np.full(len(self.ids), np.iinfo(np.int64).min)
        return np.where(self.found[:, -1] == _NONE, np.iinfo(np.int64).min, self.scores[:, -1])

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer candidates to some of the queries; ``_NONE`` marks an empty place."""
        width = self.scores.shape[1]
        all_scores = np.concatenate([self.scores[at], scores], axis=1)
        all_ids = np.concatenate([self.found[at], ids], axis=1)
        order = np.lexsort((all_ids, -all_scores, all_ids == _NONE), axis=1)[:, :self.k]
        kept = np.take_along_axis(all_scores, order, 1), np.take_along_axis(all_ids, order, 1)
        if width < self.k:
            grown = min(self.k, kept[0].shape[1])
            wide = np.zeros((len(self.ids), grown), np.int64), np.full((len(self.ids), grown), _NONE)
            wide[0][:, :width], wide[1][:, :width] = self.scores, self.found
            self.scores, self.found = wide
        self.scores[at, :kept[0].shape[1]], self.found[at, :kept[1].shape[1]] = kept


_NONE = np.iinfo(np.int64).max


def visit(tree: dict, best: Best) -> None:
    """Take the rows of one tree into the best candidates of all queries."""
    dims = tree["dims"]
    ids = np.frombuffer(tree["ids"], np.int64)
    rows = np.frombuffer(tree["rows"], np.int64).reshape(len(ids), dims)
    ends = np.frombuffer(tree["ends"], np.int64)
    low, high = (np.frombuffer(tree[n], np.int64).reshape(len(ends), dims) for n in ("low", "high"))
    queries = best.queries
    largest = int(max(np.abs(queries).max(initial=0), 1)) * int(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0), 1)) * max(dims, 1)
    # sums stay whole numbers in floats of enough digits, where multiplication is fastest
    kind = np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64
    q, r = queries.astype(kind), rows.astype(kind)
    bounds = np.maximum(q, 0) @ high.astype(kind).T + np.minimum(q, 0) @ low.astype(kind).T
    turn = np.argsort(-bounds, axis=1, kind="stable")
    starts = np.concatenate([[0], ends[:-1]])
    live = np.arange(len(queries))
    for step in range(len(ends)):
        leaf = turn[live, step]
        on = bounds[live, leaf] >= best.least()[live]
        live, leaf = live[on], leaf[on]
        if not len(live):
            break
        grouped = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.diff(leaf[grouped])) + 1
        for some in np.split(grouped, cuts):
            at, number = live[some], int(leaf[some[0]])
            own = slice(int(starts[number]), int(ends[number]))
            scores = (q[at] @ r[own].T).astype(np.int64)
            names = np.broadcast_to(ids[own], scores.shape)
            outside = names == best.ids[at][:, None]
            k = best.k
            if scores.shape[1] > k:
                # of a leaf only scores that reach its k-th can count, and all that tie with it
                hidden = np.where(outside, np.iinfo(np.int64).min, scores)
                floor = np.partition(hidden, -k, axis=1)[:, -k]
                reach = hidden >= np.maximum(floor, best.least()[at])[:, None]
                width = max(1, int(reach.sum(1).max()))
                pick = np.argsort(~reach, axis=1, kind="stable")[:, :width]
                taken = np.take_along_axis(reach & ~outside, pick, 1)
                scores, names = np.take_along_axis(scores, pick, 1), np.take_along_axis(names, pick, 1)
            else:
                taken = ~outside
            best.add(at, scores, np.where(taken, names, _NONE))


def search(trees: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all trees for each query of an (id, v) table: query_id, rank, vec_id, score."""
    spark = trees.sparkSession
    once = materialize(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")
    blocks = max(1, -(-once.count() // QUERY_BLOCK))
    results = []
    for block in range(blocks):
        # about QUERY_BLOCK vectors, whatever the number of queries
        some = once.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()
        by_dims: dict[int, tuple[list[int], list[list[int]]]] = {}
        for row in some:
            own = by_dims.setdefault(len(row["v"]), ([], []))
            own[0].append(row["id"])
            own[1].append(row["v"])
        shared = spark.sparkContext.broadcast({
            d: (np.array(ids, np.int64), np.array(v, np.int64).reshape(len(ids), d)) for d, (ids, v) in by_dims.items()})

        def searched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = {d: Best(ids, v, k) for d, (ids, v) in shared.value.items()}
            for batch in batches:
                for tree in batch.to_pylist():
                    if tree["dims"] in best:
                        visit(tree, best[tree["dims"]])
            for own in best.values():
                row, place = np.nonzero(own.found != _NONE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.ids[row]), pa.array(own.found[row, place]), pa.array(own.scores[row, place])],
                    names=["query_id", "vec_id", "score"])

        results.append(trees.mapInArrow(searched, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (reduce(DataFrame.unionAll, results).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_k(df: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` highest inner products of each row for which ``is_query`` holds, against all other rows."""
    vectors = integer_vectors(df, vec_id, embedding)
    trees = materialize(build(vectors), "kd-trees")
    return search(trees, integer_vectors(df.filter(is_query), vec_id, embedding), k)
