"""Clustered vector index and nearest-neighbour search by inner product.

Vectors have unit length, so the inner product is the cosine. The index is two tables:
``centroids(cell, centroid)`` and ``vectors(id, embedding, cell)``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.functions.vectors import dot, l2_normalize, norm
from nearkin.operators.ranking import RANK_DECIMALS, dense_index, top_k
from nearkin.session import materialize

# Default limit of the cells of the clustering, vectors per cell and cells probed by the approximate search.
MAX_CELLS = 4096
ROWS_PER_CELL = 39
MAX_PROBE = 64
# Beyond that number of cells the approximate search probes this share of them; vectors without clusters need it for a recall of 0.9.
PROBE_SHARE = 0.5
# Cells that the exact search visits first, to learn which others can still matter.
NEAR_CELLS = 4
# Bounds are compared with scores with this much room for rounding.
BOUND_SLACK = 1e-6

# Queries up to this volume are shipped to the tasks that scan the vectors.
BROADCAST_QUERY_BYTES = 32 << 20
BROADCAST_QUERY_ROWS = 4096
# Rows of one side that meet in one scoring group, and rows for each probe from which a query goes to each of its cells.
BLOCK_ROWS = 8192
PROBED_ROWS = 32768
# Cells that one clustering finds; more of them come from clustering once more within each cell, and so many rounds that takes.
ONE_LEVEL_CELLS = MAX_CELLS
INNER_ROUNDS = 10
# Cells up to which the clustering of Spark ML finds them from the start. More start from two levels and settle in rounds over all
# vectors, until no centroid moves by more than this in terms of the cosine.
SEEDED_CELLS = 256
SETTLING_ROUNDS = 10
SETTLED = 1e-4
# Queries and vectors scored by one matrix product.
QUERY_BLOCK = 512
CHUNK_ROWS = 1024
# Shares of the axes after which a bound decides which inner products are finished, the share of the time of a whole product
# in single precision that this may take, and what finishing one pair takes of a pair's part of that time.
PREFIXES = (0.25, 0.5, 0.75)
CUT_SHARE = 0.8
FINISHING = 100
# Share of pairs up to which they are finished one by one after a whole product in single precision.
SPARSE_SHARE = 0.125
# Chunks after which a cut that failed is tried again for the first time.
RETRY_CHUNKS = 16
# Principal axes come from at most this many rows and bytes of vectors; any axes give the same results. Beyond
# ``MAX_AXES`` dimensions vectors are searched along the axes they have.
AXIS_ROWS = 4096
AXIS_BYTES = 16 << 20
MAX_AXES = 2048
# Queries per dimension from which a scan looks for principal axes.
AXES_FROM = 16
# Scores of vectors against all centroids that a task holds at once, and the number of wanted cells up to which they
# are picked one by one instead of sorting all.
SCORE_BYTES = 4 << 20
PICKED_CELLS = 8
# With very many cells so many vectors are scored together, since each such slice reads all centroids.
LEAST_ROWS = 8

# Rows and bytes of a block of vectors that travels as one row, bytes of the vectors that a task holds, and the share of a
# block's vectors below which those that count are picked out.
PAIR_ROWS = 8192
PAIR_BYTES = 4 << 20
HELD_BYTES = 128 << 20
KEPT_SHARE = 0.75
# Stands for a missing id in a block.
NO_ID = -(1 << 63)

HITS = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("question_id", T.LongType()),
    T.StructField("score", T.DoubleType()),
])

HITS_ARROW = pa.schema([("query_id", pa.int64()), ("question_id", pa.int64()), ("score", pa.float64())])


@dataclass(frozen=True)
class VectorIndex:
    centroids: DataFrame
    vectors: DataFrame


def cell_count(n: int) -> int:
    """Cells of the coarse clustering for ``n`` vectors."""
    return min(MAX_CELLS, max(1, n // ROWS_PER_CELL))


def probe_count(n_cells: int) -> int:
    """Cells that the approximate search probes."""
    return max(MAX_PROBE, math.ceil(PROBE_SHARE * n_cells))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def _score_slices(rows: int, cells: int, least: int = 1) -> list[slice]:
    """Cuts a batch so that its scores against all cells take bounded memory, whatever the number of cells beyond ``least`` rows."""
    step = max(least, SCORE_BYTES // (8 * max(1, cells)))
    return [slice(at, at + step) for at in range(0, rows, step)]


def _highest(scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores of every row, highest first, equal ones by place; ``scores`` is used up."""
    if n > PICKED_CELLS or n >= scores.shape[1] or not np.isfinite(scores).all():
        return np.argsort(-scores, axis=1, kind="stable")[:, :n]
    order, row = np.empty((len(scores), n), np.int64), np.arange(len(scores))
    for i in range(n):
        order[:, i] = scores.argmax(axis=1)
        scores[row, order[:, i]] = -np.inf
    return order


def _best_of_block(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int,
                   skipped: np.ndarray | None) -> pd.DataFrame:
    """Best ``k`` of every row of ``scores``, without the id it skips; ``ids`` ascend, so equal scores go to the lower id."""
    scores = np.round(scores, RANK_DECIMALS)
    if skipped is not None:
        scores[skipped[:, None] == ids[None, :]] = -np.inf
    take = min(k, len(ids))
    kth = np.partition(scores, len(ids) - take, axis=1)[:, len(ids) - take, None]
    better, equal = scores > kth, scores == kth
    room = take - better.sum(axis=1, keepdims=True)
    keep = (better | (equal & (np.cumsum(equal, axis=1) <= room))) & np.isfinite(scores)
    rows, columns = np.nonzero(keep)
    return pd.DataFrame({"query_id": query_ids[rows], "question_id": ids[columns], "score": scores[rows, columns]})


class Wanted(NamedTuple):
    """How many vectors a query wants, and the axes along which they are compared."""

    k: int
    axes: np.ndarray | None = None


def principal_axes(vectors: DataFrame) -> np.ndarray | None:
    """An orthogonal matrix whose columns are the directions of ``vectors(id, embedding)``, strongest first.

    Fitted on a bounded sample by hash, since inner products are the same along any axes: they
    only decide how early a bound is sharp. ``None`` without vectors or beyond ``MAX_AXES``.
    """
    head = vectors.select(F.size("embedding").alias("n")).first()
    if head is None or not 0 < head["n"] <= MAX_AXES:
        return None
    rows = max(1, min(AXIS_ROWS, AXIS_BYTES // (8 * head["n"])))
    sample = _matrix(vectors.select("embedding").orderBy(F.xxhash64("id")).limit(rows).toPandas()["embedding"])
    return np.ascontiguousarray(np.linalg.eigh(sample.T @ sample)[1][:, ::-1])


class _Cuts:
    """After which axes the next chunk is cut: an earlier cut while few pairs are left, a later one after a failure.

    Behind the last cut inner products run along all axes. A cut that failed is left alone for some chunks,
    and longer after every failure.
    """

    def __init__(self, width: int) -> None:
        self.cuts = sorted({int(width * share) for share in PREFIXES} - {0})
        self.level, self.lowest, self.age, self.patience = len(self.cuts) // 2, 0, 0, RETRY_CHUNKS

    def next(self) -> int | None:
        self.age += 1
        if self.age > self.patience:
            self.lowest, self.age = max(0, min(self.lowest, self.level) - 1), 0
            self.level = min(self.level, max(0, len(self.cuts) - 1))
        return self.cuts[self.level] if self.level < len(self.cuts) else None

    def learn(self, share: float | None) -> None:
        if share is None:
            self.level, self.lowest, self.age, self.patience = self.level + 1, self.level + 1, 0, 2 * self.patience
        elif share < SPARSE_SHARE / 8 / FINISHING and self.level > self.lowest:
            self.level -= 1


class _Rows:
    """Vectors as they are and, scaled by the longest of them, in single precision along the axes of the search."""

    def __init__(self, ids: np.ndarray, exact: np.ndarray, axes: np.ndarray | None = None) -> None:
        self.ids, self.exact, self.axes = ids, exact, axes
        lengths = np.linalg.norm(exact, axis=1)
        self.longest = float(np.max(lengths, initial=0.0, where=np.isfinite(lengths) & (lengths > 0))) or 1.0
        self.plain = self._turned = None

    def along(self, turned: bool) -> np.ndarray:
        """In single precision; along the axes if they are ``turned``."""
        if turned and self.axes is not None:
            if self._turned is None:
                self._turned = (self.exact.astype("float64") @ (self.axes / self.longest)).astype("float32")
            return self._turned
        if self.plain is None:
            self.plain = (self.exact / self.exact.dtype.type(self.longest)).astype("float32")
        return self.plain


class _Best:
    """The best ``k`` vectors of each query of a block so far; hits wait until there are some to be sorted in."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int, skip_self: bool = False,
                 axes: np.ndarray | None = None, cuts: _Cuts | None = None) -> None:
        self.query_ids, self.queries, self.floors, self.k, self.skip_self, self.axes = query_ids, queries, floors.copy(), k, skip_self, axes
        lengths = np.linalg.norm(queries, axis=1)
        self.lengths = np.where(np.isfinite(lengths) & (lengths > 0), lengths, 1.0)
        self.unit = (queries / self.lengths[:, None]).astype("float32")
        self._turned: np.ndarray | None = None
        self.cuts = cuts or _Cuts(queries.shape[1])
        self.rows, self.found, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.finished = 0

    def _along(self, turned: bool) -> np.ndarray:
        if not turned or self.axes is None:
            return self.unit
        if self._turned is None:
            self._turned = ((self.queries / self.lengths[:, None]) @ self.axes).astype("float32")
        return self._turned

    def _reaching(self, vectors: _Rows, part: slice) -> tuple[np.ndarray, np.ndarray] | None:
        """Pairs whose score can reach the query's floor; ``None`` if too many can.

        Inner products are taken in single precision with room for its rounding, along the axes before a cut: what
        the others add is at most the product of the lengths behind the cut (Cauchy-Schwarz).
        """
        width = self.queries.shape[1]
        limit = (self.floors - BOUND_SLACK) / (self.lengths * vectors.longest) - (width + 8) * 2.0 ** -23
        limit = np.clip(limit, -2.0, 2.0).astype("float32")[:, None]
        cut = self.cuts.next()
        for at in (width,) if cut is None else (cut, width):
            share = SPARSE_SHARE if at == width else (CUT_SHARE - at / width) / FINISHING
            queries, rows = self._along(at < width), vectors.along(at < width)[part]
            if at < width:
                queries, rows = (np.hstack([x[:, :at], np.linalg.norm(x[:, at:], axis=1, keepdims=True)]) for x in (queries, rows))
            reach = (queries @ rows.T >= limit).ravel()
            count = np.count_nonzero(reach)
            enough = count <= share * len(reach)
            if at < width:
                self.cuts.learn(count / len(reach) if enough else None)
            if enough:
                return np.divmod(np.flatnonzero(reach), len(rows))
        return None

    def meet(self, vectors: _Rows, part: slice, cells: np.ndarray | None = None, probed: np.ndarray | None = None) -> None:
        """Meet a chunk of vectors; ``probed`` tells for each query and each of the vectors' ``cells`` whether they count."""
        ids, exact = vectors.ids[part], vectors.exact[part]
        reached = self._reaching(vectors, part) if np.isfinite(self.floors).all() else None
        if reached is None:
            self.finished += len(self.queries) * len(ids)
            scores = self.queries @ exact.T.astype("float64")
            if self.skip_self:
                scores[self.query_ids[:, None] == ids[None, :]] = -np.inf
            if probed is not None:
                scores[~probed[:, cells[part]]] = -np.inf
            block = _best_of_block(np.arange(len(self.queries)), np.arange(len(ids)), scores, self.k, None)
            rows, places, scores = (block[c].to_numpy() for c in ("query_id", "question_id", "score"))
            keep = scores >= self.floors[rows]
        else:
            rows, places = reached
            self.finished += len(rows)
            scores = np.empty(len(rows))
            for at in range(0, len(rows), CHUNK_ROWS):
                some = slice(at, at + CHUNK_ROWS)
                scores[some] = np.einsum("ij,ij->i", self.queries[rows[some]], exact[places[some]].astype("float64"))
            scores = np.round(scores, RANK_DECIMALS)
            keep = (scores >= self.floors[rows]) & np.isfinite(scores)
            if self.skip_self:
                keep &= self.query_ids[rows] != ids[places]
            if probed is not None:
                keep &= probed[rows, cells[part][places]]
        self.waiting.append((rows[keep], ids[places[keep]], scores[keep]))
        if 4 * sum(len(w[0]) for w in self.waiting) >= len(self.queries) * self.k:
            self.sort()

    def sort(self) -> None:
        """Sort the waiting hits in and raise the floors."""
        rows, found, scores = (np.concatenate(p) for p in zip((self.rows, self.found, self.scores), *self.waiting))
        self.waiting.clear()
        order = np.lexsort((found, -scores, rows))
        rows, found, scores = rows[order], found[order], scores[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        self.rows, self.found, self.scores = (x[place < self.k] for x in (rows, found, scores))
        last = place == self.k - 1
        self.floors[rows[last]] = np.maximum(self.floors[rows[last]], scores[last])

    def hits(self) -> pd.DataFrame:
        self.sort()
        return pd.DataFrame({"query_id": self.query_ids[self.rows], "question_id": self.found, "score": self.scores})


def best_in_chunks(query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                   k: int, skip_self: bool = False) -> tuple[pd.DataFrame, int]:
    """Best ``k`` vectors per query among those that reach its floor, and the inner products finished for it.

    ``ids`` ascend. Vectors are met chunk by chunk; the k-th score so far raises the floor for
    the chunks behind.
    """
    best, rows = _Best(query_ids, queries, floors, k, skip_self), _Rows(ids, vectors)
    for at in range(0, len(ids), CHUNK_ROWS):
        best.meet(rows, slice(at, at + CHUNK_ROWS))
    return best.hits(), best.finished


def _best_per_query(query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, vectors: pd.DataFrame, wanted: Wanted,
                    skip_self: bool) -> pd.DataFrame:
    """Best rows of a batch of vectors for each query, scored in blocks of queries."""
    ordered = vectors.sort_values("question_id")
    ids, rows = ordered["question_id"].to_numpy(), _matrix(ordered["embedding"])
    # turning the vectors pays only where enough queries meet them
    if wanted.axes is not None and len(queries) >= queries.shape[1] == len(wanted.axes):
        queries, rows = queries @ wanted.axes, rows @ wanted.axes
    blocks = [slice(at, at + QUERY_BLOCK) for at in range(0, len(query_ids), QUERY_BLOCK)]
    return pd.concat([
        best_in_chunks(query_ids[b], queries[b], floors[b], ids, rows, wanted.k, skip_self)[0] for b in blocks])


def _scan_with(queries: pd.DataFrame, wanted: Wanted, skip_self: bool):
    """Scan of vector batches against a few queries, keeping the best of each per task."""
    query_ids = queries["query_id"].to_numpy()
    matrix = _matrix(queries["query_embedding"])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best, floors = None, pd.Series(-np.inf, pd.Index(query_ids).unique())
        for batch in batches:
            if batch.empty:
                continue
            found = _best_per_query(query_ids, matrix, floors.reindex(query_ids).to_numpy(), batch, wanted, skip_self)
            both = found if best is None else pd.concat([best, found])
            order = np.lexsort((both["question_id"], -both["score"], both["query_id"]))
            both = both.iloc[order]
            place = both.groupby("query_id").cumcount()
            best = both[place < wanted.k]
            last = both[place == wanted.k - 1]
            floors[last["query_id"].to_numpy()] = last["score"].to_numpy()
        if best is not None:
            yield best

    return scan


def _score_group(wanted: Wanted):
    def score(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or vectors.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "question_id": pd.Series(dtype="int64"),
                                 "score": pd.Series(dtype="float64")})
        floors = queries["floor"].to_numpy() if "floor" in queries else np.full(len(queries), -np.inf)
        return _best_per_query(
            queries["query_id"].to_numpy(), _matrix(queries["query_embedding"]), floors, vectors, wanted, skip_self=False)

    return score


def _first_similar(threshold: float):
    """For each query of a group the first row before it that is similar enough."""
    def first(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "place": pd.Series(dtype="int64"),
                              "question_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if queries.empty or vectors.empty:
            return empty
        ordered = vectors.sort_values(["place", "question_id"])
        places, ids, right = ordered["place"].to_numpy(), ordered["question_id"].to_numpy(), _matrix(ordered["embedding"]).T
        found = [empty]
        for at in range(0, len(queries), QUERY_BLOCK):
            some = queries.iloc[at:at + QUERY_BLOCK]
            scores = np.round(_matrix(some["query_embedding"]) @ right, RANK_DECIMALS)
            own, own_ids = some["query_place"].to_numpy()[:, None], some["query_id"].to_numpy()[:, None]
            earlier = (places < own) | ((places == own) & (ids < own_ids))
            match = (scores >= threshold) & earlier
            rows = np.flatnonzero(match.any(axis=1))
            best = match[rows].argmax(axis=1)
            found.append(pd.DataFrame({
                "query_id": own_ids[rows, 0], "place": places[best], "question_id": ids[best], "score": scores[rows, best]}))
        return pd.concat(found)

    return first


def _blocks_per_cell(df: DataFrame, key: str, out: str, rows: int) -> DataFrame:
    """Blocks into which the rows of each cell are cut: one row per cell."""
    return df.groupBy("cell").agg(F.ceil(F.count(key) / F.lit(rows)).cast("int").alias(out))


def _per_cell(probes: DataFrame, vectors: DataFrame, scorer, schema: T.StructType, rows: int | None = None) -> DataFrame:
    """Score ``probes(query_id, query_embedding, cell, ..)`` against ``vectors(question_id, embedding, cell, ..)``.

    A cell is cut into blocks of bounded size on both sides and every pair of blocks of one
    cell is one group, so a cell holding a third of all rows becomes many small groups. Each
    group yields what ``scorer`` keeps of it, never all its pairs.
    """
    cells = _blocks_per_cell(vectors, "question_id", "v_blocks", rows or BLOCK_ROWS).join(
        _blocks_per_cell(probes, "query_id", "q_blocks", rows or BLOCK_ROWS), "cell")
    # one row per cell
    cells = F.broadcast(cells)
    left = (
        probes.join(cells, "cell")
        .withColumn("q_block", F.pmod(F.xxhash64("query_id"), F.col("q_blocks")).cast("int"))
        .withColumn("v_block", F.explode(F.sequence(F.lit(0), F.col("v_blocks") - 1)))
        .drop("q_blocks", "v_blocks")
    )
    right = (
        vectors.join(cells, "cell")
        .withColumn("v_block", F.pmod(F.xxhash64("question_id"), F.col("v_blocks")).cast("int"))
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
        .drop("q_blocks", "v_blocks")
    )
    keys = ["cell", "q_block", "v_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(scorer, schema)


def _score_cells(probes: DataFrame, vectors: DataFrame, wanted: Wanted) -> DataFrame:
    """Best vectors per query of every group of a cell; a column ``floor`` of the probes leaves out lower scores."""
    return _per_cell(probes, vectors, _score_group(wanted), HITS)


def _few_queries(queries: DataFrame) -> pd.DataFrame | None:
    """The queries themselves if they are proven small, else ``None``."""
    head = queries.select("query_id", "query_embedding").limit(BROADCAST_QUERY_ROWS + 1)
    size = head.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("query_embedding")), F.lit(0)).alias("numbers")).first()
    if size["rows"] > BROADCAST_QUERY_ROWS or 8 * size["numbers"] > BROADCAST_QUERY_BYTES:
        return None
    return head.toPandas()


def _fold_copies(queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(distinct queries, members)``: one row per different vector, and which query it stands for.

    Copies of a query find the same rows, so a group of copies is searched once however large
    it is. Vectors are compared by two independent 64-bit hashes; only ids and hashes move.
    """
    keyed = queries.select(
        "query_id", F.xxhash64("query_embedding").alias("_h1"), F.xxhash64(F.lit(1), "query_embedding").alias("_h2"))
    first = keyed.groupBy("_h1", "_h2").agg(F.min("query_id").alias("first_id"))
    members = materialize(keyed.join(first, ["_h1", "_h2"]).select("query_id", "first_id"), "members")
    kept = members.filter(F.col("query_id") == F.col("first_id")).select("query_id")
    return queries.join(kept, "query_id", "left_semi").select("query_id", "query_embedding"), members


def _hand_out(ranked: DataFrame, members: DataFrame, k: int, skip_self: bool) -> DataFrame:
    """Give the results of every distinct query to all its copies."""
    rows = members.join(ranked.withColumnRenamed("query_id", "first_id"), "first_id").drop("first_id")
    if skip_self:
        # at most k + 1 rows per query
        order = Window.partitionBy("query_id").orderBy("rank")
        rows = rows.filter(F.col("question_id") != F.col("query_id")).withColumn("rank", F.row_number().over(order))
    return rows.filter(F.col("rank") <= k).select("query_id", "rank", "question_id", "score")


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    return top_k(hits, ["query_id"], "score", k, ["question_id"]).select(
        "query_id", "rank", "question_id", F.round("score", 4).alias("score"))


def knn_exact(queries: DataFrame, vectors: DataFrame, k: int = 10, skip_self: bool = False) -> DataFrame:
    """Exact best ``k`` vectors per query: ``query_id, rank, question_id, score``.

    ``queries(query_id, query_embedding)``, ``vectors(id, embedding)``. A proven-small query
    table travels to the vectors, which then are neither shuffled nor replicated. Otherwise
    the vectors are clustered and searched cell by cell.
    """
    few = _few_queries(queries)
    if few is not None:
        return _scan_few(few, vectors, k, skip_self)
    return knn_by_bounds(queries, build_vector_index(vectors), k, skip_self)


def _scan_few(few: pd.DataFrame, vectors: DataFrame, k: int, skip_self: bool) -> DataFrame:
    named = vectors.select(F.col("id").alias("question_id"), "embedding")
    if few.empty:
        return _ranked(vectors.sparkSession.createDataFrame([], HITS), k)
    return _ranked(named.mapInPandas(_scan_with(few, Wanted(k, _axes_for(few, vectors)), skip_self), HITS), k)


def _axes_for(queries: pd.DataFrame, vectors: DataFrame) -> np.ndarray | None:
    """Principal axes where there are enough queries to make finding them worth a job."""
    return principal_axes(vectors) if len(queries) >= AXES_FROM * len(queries["query_embedding"].iloc[0]) else None


def cell_bounds(index: VectorIndex) -> DataFrame:
    """``cell, centroid, radius, rows``: how far the vectors of a cell are from its centroid at most, and their number."""
    away = F.sqrt(F.aggregate(
        F.zip_with("embedding", "centroid", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, x: total + x))
    # one centroid per cell
    placed = index.vectors.join(F.broadcast(index.centroids), "cell")
    return index.centroids.join(placed.groupBy("cell").agg(F.max(away).alias("radius"), F.count("*").alias("rows")), "cell")


def cell_packs(bounds: pd.DataFrame) -> np.ndarray:
    """A pack for each cell: neighbours in the table that hold about ``BLOCK_ROWS`` vectors together."""
    return ((bounds["rows"].cumsum() - bounds["rows"]) // BLOCK_ROWS).to_numpy().astype("int64")


def probes_by_bounds(queries: DataFrame, bounds: pd.DataFrame, floor: str, skip: str | None = None) -> DataFrame:
    """Add ``cells``: those whose best possible score reaches the ``floor`` of a query.

    The score of a vector of a cell is at most that of the centroid plus the length of the
    query times the radius of the cell. ``skip`` names an array of cells to leave out. A query
    that needs more cells than there are packs gets the packs of those cells instead, as
    negative numbers, so that it is never copied more often than there are blocks of vectors.
    """
    numbers, matrix, radii = bounds["cell"].to_numpy(), _matrix(bounds["centroid"]), bounds["radius"].to_numpy()
    packs = cell_packs(bounds)
    n_packs = len(set(packs.tolist()))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def reachable(vectors: pd.Series, floors: pd.Series, left_out: pd.Series) -> pd.Series:
        rows, found = _matrix(vectors), []
        for some in _score_slices(len(rows), len(numbers)):
            best = rows[some] @ matrix.T
            best += np.linalg.norm(rows[some], axis=1)[:, None] * radii[None, :]
            for b, f, o in zip(best, floors.to_numpy()[some], left_out.iloc[some]):
                wanted = (b >= f - BOUND_SLACK) & ~np.isin(numbers, o)
                found.append(sorted({-1 - int(p) for p in packs[wanted]}) if wanted.sum() > n_packs else numbers[wanted].tolist())
        return pd.Series(found)

    none = F.array().cast("array<int>")
    return queries.withColumn("cells", reachable("query_embedding", floor, F.col(skip) if skip else none))


def with_packs(vectors: DataFrame, bounds: pd.DataFrame) -> DataFrame:
    """``vectors`` by cell and, once more, by pack."""
    rows = list(zip(bounds["cell"].tolist(), (-1 - cell_packs(bounds)).tolist()))
    packs = vectors.sparkSession.createDataFrame(rows, "cell int, pack int")
    # one row per cell
    packed = vectors.join(F.broadcast(packs), "cell").drop("cell").withColumnRenamed("pack", "cell")
    return vectors.unionByName(packed)


def knn_by_bounds(queries: DataFrame, index: VectorIndex, k: int = 10, skip_self: bool = False,
                  near: int = NEAR_CELLS) -> DataFrame:
    """Exact best ``k`` per query from the cells that can hold them.

    The nearest cells are searched first. The k-th score found there is a floor, and of the
    other cells only those are compared whose bound reaches it: the score of a vector of a cell is at most
    that of the centroid plus the length of the query times the radius of the cell. Queries and vectors
    meet block by block (``_meet_blocks``).
    """
    distinct, members = _fold_copies(queries)
    wanted = k + 1 if skip_self else k
    named = index.vectors.select(F.col("id").alias("question_id"), "embedding", "cell")
    best = Wanted(wanted, principal_axes(index.vectors))
    located = materialize(nearest_cells(distinct, "query_embedding", index.centroids, near), "near-cells")
    first = materialize(_ranked_raw(_score_cells(
        located.select("query_id", "query_embedding", F.explode("cells").alias("cell")), named, best), wanted), "near-hits")
    floors = first.filter(F.col("rank") == wanted).select("query_id", F.col("score").alias("floor"))
    open_ = located.join(floors, "query_id", "left").select(
        F.col("query_id").alias("id"), F.col("query_embedding").alias("embedding"),
        F.coalesce("floor", F.lit(float("-inf"))).alias("floor"), F.get("cells", F.lit(0)).alias("near"))
    bounds = cell_bounds(index).orderBy("cell").toPandas()
    numbers, matrix, radii = bounds["cell"].to_numpy(), _matrix(bounds["centroid"]), bounds["radius"].to_numpy()

    def reachable(asked: _Best, cells: np.ndarray, own: dict[str, np.ndarray], block: dict[str, np.ndarray]) -> tuple[np.ndarray, None]:
        places = np.searchsorted(numbers, cells)
        most = asked.queries @ matrix[places].T + np.linalg.norm(asked.queries, axis=1)[:, None] * radii[places]
        return (most >= asked.floors[:, None] - BOUND_SLACK).any(axis=0), None

    second = _meet_blocks(
        _packed(open_, ["floor"], "near", located.count()), _packed(index.vectors.select("id", "embedding", "cell"), ["cell"], "cell", int(bounds["rows"].sum())),
        best, reachable, matrix.shape[1])
    # what the nearest cells hold is met once more
    hits = first.drop("rank").unionByName(second).groupBy("query_id", "question_id").agg(F.max("score").alias("score"))
    return _hand_out(_ranked(hits, wanted), members, k, skip_self)


class Packed(NamedTuple):
    """Rows packed into blocks, the type of their numbers, and how many rows there are."""

    blocks: DataFrame
    kind: str
    rows: int


def _packed(rows: DataFrame, extras: list[str], order: str, n_rows: int) -> Packed:
    """Blocks of ``rows(id, embedding, ..)``: one row each, with the ids, the vectors and the ``extras`` as bytes.

    Blocks are made of rows that are next to each other in their partition ordered by ``order``; nothing is shuffled for it.
    Of a ``centroid`` each cell of a block gets one, in the order of the cells.
    """
    centered = "centroid" in rows.columns
    names = ["ids", "vectors", *extras, *["centers"] * centered]
    kind = "f4" if isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType) else "f8"
    kinds = {c: "f8" if isinstance(rows.schema[c].dataType, T.DoubleType) else "i4" for c in extras}

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flushed(columns: list[np.ndarray]) -> pa.RecordBatch:
            # ids ascend, so equal scores go to the lower id
            by_id = np.argsort(columns[0], kind="stable")
            columns = [c[by_id] for c in columns]
            if centered:
                columns[-1] = columns[-1][np.unique(columns[names.index("cell")], return_index=True)[1]]
            return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(1)
            widths = np.diff(vectors.offsets.to_numpy())
            if vectors.null_count or (widths != (held[0][1].shape[1] if held else widths[0])).any():
                raise ValueError("vectors of unequal length")
            matrix = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(batch.num_rows, -1)
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("i8")
            held.append([ids, matrix, *(batch.column(2 + i).to_numpy(zero_copy_only=False).astype(kinds[c]) for i, c in enumerate(extras))])
            if centered:
                held[-1].append(batch.column(len(names) - 1).flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(batch.num_rows, -1))
            size = max(1, min(PAIR_ROWS, PAIR_BYTES // max(1, matrix.itemsize * matrix.shape[1])))
            while sum(len(h[0]) for h in held) >= size:
                whole = [np.concatenate(c) for c in zip(*held)]
                yield flushed([c[:size] for c in whole])
                held = [[c[size:] for c in whole]] if len(whole[0]) > size else []
        if held:
            yield flushed([np.concatenate(c) for c in zip(*held)])

    # small partitions would make small blocks
    parts = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // PAIR_ROWS))
    placed = rows.coalesce(parts).sortWithinPartitions(order, "id").select("id", "embedding", *extras, *["centroid"] * centered)
    return Packed(placed.mapInArrow(packed, ", ".join(f"{c} binary" for c in names)), kind, n_rows)


def _meet_blocks(asked: Packed, vectors: Packed, wanted: Wanted, which, width: int) -> DataFrame:
    """Hits of every block of queries in every block of vectors; vectors need their ``cell``.

    Both sides are dealt to parts, and each pair of parts is a task. A task holds the vectors of its part, as many as ``HELD_BYTES``
    allow, and takes one block of queries after another; the k-th score of a query rises from block to block. So a query is copied
    once for each such part, and not for each block that it meets. ``which`` tells for a block of queries which cells
    count for any of them, and which for each where that is less.
    """
    spark = asked.blocks.sparkSession
    cores = spark.sparkContext.defaultParallelism
    # vectors that a task holds are of bounded size; tables that fit make two tasks a core with few copies of either side
    held = max(-(-vectors.rows * width * int(vectors.kind[1]) // HELD_BYTES), math.ceil(math.sqrt(2 * cores)))
    passed = max(1, -(-2 * cores // held))
    extras = asked.blocks.columns[2:]
    keys = F.array(*[F.lit(x) for x in _even_keys(spark, held * passed)])

    def dealt(blocks: DataFrame, side: str, parts: int, copies: int) -> DataFrame:
        """Blocks in ``parts`` by their number in the partition and that of the partition, for each part of the other side."""
        number = F.monotonically_increasing_id()
        own = F.pmod(F.shiftright(number, 33) + number.bitwiseAND((1 << 33) - 1), F.lit(parts)).cast("int")
        numbered = blocks.select(own.alias("_own"), *[F.col(c).alias(f"{side}_{c}") for c in blocks.columns])
        other = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        at = F.col("_own") * passed + F.col("_other") if side == "v" else F.col("_other") * passed + F.col("_own")
        return numbered.withColumn("_other", other).withColumn("_key", F.get(keys, at)).drop("_own", "_other").repartition(held * passed, "_key")

    left, right = dealt(asked.blocks, "q", passed, held), dealt(vectors.blocks, "v", held, passed)
    axes, kinds = wanted.axes, {"q_ids": "i8", "v_ids": "i8", "q_vectors": asked.kind, "v_vectors": vectors.kind, "q_last": "i4", "v_cell": "i4", "v_centers": "f8"}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blocks, cuts = None, [], {}

        def hits() -> Iterator[pa.RecordBatch]:
            for best, _ in blocks:
                yield pa.RecordBatch.from_pandas(best.hits(), schema=HITS_ARROW, preserve_index=False)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: np.frombuffer(batch.column(j)[i].as_buffer(), kinds.get(c, "f8")) for j, c in enumerate(batch.schema.names)}
                if current is None or not np.array_equal(row["q_ids"], current):
                    yield from hits()
                    current = row["q_ids"].copy()
                    queries = row["q_vectors"].reshape(len(current), -1).astype("float64")
                    floors = row.get("q_floor", np.full(len(current), -np.inf))
                    # queries with like floors are decided after like numbers of axes
                    by_floor, blocks = np.argsort(-floors, kind="stable"), []
                    for at in range(0, len(current), QUERY_BLOCK):
                        some = by_floor[at:at + QUERY_BLOCK]
                        cut = cuts.setdefault(at, _Cuts(queries.shape[1]))
                        blocks.append((_Best(current[some], queries[some], floors[some], wanted.k, axes=axes, cuts=cut), {c: row[f"q_{c}"][some] for c in extras}))
                _meet_block(blocks, _Rows(row["v_ids"], row["v_vectors"].reshape(len(row["v_ids"]), -1), axes), row, which)
        yield from hits()

    met = left.join(right.hint("shuffle_hash"), "_key").drop("_key").mapInArrow(scan, HITS)
    return met.withColumn("question_id", F.nullif("question_id", F.lit(NO_ID)))


def _even_keys(spark, n: int) -> list[int]:
    """A key for each of ``n`` partitions by hash, so that each of them gets one."""
    found = spark.range(64 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("part")).agg(F.min("id").alias("key"))
    keys = {r["part"]: r["key"] for r in found.collect()}
    return [keys.get(part, 64 * n + part) for part in range(n)]


def _meet_block(blocks: list[tuple[_Best, dict[str, np.ndarray]]], vectors: _Rows, block: dict[str, np.ndarray], which) -> None:
    """Let blocks of queries meet the vectors of the cells that count for them."""
    cells, of = np.unique(block["v_cell"], return_inverse=True)
    for best, own in blocks:
        wanted, probed = which(best, cells, own, block)
        inside, met = np.flatnonzero(wanted[of]), vectors
        if len(inside) < KEPT_SHARE * len(of):
            # the others cost more than leaving them out
            met, places = _Rows(vectors.ids[inside], vectors.exact[inside], vectors.axes), of[inside]
        else:
            places = of
        for at in range(0, len(met.ids), CHUNK_ROWS):
            best.meet(met, slice(at, at + CHUNK_ROWS), places, probed)


def _ranked_raw(hits: DataFrame, k: int) -> DataFrame:
    return top_k(hits, ["query_id"], "score", k, ["question_id"]).select("query_id", "question_id", "score", "rank")


def first_similar(queries: DataFrame, log: DataFrame, threshold: float) -> DataFrame:
    """Link each query to the first earlier one of a log that is similar enough.

    Both tables hold ``query_id, query_embedding, place``; ``place`` is a whole number that
    orders the log, ids break its ties, and a query may be part of the log. Output ``query_id, matched_query_id, similarity`` with nulls where
    there is none. Only cells whose bound reaches the threshold are visited, and a group yields
    one row per query at most.
    """
    index = build_vector_index(log.select(F.col("query_id").alias("id"), F.col("query_embedding").alias("embedding"), "place"))
    bounds = cell_bounds(index).orderBy("cell").toPandas()
    probes = materialize(probes_by_bounds(
        queries.select("query_id", "query_embedding", F.col("place").alias("query_place")).withColumn("floor", F.lit(float(threshold))),
        bounds, "floor").drop("floor"), "reuse-cells")
    stored = index.vectors.select(F.col("id").alias("question_id"), "embedding", "place", "cell")
    hits = _per_cell(
        probes.withColumn("cell", F.explode("cells")).drop("cells"), with_packs(stored, bounds), _first_similar(threshold),
        T.StructType([HITS["query_id"], T.StructField("place", T.LongType()), HITS["question_id"], HITS["score"]]))
    best = hits.groupBy("query_id").agg(F.min(F.struct("place", "question_id", "score")).alias("m"))
    return queries.select("query_id").join(best, "query_id", "left").select(
        "query_id", F.col("m.question_id").alias("matched_query_id"), F.col("m.score").alias("similarity"))


def build_vector_index(vectors: DataFrame, cells: int | None = None, seed: int = 42) -> VectorIndex:
    """Cluster ``vectors(id, embedding)`` spherically and assign every vector to a cell.

    The clustering is fitted on all rows that have a direction. Further columns stay with their vectors.
    """
    n = vectors.count()
    wanted = cells or cell_count(n)
    assembled = vectors.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    directed = assembled.filter(norm(F.col("embedding")) > 0)
    if wanted == 1 or directed.isEmpty():
        centroid = corpus_centroid(vectors).select(F.lit(0).alias("cell"), F.col("centroid"))
        return VectorIndex(centroid, vectors.withColumn("cell", F.lit(0)))
    outer = wanted if wanted <= min(ONE_LEVEL_CELLS, SEEDED_CELLS) else min(ONE_LEVEL_CELLS, math.ceil(math.sqrt(wanted)))
    model = KMeans(k=outer, distanceMeasure="cosine", maxIter=10, seed=seed,
                   featuresCol="features", predictionCol="cell").fit(directed.select("features"))
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    centroids = vectors.sparkSession.createDataFrame(
        centers, T.StructType([T.StructField("cell", T.IntegerType()),
                               T.StructField("centroid", T.ArrayType(T.DoubleType()))]))
    # a vector of length zero has no direction: it goes where the first centroid goes
    first = F.array(*[F.lit(x) for x in centers[0][1]])
    placed = assembled.withColumn("features", F.when(norm(F.col("embedding")) > 0, F.col("features")).otherwise(array_to_vector(first)))
    stored = materialize(model.transform(placed).drop("features"), "vectors")
    if outer == wanted:
        return VectorIndex(centroids, stored)
    split = _split_cells(stored, wanted / n)
    return split if wanted > ONE_LEVEL_CELLS else _settled(split)


def inner_cells(vectors: np.ndarray, wanted: int) -> np.ndarray:
    """The cell of each vector, from 0 without gaps: spherical k-means over the different directions, at most ``wanted``."""
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    units = np.round(vectors / np.where(lengths > 0, lengths, 1.0), RANK_DECIMALS)
    different, of = np.unique(units, axis=0, return_inverse=True)
    # copies weigh as much as they are
    weights = np.bincount(of.ravel(), minlength=len(different)).astype("float64")[:, None]
    if wanted >= len(different):
        return of.ravel()
    centers = different[np.random.default_rng(len(different)).permutation(len(different))[:wanted]]
    for _ in range(INNER_ROUNDS):
        nearest = np.concatenate([(different[s] @ centers.T).argmax(axis=1) for s in _score_slices(len(different), wanted)])
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, different * weights)
        away = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(away > 0, sums / np.where(away > 0, away, 1.0), centers)
    return np.unique(nearest, return_inverse=True)[1].ravel()[of.ravel()]


def _split_cells(vectors: DataFrame, share: float) -> VectorIndex:
    """Cut each cell of ``vectors(.., embedding, cell)`` into ``share`` times as many cells as it has rows.

    A cell of very many rows is first cut into blocks of bounded size.
    """
    # one row per cell
    blocks = F.broadcast(_blocks_per_cell(vectors.withColumn("_row", F.lit(1)), "_row", "_blocks", BLOCK_ROWS))
    dealt = vectors.join(blocks, "cell").withColumn("_block", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")).drop("_blocks")

    def split(rows: pa.Table) -> pa.Table:
        matrix = _matrix(rows.column("embedding").to_pandas())
        inner = inner_cells(matrix, max(1, round(share * len(matrix))))
        return rows.append_column("_inner", pa.array(inner, pa.int32()))

    own = ["cell", "_block", "_inner"]
    # one row per dealt column, in the order of the table that the groups get
    schema = T.StructType([*dealt.schema.fields, T.StructField("_inner", T.IntegerType())])
    inside = materialize(dealt.groupBy("cell", "_block").applyInArrow(split, schema), "inner-cells")
    unit = array_to_vector(l2_normalize(F.col("embedding").cast("array<double>")))
    means = inside.filter(norm(F.col("embedding")) > 0).groupBy(*own).agg(vector_to_array(Summarizer.mean(unit)).alias("mean"))
    width = inside.select(F.size("embedding").alias("n")).first()["n"]
    # a cell without any direction has none either
    centers = inside.select(*own).distinct().join(means, own, "left").select(
        *own, F.coalesce(l2_normalize(F.col("mean")), F.array_repeat(F.lit(0.0), width)).alias("centroid"))
    numbered = materialize(dense_index(centers, own, "_number").withColumn("_number", F.col("_number").cast("int")), "centroids")
    # one row per cell
    named = inside.join(F.broadcast(numbered.select(*own, "_number")), own).drop(*own).withColumnRenamed("_number", "cell")
    return VectorIndex(numbered.select(F.col("_number").alias("cell"), "centroid"), materialize(named, "vectors"))


def _settled(index: VectorIndex) -> VectorIndex:
    """Rounds of spherical k-means over all vectors and all cells, from the centroids of ``index``.

    A task adds up the directions of the vectors of each cell; sums of a cell meet by its number. Cells that lose
    all their vectors keep their centroid.
    """
    spark, columns = index.vectors.sparkSession, index.vectors.drop("cell").columns
    numbers, matrix = _centroid_table(index.centroids)
    rows = index.vectors.select("embedding").coalesce(2 * spark.sparkContext.defaultParallelism)
    for _ in range(SETTLING_ROUNDS):
        sums = rows.mapInArrow(_cell_sums(matrix), "place int, total binary").repartition("place").mapInArrow(_added, "place int, total binary").toPandas()
        moved = matrix.copy()
        moved[sums["place"]] = np.stack([np.frombuffer(t) for t in sums["total"]])
        lengths = np.linalg.norm(moved, axis=1, keepdims=True)
        moved = np.where(lengths > 0, moved / np.where(lengths > 0, lengths, 1.0), matrix)
        farthest = 1.0 - (moved * matrix).sum(axis=1)[sums["place"]].min(initial=1.0)
        matrix = moved
        if farthest <= SETTLED:
            break
    centroids = spark.createDataFrame(
        [(int(n), c.tolist()) for n, c in zip(numbers, matrix)], "cell int, centroid array<double>")
    return VectorIndex(centroids, materialize(assign_cells(index.vectors.select(*columns), centroids), "vectors"))


def _cell_sums(matrix: np.ndarray):
    """Sums of the directions of a task's vectors by the place of the nearest centroid."""
    narrow = np.ascontiguousarray(matrix.T.astype("float32"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, met = np.zeros_like(matrix), np.zeros(len(matrix), bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(0).to_pandas())
            lengths = np.linalg.norm(rows, axis=1, keepdims=True)
            rows = (rows / np.where(lengths > 0, lengths, 1.0))[lengths[:, 0] > 0]
            for some in _score_slices(len(rows), len(matrix)):
                nearest = (rows[some].astype("float32") @ narrow).argmax(axis=1)
                order = np.argsort(nearest, kind="stable")
                places, starts = np.unique(nearest[order], return_index=True)
                total[places] += np.add.reduceat(rows[some][order], starts)
                met[places] = True
        places = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int32()), pa.array([total[p].tobytes() for p in places], pa.binary())], names=["place", "total"])

    return summed


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The totals of each place of a task added up."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for place, total in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            totals[place] = totals.get(place, 0.0) + np.frombuffer(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["place", "total"])


def nearest_cells(df: DataFrame, embedding_col: str, centroids: DataFrame, probe: int) -> DataFrame:
    """Add ``cells``, the ``probe`` nearest cells of each vector, nearest first.

    The centroids, one row per cell, are shipped to the tasks.
    """
    table = centroids.orderBy("cell").toPandas()
    numbers, matrix = table["cell"].to_numpy(), _matrix(table["centroid"])

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def nearest(vectors: pd.Series) -> pd.Series:
        rows, found = _matrix(vectors), []
        for some in _score_slices(len(rows), len(numbers)):
            order = _highest(np.round(rows[some] @ matrix.T, RANK_DECIMALS), probe)
            found.extend(numbers[order].astype("int32"))
        return pd.Series(found)

    return df.withColumn("cells", nearest(F.col(embedding_col)))


def assign_cells(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """Put new vectors into the existing cells."""
    return nearest_cells(vectors, "embedding", centroids, 1).withColumn("cell", F.get("cells", F.lit(0))).drop("cells")


def knn_clustered(queries: DataFrame, index: VectorIndex, k: int = 10, probe: int | None = None,
                  skip_self: bool = False) -> DataFrame:
    """Best ``k`` vectors per query, exact unless ``probe`` limits the search to that many nearest cells."""
    width = probe if probe and probe < index.centroids.count() else None
    if width is None:
        few = _few_queries(queries)
        if few is not None:
            return _scan_few(few, index.vectors, k, skip_self)
        return knn_by_bounds(queries, index, k, skip_self)
    distinct, members = _fold_copies(queries)
    wanted = k + 1 if skip_self else k
    n_vectors = index.vectors.count()
    if width > n_vectors // PROBED_ROWS + 1:
        return _hand_out(_ranked(_score_probed(distinct, index, n_vectors, wanted, width), wanted), members, k, skip_self)
    # stored once: the cells of the queries are counted first and joined afterwards
    located = materialize(nearest_cells(distinct, "query_embedding", index.centroids, width), "probes")
    probes = located.select("query_id", "query_embedding", F.explode("cells").alias("cell"))
    named = index.vectors.select(F.col("id").alias("question_id"), "embedding", "cell")
    return _hand_out(_ranked(_score_cells(probes, named, Wanted(wanted)), wanted), members, k, skip_self)


def _last_probed(scores: np.ndarray, probe: int) -> tuple[np.ndarray, np.ndarray]:
    """Score and place of the last of the ``probe`` nearest cells of every row; equal scores go by place."""
    floor = np.partition(scores, scores.shape[1] - probe, axis=1)[:, scores.shape[1] - probe]
    room = probe - (scores > floor[:, None]).sum(axis=1)
    equal = np.cumsum(scores == floor[:, None], axis=1, dtype=np.int32)
    return floor, (equal >= room[:, None]).argmax(axis=1)


def _score_probed(queries: DataFrame, index: VectorIndex, n_vectors: int, k: int, probe: int) -> DataFrame:
    """Best ``k`` vectors of the ``probe`` nearest cells, for many probes.

    A query does not go to each of its cells. It takes along the score and the place of its last cell, and in each block of vectors that
    it meets (``_meet_blocks``) the cells before that one are its cells. The blocks hold the centroids of their cells.
    """
    numbers, matrix = _centroid_table(index.centroids)

    @F.pandas_udf(T.StructType([T.StructField("edge", T.DoubleType()), T.StructField("last", T.IntegerType())]))
    def last(vectors: pd.Series) -> pd.DataFrame:
        rows = _matrix(vectors)
        found = [_last_probed(np.round(rows[s] @ matrix.T, RANK_DECIMALS), probe) for s in _score_slices(len(rows), len(numbers), LEAST_ROWS)]
        return pd.DataFrame({"edge": np.concatenate([f[0] for f in found]), "last": numbers[np.concatenate([f[1] for f in found])]})

    def probed(asked: _Best, cells: np.ndarray, own: dict[str, np.ndarray], block: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        centers, edge, end = block["v_centers"].reshape(len(cells), -1), own["edge"][:, None], own["last"][:, None]
        near = np.round(asked.queries @ centers.T, RANK_DECIMALS)
        inside = (near > edge) | ((near == edge) & (cells <= end))
        return inside.any(axis=0), inside

    located = materialize(queries.withColumn("at", last("query_embedding")).select(
        F.col("query_id").alias("id"), F.col("query_embedding").alias("embedding"), "at.*"), "probes")
    placed = index.vectors.select("id", "embedding", "cell").join(index.centroids, "cell")
    return _meet_blocks(
        _packed(located, ["edge", "last"], "last", located.count()), _packed(placed, ["cell"], "cell", n_vectors), Wanted(k), probed, matrix.shape[1])


def _centroid_table(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and centroids of the cells in their order."""
    table = centroids.orderBy("cell").toPandas()
    return table["cell"].to_numpy(), _matrix(table["centroid"])


def corpus_centroid(vectors: DataFrame) -> DataFrame:
    """One row ``centroid``: the mean vector scaled to unit length (tree aggregation)."""
    mean = vectors.agg(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))).alias("m"))
    return mean.select(l2_normalize(vector_to_array("m")).alias("centroid"))


def mean_similarity(vectors: DataFrame, centroid: DataFrame) -> DataFrame:
    """One row ``mean_similarity, n`` of vectors against a one-row centroid."""
    similarity = similarity_to(centroid)
    return vectors.agg(F.avg(similarity).alias("mean_similarity"), F.count("*").alias("n"))


def similarity_to(centroid: DataFrame) -> Column:
    """Inner product of ``embedding`` with a one-row centroid, which becomes a constant."""
    center = centroid.select("centroid").first()["centroid"]
    return dot(F.col("embedding"), F.array(*[F.lit(float(x)) for x in center]))


def norm_report(vectors: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Largest distance of a vector length from 1."""
    off = F.abs(norm(F.col("embedding")) - 1.0)
    return vectors.agg(
        F.count("*").alias("n_vectors"), F.max(off).alias("max_deviation"),
        F.coalesce(F.max(off) <= tolerance, F.lit(True)).alias("all_unit"),
    )


def self_retrieval(vectors: DataFrame, index: VectorIndex, probe: int | None = None) -> DataFrame:
    """``query_id, found_id, score, ok``: every stored vector must find itself or an equal one first."""
    queries = vectors.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    first = knn_clustered(queries, index, 1, probe)
    return first.select(
        "query_id", F.col("question_id").alias("found_id"), "score",
        ((F.col("question_id") == F.col("query_id")) | ((F.col("question_id") < F.col("query_id")) & (F.col("score") == 1.0))).alias("ok"))


def attach_questions(hits: DataFrame, questions: DataFrame) -> DataFrame:
    """Add the question text to hits; hits without a stored question vanish."""
    return hits.join(questions.select("question_id", "question_text"), "question_id", "inner").select(
        *hits.columns, "question_text")


def indexed_questions(questions: DataFrame) -> DataFrame:
    return questions.filter(F.col("vec_id").isNotNull())


