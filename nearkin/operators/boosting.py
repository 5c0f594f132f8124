"""Gradient-boosted trees from histograms, stopped by the AUC of validation rows.

Feature values become bins at quantiles, once. Rows are stored in blocks of bin numbers; a tree
grows level by level, and each level is one pass in which every partition adds up slopes and
curvatures per node, feature and bin. Only these sums, whose size depends on the settings alone,
leave the partitions. Slopes, curvatures and leaf values are whole multiples of ``1 / UNIT``, so sums are exact
and a model never depends on how rows are dealt to partitions. Margins of the trees so far are
written back every ``REFRESH`` rounds; in between the few newer trees are applied on the fly, so a
lost executor costs one pass.

Rows of a tree are drawn by the hash of the row, columns once per tree. After each round the
validation rows are counted by margin (steps of ``1 / STEPS``); their AUC follows from the counts,
and boosting ends when it has not grown for ``patience`` rounds. The model keeps the trees up to
the best round.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.session import materialize, remove_table

UNIT = 1 << 20
STEPS = 1 << 10
MARGIN_LIMIT = 24
BLOCK_ROWS = 1 << 14
REFRESH = 16
DIRECT_PARTS = 8
PART_ROWS = 1 << 17


@dataclass(frozen=True)
class Settings:
    rounds: int = 500
    depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    patience: int = 30
    bins: int = 256
    ridge: float = 1.0
    least_curvature: float = 1.0
    positive_weight: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes in the order they were made; ``feature`` is -1 for a leaf, whose ``value`` counts in units."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float, values: tuple[int, int]) -> int:
        """Give a node two children and return the number of the left one."""
        first = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, first, gain
        for value in values:
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(0)
            self.value.append(value)
            self.gain.append(0.0)
        return first

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each column of ``bins[feature, row]``."""
        node = np.zeros(bins.shape[1], np.int64)
        feature, cut, left = (np.array(x, np.int64) for x in (self.feature, self.cut, self.left))
        rows = np.arange(bins.shape[1])
        while True:
            inner = feature[node] >= 0
            if not inner.any():
                return node
            at = np.where(inner, feature[node], 0)
            node = np.where(inner, left[node] + (bins[at, rows] > cut[node]), node)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value, np.int64)[self.leaves(bins)]


def binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Number of edges below each value; values that are missing stand in the lowest bin."""
    found = np.searchsorted(edges, values, side="left")
    return np.where(np.isnan(values), 0, found).astype(np.uint8)


def slopes(margin: np.ndarray, label: np.ndarray, positive_weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Slope and curvature of the logistic loss in units."""
    p = 1 / (1 + np.exp(-np.clip(margin / UNIT, -MARGIN_LIMIT, MARGIN_LIMIT)))
    w = np.where(label == 1, positive_weight, 1.0)
    return np.rint(w * (p - label) * UNIT), np.maximum(np.rint(w * p * (1 - p) * UNIT), 1)


def drawn(keys: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Which rows take part in a tree: a share of them by hash."""
    x = keys.view(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return (x ^ x >> np.uint64(31)) < np.uint64(int(share * (2**64 - 1)))


def columns_of(round_: int, n_features: int, settings: Settings) -> list[int]:
    """The features of one tree."""
    chosen = np.random.default_rng([settings.seed, round_]).permutation(n_features)
    return sorted(chosen[:max(1, round(settings.column_share * n_features))].tolist())


def best_split(g: np.ndarray, h: np.ndarray, features: list[int], settings: Settings) -> tuple[float, int, int]:
    """Gain, feature and bin of the best cut of one node, from ``[feature, bin]`` sums in units."""
    g, h = g / UNIT, h / UNIT
    total_g, total_h = g[0].sum(), h[0].sum()
    best = (0.0, -1, 0)
    for f in features:
        gl, hl = np.cumsum(g[f])[:-1], np.cumsum(h[f])[:-1]
        gr, hr = total_g - gl, total_h - hl
        gain = gl * gl / (hl + settings.ridge) + gr * gr / (hr + settings.ridge) - total_g**2 / (total_h + settings.ridge)
        gain = np.where((hl >= settings.least_curvature) & (hr >= settings.least_curvature), gain, 0)
        at = int(gain.argmax()) if len(gain) else 0
        if len(gain) and gain[at] > best[0] + 1e-9:
            best = (float(gain[at]), f, at)
    return best


def leaf_value(g: float, h: float, settings: Settings) -> int:
    return int(np.rint(-g / (h + settings.ridge * UNIT) * settings.rate * UNIT))


def area(counts: np.ndarray) -> float | None:
    """AUC from counts ``[label, margin step]``; None where a label is missing."""
    negative, positive = counts.astype(np.float64)
    if not negative.sum() or not positive.sum():
        return None
    below = np.cumsum(negative) - negative
    return float((positive * (below + negative / 2)).sum() / (positive.sum() * negative.sum()))


def margin_counts(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Counts of rows by label and margin step."""
    width = 2 * MARGIN_LIMIT * STEPS
    step = np.clip(np.floor_divide(margin * STEPS, UNIT) + width // 2, 0, width - 1)
    return np.stack([np.bincount(step[label == y], minlength=width) for y in (0, 1)])


@dataclass
class Block:
    bins: np.ndarray
    label: np.ndarray
    held: np.ndarray
    keys: np.ndarray
    margin: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, i: int, n_features: int) -> "Block":
        part = {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}
        return cls(np.frombuffer(part["bins"], np.uint8).reshape(n_features, -1), np.frombuffer(part["label"], np.uint8),
                   np.frombuffer(part["held"], np.uint8).astype(bool), np.frombuffer(part["keys"], np.int64),
                   np.frombuffer(part["margin"], np.int64))


_BLOCK = "bins binary, label binary, held binary, keys binary, margin binary"


def blocks_of(features: DataFrame, names: list[str], label: str, validation: str | None, edges: list[np.ndarray]) -> DataFrame:
    """Rows in blocks of bin numbers, with margins of 0. Rows without a label take no part."""
    rows = features.filter(F.col(label).isNotNull()).select(
        F.xxhash64(*features.columns).alias("_key"), F.col(label).cast("int").alias("_label"),
        (F.coalesce(F.col(validation), F.lit(False)) if validation else F.lit(False)).alias("_held"),
        *[F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(names)])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            columns = [table.column(i).to_numpy() for i in range(table.num_columns)]
            bins = np.stack([binned(v.astype(np.float64), e) for v, e in zip(columns[3:], edges)])
            parts = [bins, columns[1].astype(np.uint8), columns[2].astype(np.uint8), columns[0].astype(np.int64), np.zeros(table.num_rows, np.int64)]
            return pa.RecordBatch.from_arrays(
                [pa.array([p.tobytes()], pa.binary()) for p in parts], names=["bins", "label", "held", "keys", "margin"])

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                waiting.append(batch.slice(start, BLOCK_ROWS))
                if sum(b.num_rows for b in waiting) >= BLOCK_ROWS:
                    yield block()
        if waiting:
            yield block()

    return rows.mapInArrow(packed, _BLOCK)


def _added(blocks: DataFrame, parts: int, partial: Callable[[Block], dict[int, np.ndarray]], n_features: int) -> dict[int, np.ndarray]:
    """Sums of the arrays that ``partial`` gives per key, over all blocks: by partition, then by key."""
    def by_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                for key, own in partial(Block.of(batch, i, n_features)).items():
                    held[key] = held[key] + own if key in held else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([a.astype(np.int64).tobytes() for a in held.values()], pa.binary())], names=["key", "sums"])

    def by_key(own: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(s.as_py(), np.int64) for s in own.column("sums")], axis=0)
        return pa.table({"key": own.column("key").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    found = blocks.mapInArrow(by_partition, "key int, sums binary")
    if parts > DIRECT_PARTS:
        found = found.groupBy("key").applyInArrow(by_key, "key int, sums binary")
    sums: dict[int, np.ndarray] = {}
    for row in found.collect():
        own = np.frombuffer(row["sums"], np.int64)
        sums[row["key"]] = sums[row["key"]] + own if row["key"] in sums else own
    return sums


def _current(block: Block, newer: list[Tree]) -> np.ndarray:
    margin = block.margin
    for tree in newer:
        margin = margin + tree.margins(block.bins)
    return margin


def grow(sums: Callable[[Tree, list[int], bool], dict[int, np.ndarray]], features: list[int], n_features: int, n_bins: int,
         settings: Settings) -> tuple[Tree, np.ndarray | None]:
    """One tree, level by level, and the validation counts of the model before it.

    ``sums(tree, nodes, first)`` gives the slopes and curvatures per feature and bin of each node.
    """
    tree, open_, counts = Tree(), [0], None
    for level in range(settings.depth):
        found = sums(tree, open_, level == 0)
        if level == 0:
            counts = found.pop(-1, None)
        following: list[int] = []
        for node in open_:
            if node not in found:
                continue
            g, h = found[node].reshape(2, n_features, n_bins).astype(np.float64)
            gain, feature, cut = best_split(g, h, features, settings)
            if level == 0:
                tree.value[0] = leaf_value(g[0].sum(), h[0].sum(), settings)
            if feature < 0:
                continue
            gl, hl = g[feature, :cut + 1].sum(), h[feature, :cut + 1].sum()
            first = tree.split(node, feature, cut, gain, (
                leaf_value(gl, hl, settings), leaf_value(g[feature].sum() - gl, h[feature].sum() - hl, settings)))
            following += [first, first + 1]
        open_ = following
        if not open_:
            break
    return tree, counts


def node_sums(block: Block, margin: np.ndarray, tree: Tree, nodes: list[int], round_: int, n_bins: int, settings: Settings) -> dict[int, np.ndarray]:
    """Slopes and curvatures of a block's drawn training rows per node, feature and bin."""
    use = ~block.held
    if settings.row_share < 1:
        use &= drawn(block.keys, settings.row_share, settings.seed * 1_000_003 + round_)
    bins = block.bins[:, use]
    g, h = slopes(margin[use], block.label[use], settings.positive_weight)
    place_of = np.full(len(tree.feature), -1)
    place_of[nodes] = np.arange(len(nodes))
    place = place_of[tree.leaves(bins)]
    inside = place >= 0
    place, bins, g, h = place[inside], bins[:, inside], g[inside], h[inside]
    size = len(nodes) * n_bins
    both = np.empty((2, len(bins), size))
    for f, own in enumerate(bins):
        at = place * n_bins + own
        both[0, f], both[1, f] = np.bincount(at, g, size), np.bincount(at, h, size)
    by_node = both.reshape(2, len(bins), len(nodes), n_bins)
    return {node: by_node[:, :, i].astype(np.int64).ravel() for i, node in enumerate(nodes)}


@dataclass
class BoostedTrees:
    """A fitted model: features, their bin edges and the trees up to the best round."""

    features: list[str]
    edges: list[list[float]]
    trees: list[Tree]
    aucs: list[float | None] = field(default_factory=list)
    name: str = "boosted_trees"

    def save(self, path: str, spark: SparkSession) -> None:
        data = {"name": self.name, "features": self.features, "edges": self.edges, "aucs": self.aucs, "trees": [t.__dict__ for t in self.trees]}
        spark.createDataFrame([(json.dumps(data),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "BoostedTrees":
        data = json.loads(spark.read.parquet(path).first()["model"])
        return cls(data["features"], data["edges"], [Tree(**t) for t in data["trees"]], data["aucs"], data["name"])

    def score(self, features: DataFrame, label: str = "is_duplicate") -> DataFrame:
        """Feature rows with ``y_true`` and ``y_prob``."""
        rows = features.withColumn("y_true", F.col(label).cast("int"))
        names, trees, edges = self.features, self.trees, [np.array(e) for e in self.edges]
        schema = T.StructType([*rows.schema.fields, T.StructField("y_prob", T.DoubleType())])

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = [batch.column(batch.schema.get_field_index(c)).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in names]
                bins = np.stack([binned(v, e) for v, e in zip(values, edges)]) if len(values) else np.zeros((0, batch.num_rows), np.uint8)
                margin = np.zeros(batch.num_rows, np.int64)
                for tree in trees:
                    margin = margin + tree.margins(bins)
                prob = 1 / (1 + np.exp(-np.clip(margin / UNIT, -MARGIN_LIMIT, MARGIN_LIMIT)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prob)], names=[*batch.schema.names, "y_prob"])

        return rows.mapInArrow(scored, schema)

    def importance(self) -> dict[str, float]:
        """Share of each feature in the mean gain per split."""
        gains: dict[int, list[float]] = {}
        for tree in self.trees:
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    gains.setdefault(f, []).append(gain)
        means = {f: sum(g) / len(g) for f, g in gains.items()}
        total = sum(means.values()) or 1.0
        return {name: means.get(i, 0.0) / total for i, name in enumerate(self.features)}


def bin_edges(rows: DataFrame, names: list[str], bins: int) -> list[np.ndarray]:
    """Upper edges of the bins of each feature, at quantiles of the rows; one pass."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[
        F.percentile_approx(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), shares, 100_000).alias(f"q{i}") for i, c in enumerate(names)]).first()
    return [np.unique(np.array(q or [], np.float64)) for q in found]


def train(features: DataFrame, names: list[str], label: str, validation: str | None, settings: Settings) -> BoostedTrees:
    """Boost until the rounds are used up or the validation AUC stops growing.

    Without validation rows of both labels all rounds are run. Without training rows the model has
    no splits and gives one half.
    """
    spark = features.sparkSession
    fitting = features.filter(F.col(label).isNotNull())
    if validation:
        fitting = fitting.filter(~F.coalesce(F.col(validation), F.lit(False)))
    edges = bin_edges(fitting, names, settings.bins)
    n_features, n_bins = len(names), max([len(e) + 1 for e in edges], default=1)
    # every pass is a job: small tables get few tasks
    dealt = features.coalesce(max(1, -(-features.count() // PART_ROWS)))
    blocks = materialize(blocks_of(dealt, names, label, validation, edges), "boosting-blocks")
    parts = blocks.rdd.getNumPartitions()
    trees: list[Tree] = []
    aucs: list[float | None] = []
    done, best = 0, -1

    def counted() -> bool:
        """Take in the AUC of the trees so far; False when boosting is to end."""
        nonlocal best
        if not trees:
            return True
        if aucs[-1] is not None and (best < 0 or aucs[-1] > aucs[best]):
            best = len(aucs) - 1
        return best < 0 or len(aucs) - 1 - best < settings.patience

    def sums(tree: Tree, nodes: list[int], first: bool) -> dict[int, np.ndarray]:
        newer, round_ = trees[done:], len(trees)

        def partial(block: Block) -> dict[int, np.ndarray]:
            margin = _current(block, newer)
            found = node_sums(block, margin, tree, nodes, round_, n_bins, settings)
            if first and block.held.any():
                found[-1] = margin_counts(margin[block.held], block.label[block.held]).ravel()
            return found

        return _added(blocks, parts, partial, n_features)

    while len(trees) < settings.rounds:
        tree, counts = grow(sums, columns_of(len(trees), n_features, settings), n_features, n_bins, settings)
        if trees:
            aucs.append(area(counts.reshape(2, -1)) if counts is not None else None)
            if not counted():
                break
        trees.append(tree)
        if len(trees) - done >= REFRESH:
            newer = trees[done:]

            def moved(batches: Iterator[pa.RecordBatch], newer: list[Tree] = newer) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for i in range(batch.num_rows):
                        margin = _current(Block.of(batch, i, n_features), newer)
                        yield pa.RecordBatch.from_arrays(
                            [*(batch.column(j).slice(i, 1) for j in range(4)), pa.array([margin.tobytes()], pa.binary())], names=batch.schema.names)

            older, blocks = blocks, materialize(blocks.mapInArrow(moved, _BLOCK), "boosting-blocks")
            remove_table(older)
            done = len(trees)
    else:
        if validation and trees:
            newer = trees[done:]
            found = _added(blocks, parts, lambda b: {-1: margin_counts(_current(b, newer)[b.held], b.label[b.held]).ravel()}, n_features)
            aucs.append(area(found[-1].reshape(2, -1)) if found else None)
            counted()
    remove_table(blocks)
    kept = trees[:best + 1] if best >= 0 else trees
    return BoostedTrees(names, [e.tolist() for e in edges], kept, aucs)
