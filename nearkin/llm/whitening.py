"""Embedding whitening: covariance over distinct vectors, weighted by their multiplicity or by one.

Entries become whole numbers, and rows with equal vectors fold into one row with a count before
the shuffle. Sums, the centred products and the projections then touch each distinct vector
once: every partition adds its weighted, centred matrix product, and the partial matrices, whose
size depends on the dimension alone, are added up in groups on the executors before the rest reaches
the driver. The eigenvectors of the covariance, each divided by the root of its eigenvalue, whiten
the distinct vectors, which are joined back to the rows. A vector with more copies than
``SPLIT`` and than a thousandth of all rows is joined in as many parts as it needs; there are at most a
thousand of them, so their list is small by construction.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped;
entries beyond ``LIMIT`` in size count as ``LIMIT``; vectors of different dimension have models of their
own; components without variance (at most ``FLAT`` of the greatest) are left out, so a single distinct
vector and a vector without entries give no rows; a deviation beyond 63 bits is null;
repeated rows and ids give repeated rows; an empty table gives none. Of the table's columns only the
id and the vector are read, so others never clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.llm.common import Steps
from nearkin.session import materialize

SCALE, SHIFT = 64, 1_000_000
LIMIT = float(1 << 22)
COMPONENTS = 16
SPLIT = 50_000
HEAVY = 1000
FLAT = 1e-12
GROUPS = 16
BLOCK_ENTRIES = 1 << 18


@dataclass
class Model:
    """Statistics of the distinct vectors of one dimension and the axes that whiten them."""

    n: int
    sums: np.ndarray
    total: float = 0.0
    axes: np.ndarray | None = None
    values: np.ndarray | None = None
    trace: float = 0.0

    def mean(self) -> np.ndarray:
        return self.sums / self.total

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean()) @ (self.axes / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - sum)^2."""
        counted = np.array([int(s) for s in self.sums], object) if self._wide(x) else self.sums
        apart = self.n * (x.astype(object) if self._wide(x) else x) - counted
        return [int(d) if d < 1 << 63 else None for d in (apart * apart).sum(axis=1)]

    def _wide(self, x: np.ndarray) -> bool:
        largest = self.n * int(np.abs(x).max(initial=0)) + int(np.abs(self.sums).max(initial=0))
        if largest >= 1 << 62:
            return True
        apart = int(np.abs(self.n * x - self.sums).max(initial=0))
        return apart * apart * max(1, x.shape[1]) >= 1 << 63


def whole_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Id and whole-number vector of the rows that take part."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    entry = lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), x.cast("double")))
    return df.filter(F.col(embedding).isNotNull()).filter(finite).select(
        F.col(vec_id).alias("id"), F.transform(embedding, lambda x: (F.floor(F.lit(float(SCALE)) * entry(x)) + SHIFT).cast("int")).alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_ENTRIES) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches with vectors of one dimension, and the vectors as a matrix."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("x"))
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        for dims in np.unique(sizes).tolist():
            some = batch if (sizes == dims).all() else batch.filter(pa.array(sizes == dims))
            step = max(1, limit // max(1, dims))
            for start in range(0, some.num_rows, step):
                part = some.slice(start, step)
                values = part.column(part.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False)
                yield part, values.reshape(part.num_rows, dims).astype(np.int64)


def _added(vectors: DataFrame, partial: Callable[[pa.RecordBatch, np.ndarray], np.ndarray | None], kind: type) -> dict[int, np.ndarray]:
    """Sums of ``partial`` over all vectors per dimension: by partition, then by group, then here."""
    def by_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch, x in _blocks(batches):
            own = partial(batch, x)
            if own is not None:
                held[x.shape[1]] = held[x.shape[1]] + own if x.shape[1] in held else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([m.tobytes() for m in held.values()], pa.binary())], names=["dims", "m"])

    def by_group(own: pa.Table) -> pa.Table:
        total = None
        for m in own.column("m"):
            numbers = np.frombuffer(m.as_py(), kind)
            total = numbers.copy() if total is None else total + numbers
        return pa.table({"dims": own.column("dims").slice(0, 1), "m": pa.array([total.tobytes()], pa.binary())})

    grouped = (vectors.mapInArrow(by_partition, "dims int, m binary").withColumn("part", F.spark_partition_id() % GROUPS)
               .groupBy("dims", "part").applyInArrow(by_group, "dims int, m binary"))
    found: dict[int, np.ndarray] = {}
    for row in grouped.collect():
        numbers = np.frombuffer(row["m"], kind)
        found[row["dims"]] = found[row["dims"]] + numbers if row["dims"] in found else numbers
    return found


def _weights(batch: pa.RecordBatch, weighted: bool) -> np.ndarray:
    copies = batch.column(batch.schema.get_field_index("copies")).to_numpy(zero_copy_only=False)
    return copies if weighted else np.ones_like(copies)


def fit(distinct: DataFrame, components: int = COMPONENTS, by_copies: bool = False) -> dict[int, Model]:
    """Models by dimension from a table of distinct vectors ``x`` and their ``copies``."""
    def sums(batch: pa.RecordBatch, x: np.ndarray) -> np.ndarray:
        w = _weights(batch, by_copies)
        return np.concatenate([[len(x), w.sum()], w @ x]).astype(np.int64)

    models = {d: Model(int(s[0]), s[2:], float(s[1])) for d, s in _added(distinct, sums, np.int64).items()}

    def products(batch: pa.RecordBatch, x: np.ndarray) -> np.ndarray:
        apart = x - models[x.shape[1]].mean()
        return (apart.T * _weights(batch, by_copies)) @ apart

    for dims, summed in _added(distinct, products, np.float64).items():
        model = models[dims]
        covariance = summed.reshape(dims, dims) / model.total
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        order = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > FLAT * max(values.max(), 0)]
        model.axes, model.values, model.trace = vectors[:, order], values[order], float(np.trace(covariance))
    return models


def whitened(distinct: DataFrame, models: dict[int, Model]) -> DataFrame:
    """Each distinct vector once: ``x``, ``copies``, ``deviation`` and the ``whitened`` components."""
    schema = T.StructType([*distinct.schema.fields, T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    names = schema.names

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches):
            model = models[x.shape[1]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.deviations(x), pa.int64()),
                 pa.array(list(model.whiten(x)), pa.list_(pa.float64()))], names=names)

    return distinct.mapInArrow(projected, schema)


def identity_errors(table: DataFrame, models: dict[int, Model], by_copies: bool = False) -> dict[int, float]:
    """Largest absolute entry of the covariance of whitened vectors minus the identity, by dimension."""
    def products(batch: pa.RecordBatch, x: np.ndarray) -> np.ndarray:
        size = len(models[x.shape[1]].values)
        w = _weights(batch, by_copies)
        numbers = batch.column(batch.schema.get_field_index("whitened")).flatten().to_numpy(zero_copy_only=False)
        z = numbers.reshape(len(x), size)
        return np.concatenate([w @ z, ((z.T * w) @ z).ravel()])

    found = {}
    for dims, summed in _added(table, products, np.float64).items():
        size, total = len(models[dims].values), models[dims].total
        mean = summed[:size] / total
        off = summed[size:].reshape(size, size) / total - np.outer(mean, mean) - np.eye(size)
        found[dims] = float(np.abs(off).max(initial=0.0))
    return found


def joined_back(rows: DataFrame, table: DataFrame, total: int) -> DataFrame:
    """The rows with what belongs to their vector; vectors with very many rows are met in parts."""
    limit = max(SPLIT, total // HEAVY)
    parts = F.ceil(F.col("copies") / limit).cast("int")
    # fewer than HEAVY vectors can have more than a HEAVY-th of all rows
    heavy = F.broadcast(table.filter(F.col("copies") > limit).select(F.col("x").alias("hx"), parts.alias("parts")))
    spread = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.coalesce("parts", F.lit(1))).cast("int")
    left = rows.join(heavy, F.col("x") == F.col("hx"), "left").select("id", "x", spread.alias("part"))
    right = table.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("copies")
    return left.join(right, ["x", "part"])


def _by_dims(values: dict[int, object], kind: str) -> Column:
    """A constant that depends on the dimension of ``x``."""
    found = F.lit(None).cast(kind)
    for dims, value in values.items():
        found = F.when(F.size("x") == dims, F.lit(value).cast(kind)).otherwise(found)
    return found


def whiten(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS, by_copies: bool = False) -> DataFrame:
    """Per row and component: whitened value, share explained, exact deviation and the error of the whitening."""
    steps = Steps(df.sparkSession)
    rows = whole_vectors(df, vec_id, embedding)
    distinct = steps.write(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "distinct-vectors")
    models = fit(distinct, components, by_copies)
    # the result reads this table; what it was made of goes
    table = materialize(whitened(distinct, models), "whitened-vectors")
    steps.drop()
    errors = identity_errors(table, models, by_copies)
    total = table.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    shares = {d: [float(v) / m.trace for v in m.values] for d, m in models.items()}
    explained = F.lit(None).cast("array<double>")
    for dims, own in shares.items():
        explained = F.when(F.size("x") == dims, F.array(*map(F.lit, own)).cast("array<double>")).otherwise(explained)
    back = joined_back(rows, table.filter(F.size("whitened") > 0), total).select(
        F.col("id").alias(vec_id), _by_dims({d: m.n for d, m in models.items()}, "long").alias("n"), "deviation",
        _by_dims(errors, "double").alias("identity_error"), F.explode(F.arrays_zip(
            F.sequence(F.lit(1), F.size("whitened")).alias("component"), F.col("whitened").alias("whitened"),
            explained.alias("explained"))).alias("c")) if models else None
    if back is None:
        kind = rows.schema["id"].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"`{vec_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return back.select(vec_id, "c.component", "n", "deviation", "c.whitened", "c.explained", "identity_error")
