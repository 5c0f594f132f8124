import numpy as np
import pytest
from pyspark.sql import functions as F

from nearkin.llm import whitening as W
from nearkin.llm.queries import QUERIES


def brute(rows):
    """Components, deviations and whitened values by one dense decomposition."""
    x = {i: np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000 for i, v in rows}
    distinct = np.array(sorted({tuple(v) for v in x.values()}), np.int64)
    n, sums = len(distinct), distinct.sum(0)
    centred = distinct - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:16]
    values, vectors, trace = values[order], vectors[:, order], values.sum()
    return {i: (n, sum(int(n * a - b) ** 2 for a, b in zip(v.tolist(), sums.tolist())), (v - sums / n) @ vectors / np.sqrt(values))
            for i, v in x.items()}, values / trace


def held(result):
    found = {}
    for r in result.collect():
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    return found


@pytest.mark.parametrize("split", [W.SPLIT, 5])
def test_query_against_brute_force(spark, monkeypatch, split):
    monkeypatch.setattr(W, "SPLIT", split)
    monkeypatch.setattr(W, "BLOCK_ENTRIES", 1000)
    folder = "/root/testdata/sf0.01"
    stored = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r[0], r[1]) for r in stored.collect()]
    wanted, explained = brute(rows)
    result = QUERIES["op12_whitening"](spark, folder)
    assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = held(result)
    assert found.keys() == wanted.keys()
    values = np.array([[found[i][c]["whitened"] for c in range(1, 17)] for i in wanted])
    truth = np.array([wanted[i][2] for i in wanted])
    signs = np.sign((values * truth).sum(0))
    assert np.allclose(values, truth * signs, atol=1e-8)
    for i, own in found.items():
        assert {(r["n"], r["deviation"]) for r in own.values()} == {wanted[i][:2]}
        assert np.allclose([own[c]["explained"] for c in range(1, 17)], explained[:16], rtol=1e-9)
        assert all(0 <= r["identity_error"] < 1e-8 for r in own.values())


def test_copies_are_fitted_once_or_by_count(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(50, 4)).round(2)
    rows = [(i, base[i % 50 if i < 60 else 3].tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    once = held(W.whiten(df, components=2))
    assert len(once) == 200 and {r["n"] for own in once.values() for r in own.values()} == {50}
    assert len({once[i][1]["whitened"] for i in range(60, 200)}) == 1
    x = np.floor(64 * np.array([v for _, v in rows])) + 1_000_000
    top = np.linalg.eigvalsh(np.cov(x.T, bias=True))[-1]
    counted = held(W.whiten(df, components=2, by_copies=True))
    assert counted[0][1]["explained"] == pytest.approx(top / np.trace(np.cov(x.T, bias=True)))
    assert max(r["identity_error"] for own in counted.values() for r in own.values()) < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0], 1, 2), (2, [1.0, 0.5], 1, 2), (2, [1.0, 0.5], 1, 2), (None, [0.3, 0.1], 1, 2), (4, None, 1, 2), (5, [], 1, 2),
            (6, [nan, 1.0], 1, 2), (7, [None, 1.0], 1, 2), (8, [1.0, inf], 1, 2), (9, [1.0, 2.0, 3.0], 1, 2), (10, [1e300, 0.0], 1, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long, component int")
    found = W.whiten(df).collect()
    ids = [r["vec_id"] for r in found if r["component"] == 1]
    assert sorted(ids, key=str) == sorted([1, 2, 2, None, 10], key=str)
    assert {r["n"] for r in found} == {4}
    assert W.whiten(df.filter("vec_id = 9")).count() == 0
    for none in (df.limit(0), df.filter("vec_id = 4")):
        result = W.whiten(none)
        assert result.count() == 0 and result.columns[0] == "vec_id"


def test_deviation_beyond_64_bits():
    model = W.Model(3_000_000_000, np.array([0, 0]), 1.0)
    assert model.deviations(np.array([[1, 0], [2, 0]])) == [9_000_000_000_000_000_000, None]


def test_plan_folds_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, [0.5])], "vec_id long, embedding array<float>")
    plan = W.whole_vectors(df, "vec_id", "embedding").groupBy("x").agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange")
