"""Nearest neighbours against numpy, on every execution path."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from nearkin.operators import vectors as vx


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    raw = rng.normal(size=(300, 8))
    raw[200:] = raw[0]  # a third of all rows are copies
    unit = (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype("float32")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "id long, embedding array<float>")
    return df.cache(), unit.astype("float64")


def expected(unit, k, skip_self=False):
    scores = np.round(unit @ unit.T, 9)
    out = {}
    for q in range(len(unit)):
        order = sorted((i for i in range(len(unit)) if not (skip_self and i == q)), key=lambda i: (-scores[q, i], i))[:k]
        for r, i in enumerate(order, 1):
            out[(q, r)] = i
    return out


def as_map(df):
    return {(r["query_id"], r["rank"]): r["question_id"] for r in df.collect()}


def queries_of(df):
    return df.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_embedding"))


@pytest.mark.parametrize("skip_self", [False, True])
@pytest.mark.parametrize("few", [4096, 0])
def test_exact_equals_numpy(data, monkeypatch, few, skip_self):
    df, unit = data
    monkeypatch.setattr(vx, "BROADCAST_QUERY_ROWS", few)
    monkeypatch.setattr(vx, "BLOCK_ROWS", 64)
    assert as_map(vx.knn_exact(queries_of(df), df, 5, skip_self)) == expected(unit, 5, skip_self)


def test_k_beyond_the_table(data, monkeypatch):
    df, unit = data
    few = df.filter("id < 3")
    for rows in (4096, 0):
        monkeypatch.setattr(vx, "BROADCAST_QUERY_ROWS", rows)
        assert vx.knn_exact(queries_of(few), few, 10).count() == 9
    monkeypatch.setattr(vx, "BROADCAST_QUERY_ROWS", 4096)
    assert vx.knn_exact(queries_of(few).limit(0), few, 10).count() == 0


def test_clustered_search(data, monkeypatch):
    df, unit = data
    index = vx.build_vector_index(df, cells=7)
    assert index.vectors.count() == 300
    assert index.centroids.count() <= 7
    exact = expected(unit, 5)
    assert as_map(vx.knn_clustered(queries_of(df), index, 5, probe=100)) == exact
    monkeypatch.setattr(vx, "BLOCK_ROWS", 16)
    found = as_map(vx.knn_clustered(queries_of(df), index, 5, probe=3))
    ordinary = [key for key in exact if key[0] < 200]
    hits = sum(found.get(key) == exact[key] for key in ordinary)
    assert hits / len(ordinary) > 0.5
    # all but one cell, scored cell by cell, still ranks by the same rule inside the copies
    assert [found[(250, r)] for r in range(1, 6)] == [exact[(250, r)] for r in range(1, 6)]
    assert vx.self_retrieval(df, index).filter(~F.col("ok")).count() == 0


def test_cells_of_new_vectors_match_the_clustering(data):
    df, _ = data
    index = vx.build_vector_index(df, cells=5)
    again = vx.assign_cells(df, index.centroids)
    assert again.join(index.vectors.select("id", F.col("cell").alias("old")), "id").filter("cell <> old").count() == 0


def test_cell_count_rule():
    assert [vx.cell_count(n) for n in (0, 38, 39, 500, 10**7)] == [1, 1, 1, 12, 4096]


def test_centroid_and_norms(data):
    df, unit = data
    mean = unit.mean(axis=0)
    got = vx.corpus_centroid(df).first()["centroid"]
    assert got == pytest.approx((mean / np.linalg.norm(mean)).tolist())
    assert vx.norm_report(df).first()["all_unit"]
    stretched = df.withColumn("embedding", F.transform("embedding", lambda x: x * F.lit(2).cast("float")))
    assert not vx.norm_report(stretched).first()["all_unit"]


def clustered(n, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(n // 50, 8))
    raw = np.repeat(centers, 50, axis=0) + 0.05 * rng.normal(size=(n // 50 * 50, 8))
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def test_search_by_bounds_is_exact_and_grows_slower_than_all_pairs(spark, monkeypatch):
    pairs = {}
    score = vx._score_cells
    for n in (500, 1000, 2000):
        unit = clustered(n)
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "id long, embedding array<double>")
        queries = df.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_embedding"))
        index = vx.build_vector_index(df, cells=n // 50)
        seen = []

        def counted(probes, named, k):
            sizes = named.groupBy("cell").agg(F.count("*").alias("n"))
            seen.append(probes.join(sizes, "cell").agg(F.sum("n")).first()[0] or 0)
            return score(probes, named, k)

        monkeypatch.setattr(vx, "_score_cells", counted)
        got = {(r["query_id"], r["rank"]): r["question_id"] for r in vx.knn_by_bounds(queries, index, 5, skip_self=True).collect()}
        scores = np.round(unit @ unit.T, 9)
        np.fill_diagonal(scores, -9)
        for i in range(len(unit)):
            best = np.lexsort((np.arange(len(unit)), -scores[i]))[:5]
            assert [got[i, r] for r in range(1, 6)] == best.tolist()
        pairs[n] = sum(seen)
    assert pairs[1000] < 3 * pairs[500] and pairs[2000] < 3 * pairs[1000]
    assert pairs[2000] < 2000 * 2000 / 3


def test_search_is_exact_above_the_probes_of_the_approximate_one(spark, monkeypatch):
    unit = np.random.default_rng(8).normal(size=(1200, 24))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "id long, embedding array<double>").cache()
    index = vx.build_vector_index(df, cells=150)
    assert index.centroids.count() > 2 * vx.MAX_PROBE
    queries = queries_of(df).filter("id < 200")
    best = np.argsort(-np.round(unit[:200] @ unit.T, 9), axis=1, kind="stable")[:, :10]
    exact = {(q, r): int(i) for q, row in enumerate(best) for r, i in enumerate(row, 1)}
    assert as_map(vx.knn_clustered(queries, index, 10)) == exact
    with monkeypatch.context() as many:
        many.setattr(vx, "BROADCAST_QUERY_ROWS", 100)
        assert as_map(vx.knn_clustered(queries, index, 10)) == exact

    def recall(probe):
        found = as_map(vx.knn_clustered(queries, index, 10, probe=probe))
        return len({(q, i) for (q, _), i in found.items()} & {(q, i) for (q, _), i in exact.items()}) / len(exact)

    few, many = recall(vx.MAX_PROBE), recall(2 * vx.MAX_PROBE)
    assert few < many and many >= 0.9
    # vectors without clusters are the worst case for the share of cells that is probed by default
    assert vx.MAX_PROBE < vx.probe_count(150) < 150 and recall(vx.probe_count(150)) >= 0.9


def test_bounds_along_the_axes_finish_few_inner_products():
    rng = np.random.default_rng(21)
    vectors = rng.normal(size=(6000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    queries, ids = vectors[:400], np.arange(6000)
    for axes in (np.eye(64), np.linalg.eigh(vectors.T @ vectors)[1][:, ::-1]):
        found, finished = vx.best_in_chunks(ids[:400], queries @ axes, np.full(400, -np.inf), ids, vectors @ axes, 10, skip_self=True)
        scores = np.round(queries @ vectors.T, 9)
        scores[np.arange(400), np.arange(400)] = -9
        best = np.argsort(-scores, axis=1, kind="stable")[:, :10]
        assert found["question_id"].to_numpy().reshape(400, 10).tolist() == best.tolist()
        # uniform directions are the worst case; the first chunk has no floor yet
        assert finished < queries.shape[0] * len(ids) / 2
    # vectors near a plane are decided by the first quarter of their principal axes
    flat = rng.normal(size=(6000, 8)) @ rng.normal(size=(8, 64)) + 0.01 * rng.normal(size=(6000, 64))
    flat /= np.linalg.norm(flat, axis=1, keepdims=True)
    axes = np.linalg.eigh(flat.T @ flat)[1][:, ::-1]
    finished = vx.best_in_chunks(ids[:400], flat[:400] @ axes, np.full(400, -np.inf), ids, flat @ axes, 10)[1]
    assert finished - 400 * vx.CHUNK_ROWS < 0.03 * 400 * len(ids)


def test_floors_ties_and_copies_in_chunks(monkeypatch):
    monkeypatch.setattr(vx, "CHUNK_ROWS", 16)
    rng = np.random.default_rng(5)
    vectors = rng.integers(-2, 3, size=(200, 6)).astype(float)  # many equal scores
    vectors[120:] = vectors[0]
    ids = np.arange(200) * 3
    scores = vectors[:50] @ vectors.T
    best = np.argsort(-scores, axis=1, kind="stable")[:, :7]
    found, _ = vx.best_in_chunks(ids[:50], vectors[:50], np.full(50, -np.inf), ids, vectors, 7)
    assert found["question_id"].to_numpy().reshape(50, 7).tolist() == (best * 3).tolist()
    # rows below a floor are left out, rows on it stay
    floors = np.sort(scores, axis=1)[:, -3]
    found, _ = vx.best_in_chunks(ids[:50], vectors[:50], floors, ids, vectors, 7)
    for q in range(50):
        own = found[found["query_id"] == 3 * q]
        at_floor = [int(3 * i) for i in best[q] if scores[q, i] >= floors[q]]
        assert own["question_id"].tolist()[:len(at_floor)] == at_floor


def test_principal_axes_are_orthogonal_and_bounded(spark, data, monkeypatch):
    df, unit = data
    axes = vx.principal_axes(df)
    assert np.allclose(axes.T @ axes, np.eye(8)) and axes.shape == (8, 8)
    energy = ((unit @ axes) ** 2).sum(axis=0)
    assert (np.diff(energy) <= 1e-9).all()
    monkeypatch.setattr(vx, "MAX_AXES", 4)
    assert vx.principal_axes(df) is None
    assert vx.principal_axes(df.limit(0)) is None


def by_hand(rows, k, inside=None):
    """Best ``k`` other rows of every row by rounded score and then place."""
    scores = np.round(rows @ rows.T, 9)
    np.fill_diagonal(scores, -np.inf)
    if inside is not None:
        scores[~inside] = -np.inf
    return [[int(j) for j in np.lexsort((np.arange(len(rows)), -s))[:k] if np.isfinite(s[j])] for s in scores]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_blocks_of_both_sides_meet_without_copies(spark, monkeypatch, kind):
    """Every vector is packed once, and blocks are copied for the parts of the other side only, however many they are."""
    rng = np.random.default_rng(31)
    rows = rng.integers(-3, 4, size=(500, 6)).astype("float32").astype("float64")  # many ties, lengths that differ
    rows[480:] = 0
    rows[:40] *= 1e-4
    monkeypatch.setattr(vx, "PAIR_ROWS", 40)
    monkeypatch.setattr(vx, "HELD_BYTES", 1000)
    monkeypatch.setattr(vx, "QUERY_BLOCK", 16)
    monkeypatch.setattr(vx, "CHUNK_ROWS", 16)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], f"id long, embedding array<{kind}>")
    index = vx.build_vector_index(df, cells=20)
    blocks = vx._packed(index.vectors.select("id", "embedding", "cell"), ["cell"], "cell", 500).blocks.collect()
    ids = np.concatenate([np.frombuffer(b["ids"], np.int64) for b in blocks])
    assert sorted(ids) == list(range(500)) and max(len(b["ids"]) // 8 for b in blocks) <= 40
    found = vx.knn_by_bounds(queries_of(df), index, 5, skip_self=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "CoGroups" not in plan
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["question_id"])
    assert [got[i] for i in range(500)] == by_hand(rows, 5)


def test_vectors_of_unequal_length_do_not_pass(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0], 0)], "id long, embedding array<double>, cell int").repartition(1)
    with pytest.raises(Exception, match="unequal length"):
        vx._packed(df, ["cell"], "cell", 2).blocks.collect()


def test_clustering_into_many_cells_compares_a_vector_with_few(spark, monkeypatch):
    """Cells beyond some hundred start from two levels and then settle over all vectors as in one."""
    unit = np.random.default_rng(4).normal(size=(900, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "id long, embedding array<double>")
    asked, kmeans = [], vx.KMeans
    monkeypatch.setattr(vx, "KMeans", lambda k, **options: asked.append(k) or kmeans(k=k, **options))
    index = vx.build_vector_index(df, cells=300)
    assert asked == [18] and 250 < index.centroids.count() <= 320
    centers = np.array([r["centroid"] for r in index.centroids.orderBy("cell").collect()])
    cells = np.array([r["cell"] for r in index.vectors.orderBy("id").collect()])
    assert len(cells) == 900 and cells.tolist() == np.round(unit @ centers.T, 9).argmax(axis=1).tolist()
    # as close as the clustering of all at once
    whole = np.array(kmeans(k=300, distanceMeasure="cosine", maxIter=10, seed=42).fit(df.select(array_to_vector("embedding").alias("features"))).clusterCenters())
    own = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    assert (own @ centers.T).max(axis=1).mean() > (own @ (whole / np.linalg.norm(whole, axis=1, keepdims=True)).T).max(axis=1).mean() - 0.005


def test_probed_cells_finish_few_inner_products():
    """Of the cells that a query probes only vectors that reach its k-th score are finished, and no others are found."""
    rng = np.random.default_rng(12)
    rows = rng.normal(size=(6000, 16))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    cells, ids = rng.integers(0, 40, 6000), np.arange(6000)
    probed = rng.random((300, 40)) < 0.5
    best = vx._Best(ids[:300], rows[:300], np.full(300, -np.inf), 10)
    met = vx._Rows(ids, rows)
    for at in range(0, 6000, vx.CHUNK_ROWS):
        best.meet(met, slice(at, at + vx.CHUNK_ROWS), cells, probed)
    scores = np.where(probed[:, cells], np.round(rows[:300] @ rows.T, 9), -np.inf)
    expected_ids = np.argsort(-scores, axis=1, kind="stable")[:, :10]
    assert best.hits()["question_id"].to_numpy().reshape(300, 10).tolist() == expected_ids.tolist()
    assert best.finished - 300 * vx.CHUNK_ROWS < 0.05 * 300 * 6000


def test_blocks_bring_the_centroids_of_their_own_cells(spark):
    """With very many cells no task that scores vectors holds all centroids."""
    rows = [(i, [float(i), 1.0], i // 3) for i in range(300)]
    centers = [(c, [float(c), -1.0]) for c in range(100)]
    placed = spark.createDataFrame(rows, "id long, embedding array<float>, cell int").join(
        spark.createDataFrame(centers, "cell int, centroid array<double>"), "cell").repartition(4, "cell")
    seen = 0
    for b in vx._packed(placed.select("id", "embedding", "cell", "centroid"), ["cell"], "cell", 300).blocks.collect():
        cells = np.unique(np.frombuffer(b["cell"], np.int32))
        assert np.frombuffer(b["centers"]).reshape(-1, 2).tolist() == [[float(c), -1.0] for c in cells]
        seen += len(cells)
    assert seen == 100
