
import numpy as np
from helpers import empty
from pyspark.sql import functions as F

from nearkin.llm import kd_search as K


def brute(rows, is_query, k):
    ok = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    found = []
    for i in sorted({i for i, _ in ok if is_query(i)}):
        q = min((v.tolist() for j, v in ok if j == i))
        scored = sorted((-int(np.dot(q, v)), j) for j, v in ok if j != i and len(v) == len(q))[:k]
        found += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    return found


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(K, "SHARD_ROWS", 150)
    monkeypatch.setattr(K, "LEAF_ROWS", 16)
    monkeypatch.setattr(K, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(0, 0.3, 6).round(1).tolist()) for i in range(900)]  # coarse values make ties
    rows += [(2000 + i, rows[3][1]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = sorted(map(tuple, K.top_k(df, F.col("vec_id") % 20 == 0, 20).collect()))
    assert found == brute(rows, lambda i: i % 20 == 0, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], "q"), (1, None, ""), (2, [1.0, None], ""), (3, [nan, 1.0], ""), (4, [inf, 1.0], ""), (5, [0.2, -0.1], ""), (5, [0.2, -0.1], ""),
            (20, [0.1], ""), (40, [3e4, -2e4], ""), (40, [1.0, 1.0], ""), (None, [1.0, 1.0], ""), (60, [], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    found = sorted(map(tuple, K.top_k(df, F.col("vec_id") % 20 == 0, 3).collect()))
    assert found == brute([r[:2] for r in rows], lambda i: i % 20 == 0, 3)
    none = empty(spark, "vec_id long, embedding array<float>")
    assert K.top_k(none, F.col("vec_id") % 20 == 0).count() == 0
    assert K.top_k(df.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_boxes_skip_leaves(monkeypatch):
    """With clusters most leaves are never multiplied."""
    rng = np.random.default_rng(2)
    centers = rng.normal(0, 40, (30, 8))
    rows = np.floor(np.repeat(centers, 200, 0) + rng.normal(0, 1, (6000, 8))).astype(np.int64)
    tree = K.tree_of(np.arange(6000), rows)
    best = K.Best(np.array([-1]), rows[:1], 5)
    offered = []
    add = K.Best.add
    monkeypatch.setattr(K.Best, "add", lambda self, at, scores, ids: (offered.append(1), add(self, at, scores, ids))[1])
    K.visit(tree, best)
    scores = rows @ rows[0]
    want = np.lexsort((np.arange(6000), -scores))[:5]
    assert best.found[0].tolist() == want.tolist() and best.scores[0].tolist() == scores[want].tolist()
    assert len(offered) < len(K.leaves(rows)) / 2
