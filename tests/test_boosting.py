import numpy as np
import pytest
from pyspark.sql import functions as F

from nearkin.operators import boosting as B
from nearkin.plans import training

NAMES = ["a", "b", "c"]


def planted(n=900, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(2)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > -0.1)) ^ (rng.random(n) < 0.1)
    return [(i, int(t), i % 4 == 0, *map(float, v)) for i, (v, t) in enumerate(zip(x, y))]


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, y int, held boolean, a double, b double, c double")


def brute(rows, settings, weight):
    """The same boosting on raw values, by loops over rows and cuts, all rows and columns drawn."""
    train = [(r[1], r[3:]) for r in rows if not r[2]]
    edges = []
    for f in range(3):
        v = sorted(x[f] for _, x in train)
        edges.append(sorted({v[max(0, int(np.ceil(i / settings.bins * len(v))) - 1)] for i in range(1, settings.bins)}))
    margin = [0] * len(train)
    trees = []
    for _ in range(settings.rounds):
        gh = []
        for (y, _), m in zip(train, margin):
            p, w = 1 / (1 + np.exp(-m / B.UNIT)), weight if y else 1.0
            gh.append((np.rint(w * (p - y) * B.UNIT), np.rint(w * p * (1 - p) * B.UNIT)))

        def total(members):
            return sum(gh[i][0] for i in members), sum(gh[i][1] for i in members)

        def value(members):
            g, h = total(members)
            return int(np.rint(-g / (h + settings.ridge * B.UNIT) * settings.rate * B.UNIT))

        def grown(members, depth):
            g, h = (t / B.UNIT for t in total(members))
            best = (1e-9, None)
            for f in range(3):
                for e in edges[f]:
                    left = [i for i in members if train[i][1][f] <= e]
                    gl, hl = (t / B.UNIT for t in total(left)) if left else (0, 0)
                    if hl < settings.least_curvature or h - hl < settings.least_curvature:
                        continue
                    gain = gl**2 / (hl + 1) + (g - gl)**2 / (h - hl + 1) - g**2 / (h + 1)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, e))
            if depth == settings.depth or best[1] is None:
                for i in members:
                    margin[i] += value(members)
                return ("leaf", value(members))
            f, e = best[1]
            return (f, e, grown([i for i in members if train[i][1][f] <= e], depth + 1), grown([i for i in members if train[i][1][f] > e], depth + 1))

        trees.append(grown(list(range(len(train))), 0))
    return trees


def shape(tree, edges, node=0):
    if tree.feature[node] < 0:
        return ("leaf", tree.value[node])
    f, first = tree.feature[node], tree.left[node]
    return (f, edges[f][tree.cut[node]], shape(tree, edges, first), shape(tree, edges, first + 1))


def test_trees_equal_brute_force(spark):
    rows = planted(240)
    settings = B.Settings(rounds=4, depth=3, row_share=1.0, column_share=1.0, bins=8, positive_weight=1.25, rate=0.3, least_curvature=2.0)
    model = B.train(table(spark, rows).repartition(3), NAMES, "y", "held", settings)
    assert [shape(t, model.edges) for t in model.trees] == brute(rows, settings, 1.25)[:len(model.trees)]


def test_model_does_not_depend_on_partitions_or_refresh(spark, monkeypatch):
    df = table(spark, planted())
    settings = B.Settings(rounds=7, depth=4, bins=32, rate=0.3, patience=50)
    one = B.train(df.coalesce(1), NAMES, "y", "held", settings)
    monkeypatch.setattr(B, "REFRESH", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 50)
    monkeypatch.setattr(B, "DIRECT_PARTS", 1)
    two = B.train(df.repartition(6), NAMES, "y", "held", settings)
    assert [t.__dict__ for t in one.trees] == [t.__dict__ for t in two.trees] and one.aucs == two.aucs


def exact_auc(scored):
    rows = scored.select("y_true", "y_prob").collect()
    pos, neg = ([r["y_prob"] for r in rows if r["y_true"] == y] for y in (1, 0))
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / len(pos) / len(neg)


def test_boosting_stops_at_the_best_validation_auc(spark, tmp_path):
    df = table(spark, planted())
    model = B.train(df, NAMES, "y", "held", B.Settings(rounds=60, depth=3, bins=32, rate=0.5, patience=5))
    assert len(model.aucs) < 60
    best = max(range(len(model.aucs)), key=lambda i: (model.aucs[i], -i))
    assert len(model.trees) == best + 1 == len(model.aucs) - 5
    held = model.score(df, "y").filter("held")
    assert exact_auc(held) == pytest.approx(model.aucs[best], abs=2e-3) and model.aucs[best] > 0.85
    model.save(str(tmp_path / "m"), spark)
    again = B.BoostedTrees.load(str(tmp_path / "m"), spark)
    assert again.score(df, "y").orderBy("id").collect() == model.score(df, "y").orderBy("id").collect()
    shares = {r["feature"]: r["importance"] for r in training.feature_importance(model, spark).collect()}
    assert sum(shares.values()) == pytest.approx(1) and shares["c"] < min(shares["a"], shares["b"])


def test_column_mask_and_row_draw():
    settings = B.Settings()
    masks = [B.columns_of(r, 12, settings) for r in range(50)]
    assert {len(m) for m in masks} == {10} and len({tuple(m) for m in masks}) > 20
    keys = np.arange(100_000, dtype=np.int64)
    first, second = B.drawn(keys, 0.8, 1), B.drawn(keys, 0.8, 2)
    assert abs(first.mean() - 0.8) < 0.01 and abs((first & second).mean() - 0.64) < 0.01


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(i, i % 2, None, None if i % 5 == 0 else nan if i % 5 == 1 else float(i % 2), 1.0, None) for i in range(60)] + [(99, None, False, 1.0, 1.0, 1.0)]
    df = table(spark, rows)
    model = training.train_boosted_trees(df, NAMES, "held", "y", rounds=3, depth=2, column_share=1.0)
    assert len(model.trees) == 3 and model.aucs == [None] * 3
    found = model.score(df, "y").agg(F.count("*"), F.min("y_prob"), F.max("y_prob")).first()
    assert found[0] == 61 and 0 < found[1] < found[2] < 1
    none = training.train_boosted_trees(df.limit(0), NAMES, None, "y", rounds=2)
    assert none.score(df, "y").select("y_prob").distinct().collect() == [(0.5,)]
