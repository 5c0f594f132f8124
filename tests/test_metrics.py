"""Classification and retrieval metrics against direct definitions."""

import math
import random

import pytest

from nearkin.operators import classification as cl
from nearkin.operators import retrieval
from nearkin.plans import evaluation


def brute(rows, threshold=0.5):
    tp = sum(1 for y, p in rows if y and p >= threshold)
    fp = sum(1 for y, p in rows if not y and p >= threshold)
    fn = sum(1 for y, p in rows if y and p < threshold)
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    auc = ap = None
    if pos and neg:
        auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
        ap, last = 0.0, 0.0
        for t in sorted({p for _, p in rows}, reverse=True):
            above = [y for y, p in rows if p >= t]
            ap += (sum(above) / len(pos) - last) * sum(above) / len(above)
            last = sum(above) / len(pos)
    return [round(x, 4) if x is not None else None for x in (precision, recall, f1, auc, ap)]


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        y = int(rng.random() < 0.4)
        group = rng.choice("ab")
        rows.append((i, group, y, round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))), 2)))
    rows += [(1000 + i, "one class", 1, i / 10) for i in range(10)]
    return spark.createDataFrame(rows, "id long, grp string, y_true int, y_prob double"), rows


def test_metrics_with_ties_and_groups(scored):
    df, rows = scored
    m = cl.evaluate_classifier(df).first()
    assert list(m)[1:] == brute([(y, p) for _, _, y, p in rows])
    for r in cl.evaluate_classifier(df, 0.45, ["grp"]).collect():
        assert list(r)[2:] == brute([(y, p) for _, g, y, p in rows if g == r["grp"]], 0.45)
    assert cl.evaluate_classifier(df, by=["grp"]).filter("grp = 'one class'").first()["auc_roc"] is None


def test_threshold_belongs_to_the_positive_side(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.49)], "y_true int, y_prob double")
    assert tuple(cl.confusion_counts(df).first()) == (1, 0, 0, 1)


def test_best_threshold_takes_the_lowest(spark, scored):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.1)], "y_true int, y_prob double")
    # F1 is 0.857 at 0.1 only
    assert tuple(cl.best_threshold(cl.score_curve(df)).first()) == (0.1, 0.8571)
    df = spark.createDataFrame([(0, 0.9), (0, 0.2)], "y_true int, y_prob double")
    assert tuple(cl.best_threshold(cl.score_curve(df)).first()) == (0.2, 0.0)


def test_top_errors_order(spark):
    rows = [(1, 0, 0.9), (2, 0, 0.9), (3, 0, 0.6), (4, 1, 0.1), (5, 1, 0.4), (6, 1, 0.9), (7, 0, 0.1)]
    df = spark.createDataFrame(rows, "id long, y_true int, y_prob double")
    got = [(r["error_type"], r["rank"], r["id"]) for r in cl.top_errors(df, n=2).orderBy("error_type", "rank").collect()]
    assert got == [("false_negative", 1, 4), ("false_negative", 2, 5), ("false_positive", 1, 1), ("false_positive", 2, 2)]


def test_class_report_and_weights(spark, scored):
    df, rows = scored
    report = {r["class_name"]: r for r in cl.class_report(df).collect()}
    assert report["1"]["support"] + report["0"]["support"] == len(rows)
    right = sum((p >= 0.5) == bool(y) for _, _, y, p in rows) / len(rows)
    assert report["accuracy"]["f1"] == round(right, 4)
    w = cl.class_weights(df, "y_true").first()
    assert w["n_neg"] * w["balanced_neg"] + w["n_pos"] * w["balanced_pos"] == pytest.approx(len(rows))


def test_slices_and_gap(spark):
    rows = [("train", "a b", "c", 1, 0.9), ("train", "a b", "c", 0, 0.1), ("val", " ".join("x" * 10), "y " * 9, 1, 0.2), ("val", "w " * 40, "z", 0, 0.8)]
    df = spark.createDataFrame(rows, "split string, question1 string, question2 string, y_true int, y_prob double")
    got = {r["slice"]: r["n"] for r in evaluation.slice_metrics(df).collect()}
    assert got == {"short": 2, "medium": 1, "long": 1}
    assert evaluation.split_gap(df).first()["f1_gap"] == 1.0
    keyed = df.selectExpr("'test' as split", "question1", "question2", "y_true", "y_prob", "hash(question1, y_prob) as id")
    tables = evaluation.deep_evaluation(keyed, "id")
    assert tables["overall"].first()["n"] == 4 and tables["errors"].count() == 2
    rows = {(r["part"], r["item"], r["metric"]): r["value"] for r in evaluation.report_rows(tables).collect()}
    assert {r[0] for r in rows} == {"overall", "slices", "errors", "gap"} and rows["overall", "", "n"] == 4
    assert sum(v for (part, _, metric), v in rows.items() if part == "slices" and metric == "n") == 4


def test_retrieval_worked_example(spark):
    retrieved = [[31, 5, 8], [17, 40, 2], [6, 77, 29], [51, 63, 12], [9, 14, 3]]
    relevant = [[31], [2], [77], [1], [14]]
    hits = spark.createDataFrame([(q, r, i) for q, ids in enumerate(retrieved) for r, i in enumerate(ids, 1)], "query_id long, rank int, question_id long")
    truth = spark.createDataFrame([(q, i) for q, ids in enumerate(relevant) for i in ids * 2], "query_id long, relevant_id long")
    queries = spark.createDataFrame([(q,) for q in range(5)], "query_id long")
    m = retrieval.evaluate_retrieval(queries, hits, truth, (1, 3)).first()
    assert (m["recall_at_1"], m["recall_at_3"], m["mrr"]) == (0.2, 0.8, 0.4667)
    more = spark.createDataFrame([(q,) for q in range(7)], "query_id long")
    assert retrieval.evaluate_retrieval(more, hits, truth).first()["mrr"] == 0.3333
    assert retrieval.evaluate_retrieval(queries.limit(0), hits, truth).first()["mrr"] == 0.0


def test_retrieval_queries_fall_back(spark):
    pairs = spark.createDataFrame([(1, 2, 1), (3, 4, 0)], "qid1 long, qid2 long, is_duplicate int")
    ids = spark.createDataFrame([(i,) for i in range(200, 400)], "question_id long")
    queries, truth = retrieval.retrieval_queries(pairs, ids)
    assert queries.count() == 200 and retrieval.retrieval_queries(pairs, ids, fallback=100)[0].count() == 100 and truth.filter("query_id <> relevant_id").count() == 0
    queries, truth = retrieval.retrieval_queries(pairs, spark.createDataFrame([(2,), (3,)], "question_id long"))
    assert [tuple(r) for r in queries.collect()] == [(2,)] and truth.count() == 2


def test_golden_accuracy(spark):
    rows = [("duplicate", 1, 0.9), ("duplicate", 1, 0.5), ("negation", 0, 0.7), ("unrelated", 0, 0.1)]
    df = spark.createDataFrame(rows, "category string, label int, similarity double")
    got = {r["category"]: r["accuracy"] for r in cl.golden_accuracy(df).collect()}
    assert got == {"duplicate": 1.0, "negation": 0.0, "unrelated": 1.0, "overall": 0.75}


def test_missing_scores_and_groups(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("a", 1, None), ("a", 1, float("nan")), (None, 1, 0.8), (None, 0, 0.2), (None, 0, 0.3)]
    df = spark.createDataFrame(rows, "g string, y_true int, y_prob double")
    got = {r["g"]: (r["n"], r["auc_roc"], r["avg_precision"]) for r in cl.evaluate_classifier(df, by=["g"]).collect()}
    assert got == {"a": (2, 1.0, 1.0), None: (3, 1.0, 1.0)}
    assert {r["g"]: r["n_unscored"] for r in cl.unscored_rows(df, ["g"]).collect()} == {"a": 2, None: 0}
    assert {r["g"] for r in cl.best_threshold(cl.score_curve(df, ["g"]), ["g"]).collect()} == {"a", None}


def test_all_features_are_correlated_with_the_label(spark, sf):
    import numpy as np

    from nearkin.functions.stats import correlation_p_value
    from nearkin.operators.splits import hash_split
    from nearkin.plans import catalog
    from nearkin.schemas import FEATURES

    rows = catalog.feature_rows(hash_split(catalog.labelled_pairs(spark, sf), "pair_id")).toPandas()
    found = {r["feature"]: r for r in catalog.feature_correlations_all(spark, sf).collect()}
    assert list(found) == list(FEATURES) and len(found) == 12
    truth = rows["is_duplicate"].to_numpy(dtype="float64")
    for name, r in found.items():
        values = np.nan_to_num(rows[name].to_numpy(dtype="float64"))
        assert r["n"] == len(rows)
        if values.std() == 0 or truth.std() == 0:
            assert r["r"] is None
            continue
        want = ((values - values.mean()) * (truth - truth.mean())).mean() / (values.std() * truth.std())
        assert r["r"] == pytest.approx(want, abs=1e-6) and r["weak"] == (abs(want) < 0.05)
        # the normal limit of the statistic, a loose bound that a missing or mistaken p-value does not meet
        t = abs(want) * ((len(rows) - 2) / (1 - want * want)) ** 0.5
        assert r["p_value"] == pytest.approx(math.erfc(t / 2 ** 0.5), abs=0.02)
        assert r["p_value"] == pytest.approx(correlation_p_value(want, len(rows)), abs=1e-6)
