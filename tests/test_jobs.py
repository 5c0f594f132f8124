"""Upkeep, streams and models end to end."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearkin import schemas
from nearkin.functions.encoders import batch_encoder, batch_scorer, hashed_encoder
from nearkin.operators import maintain, quality, vectors
from nearkin.plans import search, training
from nearkin.sources import tables, versions
from nearkin.streaming import batches, ingest, monitoring, reuse

ENCODER = hashed_encoder(32)


def questions(spark, n=60):
    rows = [(i, f"question number {i} about topic {i % 7}") for i in range(n)]
    return tables.questions_from_corpus(spark.createDataFrame(rows, schemas.CORPUS))


def test_rebuild_add_and_grow(spark, tmp_path):
    root = str(tmp_path / "index")
    assert maintain.full_rebuild(spark, questions(spark), ENCODER, root, cells=4) == 1
    index, rows, manifest = versions.read_version(spark, root)
    assert tuple(quality.index_reconcile(rows, index.vectors).first()) == (60, 60, 0, 0, 0)
    assert not maintain.growth_report(spark, root).first()["rebuild"]
    new = spark.createDataFrame(
        [(5, "old wording", 1), (5, "entirely new wording", 2)] + [(100 + i, f"fresh {i}", 1) for i in range(7)],
        "question_id long, question_text string, seq int")
    assert maintain.incremental_add(spark, root, new, ENCODER, ["seq"]) == 1
    index, rows, manifest = versions.read_version(spark, root)
    assert tuple(quality.index_reconcile(rows, index.vectors).first()) == (67, 67, 0, 0, 0)
    changed = rows.filter("question_id = 5").first()
    assert (changed["question_text"], changed["source"]) == ("entirely new wording", "new_batch")
    report = maintain.growth_report(spark, root).first()
    assert (report["built_n"], report["n"], report["rebuild"]) == (60, 67, True)
    queries = search.encode_queries(spark.createDataFrame([(0, "entirely new wording")], "query_id long, query_text string"), ENCODER)
    assert search.find_similar(queries, index, rows, 1, 0.5).first()["question_id"] == 5
    second = spark.createDataFrame([(5, "third wording"), (200, "another")], "question_id long, question_text string")
    assert maintain.incremental_add(spark, root, second, ENCODER) == 2
    index, rows, manifest = versions.read_version(spark, root)
    assert tuple(quality.index_reconcile(rows, index.vectors).first()) == (68, 68, 0, 0, 0)
    assert rows.filter("question_id = 5").first()["question_text"] == "third wording"
    # parts without manifest are invisible
    rows.write.parquet(f"{root}/v=9/questions")
    rows.write.parquet(f"{root}/v=1/add=3/questions")
    assert versions.versions(spark, root) == [1] and versions.next_version(spark, root) == 10
    assert versions.read_version(spark, root)[2].first()["n"] == 68
    # a rebuild starts from the merged rows and becomes the newest version
    assert maintain.full_rebuild(spark, rows, ENCODER, root, cells=4) == 10
    index, rows, manifest = versions.read_version(spark, root)
    assert (manifest.first()["built_n"], rows.count()) == (68, 68)


def test_drift(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.8, 0.6])]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    center = spark.createDataFrame([([1.0, 0.0],)], "centroid array<double>")
    r = maintain.detect_drift(df, center).first()
    assert (r["mean_similarity"], r["drift_detected"], r["n_new_questions"]) == (0.9, False, 2)
    assert maintain.detect_drift(df, center, 0.95).first()["drift_detected"]


def write_json(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_ingest_numbers_rows_once(spark, tmp_path):
    empty = questions(spark, 1).limit(0)
    encoded = ENCODER(questions(spark), "question_text", "embedding").select(F.col("question_id").alias("id"), "embedding")
    index = vectors.build_vector_index(encoded, cells=3)
    root, source = str(tmp_path / "out"), tmp_path / "in"
    target = ingest.IngestTarget.after(empty, root, index.centroids, ENCODER)
    assert (target.first_id, target.first_vec_id) == (1, 0)
    write_json(source, "1.json", [{"n": i, "question_text": f"streamed question {i}"} for i in range(10)] + [{"n": 99, "question_text": "x"}])
    stream = lambda: spark.readStream.schema("n int, question_text string").json(str(source))
    ingest.start_ingest(stream(), target, f"{root}/cp", ["n"], available_now=True).awaitTermination()
    write_json(source, "2.json", [{"n": i, "question_text": f"later question {i}"} for i in range(5)])
    ingest.start_ingest(stream(), target, f"{root}/cp", ["n"], available_now=True).awaitTermination()
    stored = batches.rows_of(spark, root, "questions").orderBy("question_id")
    first = [(r["question_id"], r["vec_id"], r["question_text"]) for r in stored.collect()]
    assert [x[:2] for x in first] == [(i + 1, i) for i in range(15)] and first[10][2] == "later question 0"
    assert batches.rows_of(spark, root, "rejects").count() == 1
    # replaying either micro-batch changes nothing
    for batch_id, name in ((0, "1.json"), (1, "2.json")):
        again = spark.read.schema("n int, question_text string").json(str(source / name))
        ingest.ingest_batch(again.repartition(3), batch_id, target, ["n"])
    assert [(r["question_id"], r["vec_id"], r["question_text"]) for r in stored.collect()] == first
    both, rows = ingest.with_ingested(index, questions(spark), root)
    queries = search.encode_queries(spark.createDataFrame([(0, "later question 3")], "query_id long, query_text string"), ENCODER)
    assert search.find_similar(queries, both, rows, 1, 0.9).first()["question_text"] == "later question 3"


def test_feedback_and_windows_on_a_stream(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    write_json(source, "1.json", [
        {"query": "q", "retrieved_question_id": 1, "is_relevant": True, "user_rating": 5},
        {"query": "q", "retrieved_question_id": 1, "is_relevant": False},
        {"query": "q", "retrieved_question_id": 1, "is_relevant": True, "user_rating": 10}])
    stream = spark.readStream.schema(schemas.FEEDBACK).json(str(source))
    monitoring.start_feedback(stream, root, f"{root}/cp", available_now=True).awaitTermination()
    assert tuple(monitoring.feedback_rates(batches.rows_of(spark, root, "feedback")).first()) == (1, 2, 0.5, 5.0)
    assert batches.rows_of(spark, root, "feedback_rejects").first()["reject_reason"] == ["rating_out_of_range"]

    clicks, out = tmp_path / "clicks", str(tmp_path / "clicks_out")
    event = lambda hour, kind: {"ts": f"2024-01-0{1 + hour // 24}T{hour % 24:02d}:00:00Z", "event_type": kind}
    write_json(clicks, "1.json", [event(1, "view")] * 10 + [event(2, "click")])
    for extra in ([], [event(3, "click")] * 2 + [event(30, "view")]):
        if extra:
            write_json(clicks, "2.json", extra)
        stream = spark.readStream.schema("ts timestamp, event_type string").json(str(clicks))
        batches.keep_updates(monitoring.click_through_by_window(stream), out, "ctr", f"{out}/cp", available_now=True).awaitTermination()
    rows = batches.latest_updates(spark, out, "ctr", "window_start").orderBy("window_start").collect()
    assert [(r["n_shown"], r["n_clicked"], r["alert"]) for r in rows] == [(10, 3, False), (1, 0, True)]


LOG = "query_id long, ts timestamp, query_embedding array<double>"


def brute_links(rows, threshold):
    out = {}
    for query_id, ts, v in rows:
        earlier = sorted((t, i) for i, t, w in rows if (t, i) < (ts, query_id) and round(float(np.dot(v, w)), 9) >= threshold)
        out[query_id] = earlier[0][1] if earlier else None
    return out


def test_reuse_links(spark):
    import datetime as dt
    rng = np.random.default_rng(5)
    raw = rng.normal(size=(400, 3))
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=int(rng.integers(0, 900))), v.tolist()) for i, v in enumerate(unit)]
    df = spark.createDataFrame(rows, LOG).repartition(6)
    for threshold in (0.9, 0.99):
        links = reuse.link_queries(df, df, threshold)
        assert {r["query_id"]: r["matched_query_id"] for r in links.collect()} == brute_links(rows, threshold)
    assert reuse.reuse_summary(links).first()["n_queries"] == 400

    ranked = spark.createDataFrame([(1, 1, 70, 0.9), (1, 2, 71, 0.8), (3, 1, 72, 0.7)], schemas.RANKED)
    links = spark.createDataFrame([(1, None), (2, 1), (3, None)], "query_id long, matched_query_id long")
    assert sorted((r["query_id"], r["question_id"]) for r in reuse.reused_results(links, ranked, 1).collect()) == [(1, 70), (2, 70), (3, 72)]


def test_reuse_stream_looks_back_over_batches(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    rows = [(1, [0.8, 0.6]), (2, [0.79, 0.613]), (3, [0.28, 0.96]), (4, [-1.0, 0.0]), (5, [0.3, 0.954])]
    for n, part in enumerate((rows[:1], rows[1:3], rows[3:])):
        write_json(source, f"{n}.json", [{"query_id": i, "ts": f"2024-01-01T00:0{i}:00Z", "query_embedding": v} for i, v in part])
        reuse.start_reuse(spark.readStream.schema(LOG).json(str(source)), root, f"{root}/cp", available_now=True).awaitTermination()
    got = {r["query_id"]: r["matched_query_id"] for r in batches.rows_of(spark, root, "links").collect()}
    assert got == {1: None, 2: 1, 3: None, 4: None, 5: 3}


def test_model_hooks(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = batch_encoder(load)(spark.createDataFrame([("abc",), (None,)], "t string"), "t", "v")
    lengths = [float(np.linalg.norm(r["v"])) for r in df.collect()]
    assert lengths == pytest.approx([1.0, 1.0])
    scorer = batch_scorer(lambda: lambda pairs: np.array([float(a == b) for a, b in pairs]))
    scored = spark.createDataFrame([("a", "a"), ("a", "b")], "q string, t string").select(scorer(F.col("q"), F.col("t")).alias("s"))
    assert [r["s"] for r in scored.collect()] == [1.0, 0.0]


def planted(spark, n=400):
    rng = np.random.default_rng(6)
    y = (rng.random(n) < 0.37).astype(int)
    x1, x2 = rng.normal(size=n) + 1.5 * y, rng.normal(size=n)
    split = np.where(np.arange(n) % 5 == 0, "test", "train")
    rows = [(int(i), float(a), float(b), int(c), str(s)) for i, (a, b, c, s) in enumerate(zip(x1, x2, y, split))]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, is_duplicate int, split string"), x1, x2, y, split


def test_logistic_regression_equals_newton(spark, tmp_path):
    df, x1, x2, y, split = planted(spark)
    model = training.train_logistic_regression(df.filter("split = 'train'"), ["x1", "x2"])
    rows = split == "train"
    x = np.column_stack([x1, x2])[rows]
    x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    x, t = np.column_stack([x, np.ones(len(x))]), y[rows]
    n = len(t)
    w = np.where(t == 1, n / (2 * t.sum()), n / (2 * (n - t.sum())))
    beta = np.zeros(3)
    penalty = np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (w * (p - t)) + penalty @ beta
        beta -= np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + penalty, gradient)
    fitted = model.model.stages[-1]
    assert [*fitted.coefficients, fitted.intercept] == pytest.approx(beta.tolist(), abs=1e-4)
    model.save(str(tmp_path / "lr"))
    again = training.PairModel.load("logistic_regression", str(tmp_path / "lr"))
    table = training.evaluate_models([model, training.PairModel("copy", again.model, again.features)], df)
    values = {(r["model"], r["split"], r["metric"]): r["value"] for r in table.collect()}
    assert values["logistic_regression", "test", "auc_roc"] > 0.7
    assert values["logistic_regression", "test", "f1"] == values["copy", "test", "f1"]
    tables.write_summary(table, str(tmp_path / "summary"))
    assert spark.read.json(str(tmp_path / "summary")).count() == 20


def test_boosted_trees_find_the_signal(spark):
    df = planted(spark)[0].withColumn("held_out", F.col("id") % 7 == 0)
    model = training.train_boosted_trees(df.filter("split = 'train'"), ["x1", "x2"], "held_out", rounds=8, depth=3, column_share=1.0)
    assert training.feature_importance(model, spark).first()["feature"] == "x1"
    metrics = training.evaluate_models([model], df).filter("metric = 'auc_roc' and split = 'test'")
    assert metrics.first()["value"] > 0.7


def test_vocabulary_comes_from_training_rows_only(spark):
    rows = [("train", "alpha beta", "alpha gamma", 1), ("train", "delta", "delta beta", 0), ("test", "omega", "omega", 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pair_id long, split string, q1_classical string, q2_classical string, is_duplicate int")
    table, model = training.split_features(df, "pair_id")
    assert "omega" not in {r["term"] for r in model.vocabulary.collect()}
    assert table.filter("split = 'test'").first()["tfidf_cosine"] == 0.0
