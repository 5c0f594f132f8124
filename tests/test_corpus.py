"""Pairs, corpus, splits, ids, quality gate and request rules."""

import math
from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from nearkin import schemas
from nearkin.operators import corpus, explore, features, quality, ranking, requests, splits
from nearkin.functions.stats import correlation_p_value
from nearkin.plans import prepare
from nearkin.sources import tables

FLAT = [(" a? ", "b", 1, 0), ("b", "c", 0, 1), (None, "d", 1, 2), ("  ", "e", 0, 3), ("c", "a?", None, 4)]


def flat(spark):
    return spark.createDataFrame(FLAT, schemas.PAIRS_FLAT)


def test_flat_pairs_and_corpus(spark):
    normalized = corpus.normalize_pairs(flat(spark))
    pairs = corpus.build_pairs(normalized).orderBy("qid1").collect()
    assert [tuple(r) for r in pairs] == [(0, 1, "a?", "b", 1), (2, 3, "b", "c", 0), (8, 9, "c", "a?", 0)]
    stored = {r["question_text"]: r["question_id"] for r in corpus.build_corpus(normalized).collect()}
    assert stored == {"a?": 0, "b": 1, "c": 3, "d": 5, "e": 7}
    fixed = corpus.canonicalize_ids(corpus.build_pairs(normalized), corpus.build_corpus(normalized))
    assert sorted((r["qid1"], r["qid2"]) for r in fixed.collect()) == [(0, 1), (1, 3), (3, 0)]


def test_row_numbers_replace_a_missing_idx(spark):
    df = spark.createDataFrame([(f"q{i}", f"r{i}", 1) for i in range(50)], "question1 string, question2 string, label int").repartition(5)
    ids = sorted(r["qid1"] for r in corpus.normalize_pairs(df).collect())
    assert ids == [4 * i for i in range(50)]


def test_nested_pairs(spark):
    rows = [(((7, 8), (" x ", "y")), True), (((7, 9), ("other", "y")), False)]
    df = spark.createDataFrame(rows, schemas.PAIRS_NESTED).coalesce(1)
    normalized = corpus.normalize_pairs(df)
    assert sorted(tuple(r) for r in corpus.build_pairs(normalized).collect()) == [(7, 8, "x", "y", 1), (7, 9, "other", "y", 0)]
    stored = {(r["question_id"], r["question_text"]) for r in corpus.build_corpus(normalized, one_text_per_id=True).collect()}
    assert stored == {(7, "x"), (8, "y")}


def test_cleaning_reports_dropped_rows(spark):
    df = spark.createDataFrame([(1, 2, "Hi there", "<b></b>", 1), (3, 4, "A", "B", 0)], schemas.PAIRS)
    seen = Observation("cleaning")
    assert corpus.apply_cleaning(df, "transformer", seen).count() == 1
    assert seen.get == {"rows_in": 2, "rows_dropped": 1}
    assert corpus.clean_pairs(df).columns[-4:] == ["q1_classical", "q2_classical", "q1_transformer", "q2_transformer"]
    assert [tuple(r) for r in corpus.training_examples(corpus.clean_pairs(df)).collect()] == [("A", "B", 0.0)]


def labelled(spark, n=997, positives=370):
    rows = [(2 * i, 2 * i + 1, f"text {i}", f"other {i}", int(i < positives)) for i in range(n)]
    return spark.createDataFrame(rows, schemas.PAIRS)


def test_stratified_split_is_exact(spark):
    got = Counter((r["split"], r["is_duplicate"]) for r in splits.stratified_split(labelled(spark), "qid1").collect())
    test = got["test", 0] + got["test", 1]
    assert test == math.ceil(0.15 * 997)
    assert got["val", 0] + got["val", 1] == math.ceil((997 - test) * 0.05 / 0.85)
    for part in ("train", "val", "test"):
        size = got[part, 0] + got[part, 1]
        assert abs(got[part, 1] - size * 370 / 997) <= 1


def test_hash_split_is_stable_and_close(spark):
    df = splits.hash_split(labelled(spark, 5000, 1800), "qid1")
    got = Counter(r["split"] for r in df.collect())
    assert abs(got["test"] / 5000 - 0.15) < 0.02 and abs(got["val"] / 5000 - 0.05) < 0.01
    part = splits.hash_split(labelled(spark, 100, 36), "qid1").join(df.select("qid1", F.col("split").alias("s2")), "qid1")
    assert part.filter("split <> s2").count() == 0


def test_dense_index_and_latest(spark):
    df = spark.createDataFrame([(i, (i * 7919) % 1000) for i in range(1000)], "a int, b int").repartition(7)
    rows = ranking.dense_index(df, ["b"]).collect()
    assert all(r["row_index"] == r["b"] for r in rows) and len(rows) == 1000
    log = spark.createDataFrame([(1, 1, "x"), (1, 3, "z"), (1, 2, "y"), (2, 1, None)], "k int, seq int, v string")
    assert {tuple(r) for r in ranking.latest_per_key(log, "k", ["seq"]).collect()} == {(1, 3, "z"), (2, 1, None)}


def test_top_n_by_count(spark):
    df = spark.createDataFrame([(f"t{i:04d}", 1 + (i * 31) % 500) for i in range(3000)], "term string, cf long")
    for n in (1, 7, 1000, 5000):
        got = [tuple(r) for r in ranking.top_n_by_count(df, "cf", n, "term").collect()]
        assert got == sorted(map(tuple, df.collect()), key=lambda r: (-r[1], r[0]))[:n]


def test_quality_report_finds_planted_faults(spark):
    rows = [("train", "a", "b", 1), ("train", "a", "b", 1), ("test", "B", "A", 1), ("test", " ", "x", 1), ("test", "a", "fresh", 0)]
    df = spark.createDataFrame(rows, "split string, question1 string, question2 string, is_duplicate int")
    report = {(r["check"], r["split"]): r for r in quality.quality_report(df).collect()}
    assert not report["blank_texts", "question1"]["passed"] and report["blank_texts", "question2"]["passed"]
    assert report["duplicate_pairs", "train"]["value"] == 1 and report["duplicate_pairs", "train"]["passed"]
    assert not report["positive_rate", "train"]["passed"]
    assert report["pair_leakage", "train/test"]["value"] == 2
    assert report["question_overlap", "train/test"]["value"] == round(1 / 6, 6)


def test_reconcile(spark):
    questions = spark.createDataFrame([(1,), (2,), (3,), (3,)], "question_id long")
    vectors = spark.createDataFrame([(2,), (3,), (9,)], "id long")
    assert tuple(quality.index_reconcile(questions, vectors).first()) == (4, 3, 1, 1, 1)
    assert {tuple(r) for r in quality.unmatched_ids(questions, vectors).collect()} == {(1, "vectors"), (9, "questions")}


def test_correlations(spark):
    rows = [(i, float(i), 5.0, float("nan") if i % 3 else 1.0, int(i > 20)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, rising double, flat double, holes double, y int")
    got = {r["feature"]: r for r in features.feature_label_correlations(df, "y", ["rising", "flat", "holes"]).collect()}
    assert got["rising"]["r"] > 0.8 and got["rising"]["p_value"] < 1e-8 and not got["rising"]["weak"]
    assert got["flat"]["r"] is None
    assert got["holes"]["weak"] and got["holes"]["p_value"] > 0.5
    # two-sided t test: r = 0.5, n = 12 gives t = 1.8257 with 10 degrees of freedom
    assert correlation_p_value(0.5, 12) == pytest.approx(0.0978, abs=1e-3)
    assert correlation_p_value(0.0, 12) == pytest.approx(1.0)


def test_request_rules(spark):
    texts = ["ok text", "ab", "   ", "x" * 1000, "x" * 1005, None, "  pad  "]
    df = spark.createDataFrame([(t, None, None) for t in texts], schemas.REQUESTS)
    rows = requests.validate_requests(df).collect()
    assert [r["reject_reason"] for r in rows] == [
        [], ["question_too_short"], ["question_blank"], [], ["question_too_long"], ["question_too_short", "question_blank"], []]
    assert rows[0]["top_k"] == 5 and rows[0]["score_threshold"] == 0.3 and rows[6]["question"] == "pad"
    df = spark.createDataFrame([("abc", k, t) for k, t in [(0, 0.5), (20, 1.0), (21, -0.1)]], schemas.REQUESTS)
    assert [len(r["reject_reason"]) for r in requests.validate_requests(df).collect()] == [1, 0, 2]
    batches = spark.createDataFrame([("a", ["q"] * 100, None, None), ("b", ["q"] * 101, None, None), ("c", [], None, None)], schemas.BATCH_REQUESTS)
    checked = requests.validate_batches(batches)
    assert [r["batch_id"] for r in requests.accepted(checked).collect()] == ["a"]
    assert requests.quarantined(checked).count() == 2
    feedback = spark.createDataFrame([("q", 1, True, 5), ("q", 1, False, None), ("q", 1, True, 10)], schemas.FEEDBACK)
    assert requests.accepted(requests.validate_feedback(feedback)).count() == 2


def test_request_summary(spark):
    rows = [(200 if i % 10 else 500, float(i), i < 15) for i in range(20)]
    df = spark.createDataFrame(rows, "status int, latency_ms double, was_cached boolean")
    r = requests.request_summary(df).first()
    assert (r["cache_hits"], r["cache_misses"], r["cache_hit_rate"], r["success_rate"]) == (15, 5, 0.75, 0.9)
    assert (r["p50"], r["p95"]) == (9.5, 18.05)
    assert requests.request_summary(df.limit(0)).first()["cache_hit_rate"] == 0.0
    assert requests.approximate_latency(df).first()["p50"] == pytest.approx(9.5, abs=0.6)
    batch = spark.createDataFrame([(["a", "b", "c", "d"], 10.0)], "questions array<string>, elapsed_ms double")
    assert requests.per_query_latency(batch).first()["latency_ms"] == 2.5


def test_exploration(spark):
    rows = [(1, "the red car is fast", "red car"), (1, "red car", "blue"), (0, "word " * 60, "a")]
    df = spark.createDataFrame(rows, "is_duplicate int, q1 string, q2 string")
    top = explore.top_bigrams(df, "q1", "q2", k=1).filter("is_duplicate = 1").first()
    assert (top["bigram"], top["n"]) == ("red car", 3)
    bins = {(r["is_duplicate"], r["side"], r["n_words"]): r["n"] for r in explore.length_histogram(df, "q1", "q2").collect()}
    assert bins[0, "q1", 50] == 1 and bins[1, "q2", 1] == 1


def test_prepare_and_files(spark, tmp_path):
    rows = [(f"Text <b>{i}</b>", f"other {i % 20}", i % 2, i) for i in range(200)]
    done = prepare.prepare(spark.createDataFrame(rows, schemas.PAIRS_FLAT), exact=True, canonical_ids=True)
    tables.write_splits(done.splits, str(tmp_path / "splits"))
    assert tables.read_splits(spark, str(tmp_path / "splits")).count() == 200
    assert tables.read_splits(spark, str(tmp_path / "splits"), "test").count() == 30
    tables.write_corpus(done.corpus.select("question_id", "question_text"), str(tmp_path / "corpus"))
    assert spark.read.parquet(str(tmp_path / "corpus")).count() == 220
    with pytest.raises(ValueError):
        tables.write_corpus(done.corpus.drop("question_id"), str(tmp_path / "x"))
    feedback = spark.createDataFrame([("q", 1, True, 5)], schemas.FEEDBACK)
    for _ in range(2):
        tables.append_feedback(feedback, str(tmp_path / "feedback"))
    stored = spark.read.parquet(str(tmp_path / "feedback"))
    assert stored.count() == 2 and stored.select("id").distinct().count() == 2
    source = tables.read_pairs_source(spark, str(tmp_path / "absent.parquet"), str(tmp_path / "splits"))
    assert source.count() == 200
    csv = str(tmp_path / "new.csv")
    spark.createDataFrame([(1, 'say "hi",\nplease')], schemas.CORPUS).coalesce(1).write.option("header", True).option("escape", '"').csv(csv)
    assert tables.read_any(spark, csv, schemas.CORPUS).first()["question_text"] == 'say "hi",\nplease'


def test_rows_without_label_or_key_are_split_too(spark):
    from nearkin.operators import splits as sp
    rows = [(i, i % 3 if i % 3 < 2 else None) for i in range(12)] + [(None, 1), (None, None)]
    df = spark.createDataFrame(rows, "id long, is_duplicate int")
    found = sp.stratified_split(df, "id").collect()
    assert len(found) == 14 and {r["split"] for r in found} <= {"train", "val", "test"}
    assert sp.hash_split(df, "id").filter("split IS NULL").count() == 0


def test_set_operations_shuffle_digests_only(spark, tmp_path):
    rows = [("train", "A b", "c"), ("train", "A b", "c"), ("train", None, "x"), ("train", None, "x"), ("test", "C", "a B"), ("test", "d", "c"), ("test", None, "d")]
    spark.createDataFrame(rows, "split string, question1 string, question2 string").write.parquet(str(tmp_path / "pairs"))
    pairs = spark.read.parquet(str(tmp_path / "pairs"))
    train, test = pairs.filter("split = 'train'"), pairs.filter("split = 'test'")
    results = [quality.duplicate_pairs(pairs), quality.shared_pairs(train, test), quality.question_overlap(train, test)]
    assert {r["split"]: r["n_duplicates"] for r in results[0].collect()} == {"train": 2, "test": 0}
    assert results[1].count() == 2
    assert tuple(results[2].first())[:2] == (5, 1)
    for df in results:
        plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.splitlines() if "Exchange" in line]
        assert shuffles and not any("question1" in line or "question2" in line for line in shuffles)
