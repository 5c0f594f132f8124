import numpy as np
from helpers import empty, odd_documents
from pyspark.sql import functions as F

from nearkin.llm import language_id as L
from nearkin.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op8_language_id"](spark, folder).join(truth, "doc_id").filter("held_out AND lang IS NOT NULL")
    share = rows.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert share[1] > 100 and share[0] > 0.96


def test_centroids_have_length_one_and_cover_clusters():
    rng = np.random.default_rng(0)
    rows = np.repeat(np.eye(4), 20, axis=0) + rng.normal(0, 0.01, (80, 4))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    found = L.clusters(rows, 4)
    assert np.allclose(np.linalg.norm(found, axis=1), 1)
    assert sorted(found.argmax(1).tolist()) == [0, 1, 2, 3]


def test_odd_rows(spark):
    rows = odd_documents(spark).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") != 7, "bb"))
    model = L.fit(rows)
    found, names = L.identify(rows, model)
    assert names["score"] == "score_" and found.columns[:len(rows.columns)] == rows.columns
    for r in found.collect():
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered)
        assert 0 <= r.score_ <= 1 and (lettered or (r.score_ == 0 and r.rejected))
    none = L.fit(rows.limit(0))
    assert {r.lang_pred for r in L.identify(rows, none)[0].collect()} == {"und"}
    assert L.identify(empty(spark, "doc_id long, text string"), model)[0].count() == 0
