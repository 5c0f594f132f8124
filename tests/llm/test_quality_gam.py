import numpy as np
from helpers import empty, odd_documents
from pyspark.sql import functions as F

from nearkin.llm import quality_gam as Q
from nearkin.llm.queries import QUERIES


def test_additive_and_pair_effects_are_learned():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = Q.boost(x, y)
    assert model.pairs[0] == (0, 1)
    assert ((model.scores(x) > 0.5) == y).mean() > 0.95
    y = (x[:, 2] > 0.3).astype(float)
    assert ((Q.boost(x, y).scores(x) > 0.5) == y).mean() > 0.98


def test_one_kind_of_label_and_none():
    assert np.allclose(Q.boost(np.zeros((3, 2)), np.ones(3)).scores(np.zeros((1, 2))), 0.8)
    assert np.allclose(Q.boost(np.zeros((0, 2)), np.zeros(0)).scores(np.zeros((1, 2))), 0.5)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op1_quality_gam"](spark, folder).join(labels, "doc_id").filter("held_out")
    share = rows.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert share[1] > 50 and share[0] > 0.93


def test_odd_rows(spark):
    rows = odd_documents(spark)
    labels = spark.createDataFrame([(5, 1), (6, 1), (4, 0), (4, 0), (9, None), (None, 1), (10, 0)], "doc_id long, quality int")
    model = Q.fit(rows, labels)
    scored = Q.score(rows, model)
    assert scored.columns == [*rows.columns, "score_"]
    found = scored.collect()
    assert len(found) == rows.count() and all(0 <= r.score_ <= 1 for r in found)
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.text or "", r.score_) == r.score_
    assert Q.score(empty(spark, "doc_id long, text string"), model).count() == 0
    assert Q.fit(rows, labels.limit(0)).tables == []
