import random

import corpus_pipeline
from helpers import prose
from pyspark.sql import functions as F

from nearkin.llm import bottom_k, fm_index, quality_gam, secret_scan
from nearkin.llm.common import id_remainder

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    columns, seen = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, seen, FOLDER).write.parquet(str(tmp_path / name))
        before, seen = seen, spark.read.parquet(str(tmp_path / name))
        assert seen.columns == columns
        ids = {r.doc_id for r in seen.select("doc_id").collect()}
        if name == "quality":
            model = quality_gam.fit(before, labels, held_out=id_remainder("doc_id", 4) == 2)
            scored = quality_gam.score(before, model)
            assert ids == {r.doc_id for r in scored.filter(F.col("score") >= 0.7).collect()}
        elif name == "near_dedup":
            assert ids == {r.doc_id for r in bottom_k.near_duplicates(before).filter("kept").collect()}
        else:
            assert ids == {r.doc_id for r in before.select("doc_id").collect()}
            assert not seen.filter("n_chars != length(text)").count()
        if name == "decontaminate":
            dirty = fm_index.digests(before, bench).filter("contaminated")
            assert dirty.count() and not fm_index.digests(seen, bench).join(dirty.select("doc_id"), "doc_id").filter("n_hit > 0").count()
            clean = before.join(dirty.select("doc_id"), "doc_id", "left_anti").select("doc_id", "text")
            assert clean.join(seen.select("doc_id", F.col("text").alias("t")), "doc_id").filter("text != t").count() == 0
        if name == "remove_secrets":
            assert not secret_scan.digests(seen).filter("spans != ''").count()
    last = corpus_pipeline.STAGES[-1][1](spark, seen, FOLDER)
    rows = sorted(map(tuple, last.collect()))
    assert rows == sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) and len(rows) == len(ids)


def test_odd_documents(spark, tmp_path):
    rng = random.Random(1)
    texts = [None, "", prose(rng, 30), prose(rng, 5000), "password = hunter22"]
    rows = [(i, t, None, None, 0, "x", "y") for i, t in enumerate(texts)] + [(None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, words string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "words"]
    corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
