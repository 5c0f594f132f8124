"""Keyword search, fusion, rerank, TF-IDF and the search job."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearkin.functions.encoders import hashed_encoder, overlap_scorer
from nearkin.operators import bm25, features, fusion, tfidf
from nearkin.operators.vectors import build_vector_index
from nearkin.plans import search

DOCS = ["how to fix error 0xbeef0042 on windows", "how to cook rice", "windows update fails", "rice rice rice", ""]
RANKED = "query_id long, rank int, question_id long, score double"


def corpus_of(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "question_id long, question_text string")


def brute_bm25(query):
    docs = [re.findall(r"\w+", d.lower()) for d in DOCS]
    average = sum(map(len, docs)) / len(docs)
    df = Counter(t for d in docs for t in set(d))
    scores = {}
    for i, d in enumerate(docs):
        s = 0.0
        for t in re.findall(r"\w+", query.lower()):
            if t in df and t in d:
                idf = math.log((len(docs) - df[t] + 0.5) / (df[t] + 0.5) + 1)
                s += idf * d.count(t) * 2.5 / (d.count(t) + 1.5 * (0.25 + 0.75 * len(d) / average))
        if s > 0:
            scores[i] = round(s, 4)
    return sorted(scores.items(), key=lambda x: (-x[1], x[0]))


def test_bm25_equals_brute_force(spark, tmp_path, monkeypatch):
    texts = ["0xbeef0042", "rice rice how", "nothing known", "", "windows how windows"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id long, query_text string")
    built = bm25.build_index(corpus_of(spark))
    built.save(str(tmp_path))
    loaded = bm25.Bm25Index.load(spark, str(tmp_path))
    results = []
    for index, limit in ((built, 1000), (loaded, 1000), (built, 0)):
        monkeypatch.setattr(bm25, "BROADCAST_QUERY_TERMS", limit)
        results.append({(r["query_id"], r["rank"]): (r["question_id"], r["score"]) for r in bm25.search(index, queries).collect()})
    expected = {(q, i): hit for q, t in enumerate(texts) for i, hit in enumerate(brute_bm25(t), 1)}
    assert results == [expected] * 3
    assert results[0][(0, 1)][0] == 0
    one = loaded.restricted_to(spark.createDataFrame([("rice",)], "term string"))
    scan = one.postings._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in scan
    assert {r["term"] for r in one.postings.collect()} >= {"rice"} and one.postings.count() < built.postings.count()


def test_blocks_under_the_floor_are_not_read(spark, monkeypatch):
    """Equal to scoring everything, while rare terms let most blocks of frequent ones stay closed."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(300)], k=rng.randint(5, 60))) for _ in range(3000)]
    for i in range(0, 200, 10):
        texts[i] += " rare rare rare"
    corpus = spark.createDataFrame(list(enumerate(texts)), "question_id long, question_text string")
    asked = ["w0 w1 rare", "w2 w250 w251", "w0", "w7 w9 w9 w90", "rare unknown"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, query_text string")
    index = bm25.build_index(corpus)
    monkeypatch.setattr(bm25.block_max, "SHARD_DOCUMENTS", 700)
    found = {(r["query_id"], r["rank"]): (r["question_id"], r["score"]) for r in bm25.search(index, queries).collect()}
    monkeypatch.setattr(bm25, "BROADCAST_QUERY_TERMS", 0)
    assert found == {(r["query_id"], r["rank"]): (r["question_id"], r["score"]) for r in bm25.search(index, queries).collect()}
    # one shard by hand: blocks read and skipped
    numbers = {"w0": 0, "w1": 1, "rare": 2}
    postings = spark.createDataFrame([(numbers[t], i, c / (c + 1)) for i, text in enumerate(texts) for t, c in Counter(text.split()).items() if t in numbers],
                                     "term int, question_id long, part double")
    monkeypatch.setattr(bm25.block_max, "SHARD_DOCUMENTS", 4096)
    row = bm25.block_max.pack(postings, 3000).first().asDict()
    shard = bm25.block_max.Shard(row)
    best = bm25.block_max.Best(5)
    read, skipped = bm25.block_max.search_shard(shard, np.array([0, 1, 2]), np.array([0.1, 0.2, 5.0]), best)
    assert skipped > 4 * read > 0 and all(i % 10 == 0 and i < 200 for i in best.ids)


@pytest.mark.parametrize("share, at_once", [(1 / 800, 1 << 19), (2.0, 50), (0.0, 1 << 19)])
def test_many_queries_are_scored_together(spark, monkeypatch, share, at_once):
    """Equal to one query after another, ties, missing and repeated ids and unknown terms included, without a call for each query and shard."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(200)], k=rng.randint(1, 30))) for _ in range(900)]
    texts[300:340] = [texts[0]] * 40  # more ties than wanted
    twice = [*list(enumerate(texts))[100:200], (7, texts[8])]
    corpus = spark.createDataFrame([*enumerate(texts), (None, "w150 w199"), *twice], "question_id long, question_text string")
    asked = [(3, "w0 w1 w3")] + [(i, " ".join(rng.choices(words + ["unknown"], k=rng.randint(1, 12)))) for i in range(150)] + [(200, texts[0]), (None, "w3 w150")]
    queries = spark.createDataFrame(asked, "query_id long, query_text string")
    index = bm25.build_index(corpus)
    monkeypatch.setattr(bm25.block_max, "SHARD_DOCUMENTS", 200)

    def hits():
        return sorted(map(tuple, bm25.search(index, queries, 7).collect()), key=str)

    monkeypatch.setattr(bm25.block_max, "MANY_QUERIES", 1000)
    for limit in (200_000, 0):
        monkeypatch.setattr(bm25, "BROADCAST_QUERY_TERMS", limit or 400)
        one_by_one = hits()
        with monkeypatch.context() as many:
            many.setattr(bm25.block_max, "MANY_QUERIES", 1)
            many.setattr(bm25.block_max, "QUERY_BLOCK", 16)
            many.setattr(bm25.block_max, "DENSE_SHARE", share)
            many.setattr(bm25.block_max, "POSTINGS_AT_ONCE", at_once)
            many.setattr(bm25.block_max, "Shard", None)  # and without the maxima of blocks
            assert hits() == one_by_one and len(one_by_one) > 150 * 5


def test_rrf_examples(spark):
    a = spark.createDataFrame([(1, 1, 10, 0.9), (1, 2, 20, 0.8)], RANKED)
    b = spark.createDataFrame([(1, 1, 20, 5.0), (1, 2, 10, 4.0)], RANKED)
    rows = fusion.reciprocal_rank_fusion([a, b]).orderBy("rank").collect()
    assert [(r["question_id"], r["score"]) for r in rows] == [(10, round(1 / 61 + 1 / 62, 6)), (20, round(1 / 61 + 1 / 62, 6))]
    empty = spark.createDataFrame([], RANKED)
    assert [r["question_id"] for r in fusion.reciprocal_rank_fusion([empty, b]).orderBy("rank").collect()] == [20, 10]
    named = [df.withColumn("origin", F.lit(n)) for df, n in ((a, "dense"), (b, "sparse"))]
    assert {r["origin"] for r in fusion.reciprocal_rank_fusion(named).collect()} == {"sparse"}


def test_rerank(spark):
    df = spark.createDataFrame(
        [(1, 1, 7, 0.9, "red cat", "blue dog"), (1, 2, 8, 0.7, "red cat", "red cat"), (1, 3, 9, 0.6, "red cat", "x")],
        RANKED + ", query_text string, question_text string")
    rows = fusion.rerank(df, overlap_scorer, 50).orderBy("rank").collect()
    assert [(r["question_id"], r["score"]) for r in rows] == [(8, 1.0), (7, 0.0), (9, 0.0)]
    assert [r["question_id"] for r in fusion.rerank(df, None, 2).orderBy("rank").collect()] == [7, 8]
    assert fusion.rerank(df.limit(0), overlap_scorer).count() == 0


def test_threshold(spark):
    df = spark.createDataFrame([(1, i + 1, i, s) for i, s in enumerate([0.97, 0.83, 0.71, 0.2])], RANKED)
    assert fusion.threshold_and_cut(df, 0.8, 5).count() == 2
    assert fusion.threshold_and_cut(df, 0.0, 1).count() == 1
    per_query = df.withColumns({"t": F.lit(0.7), "k": F.lit(2)})
    assert fusion.threshold_and_cut(per_query, "t", "k").count() == 2


@pytest.fixture(scope="module")
def text_pairs(spark):
    rows = [("how to cook rice", "how do i cook rice"), ("", "rice"), ("rice", ""), ("", ""), ("café olé", "cafe ole"),
            ("unknown words", "other terms"), ("a b c", "a b c"), ("rice rice rice cook", "cook cook rice")]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pair_id long, a string, b string")


def brute_tfidf(rows, limit):
    import unicodedata

    def terms(t):
        bare = "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c))
        w = re.findall(r"\b\w\w+\b", bare)
        return Counter(w + [f"{x} {y}" for x, y in zip(w, w[1:])])

    docs = [terms(t) for r in rows for t in r]
    cf, df = Counter(), Counter()
    for d in docs:
        cf.update(d)
        df.update(d.keys())
    vocabulary = [t for t, _ in sorted(cf.items(), key=lambda x: (-x[1], x[0]))[:limit]]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in vocabulary}

    def vector(t):
        v = {k: (1 + math.log(n)) * idf[k] for k, n in terms(t).items() if k in idf}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {k: x / size for k, x in v.items()}

    return [sum(x * vector(b).get(k, 0) for k, x in vector(a).items()) for a, b in rows]


@pytest.mark.parametrize("limit", [5, 50_000])
def test_tfidf_equals_brute_force(spark, text_pairs, tmp_path, limit):
    rows = [(r["a"], r["b"]) for r in text_pairs.orderBy("pair_id").collect()]
    model = tfidf.fit_tfidf(text_pairs, "a", "b", limit)
    model.save(str(tmp_path))
    model = tfidf.TfidfModel.load(spark, str(tmp_path))
    assert model.max_terms == limit
    got = {r["pair_id"]: r["tfidf_cosine"] for r in tfidf.tfidf_cosine(text_pairs, "pair_id", "a", "b", model).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx(brute_tfidf(rows, limit), abs=1e-12)


def test_word_vectors_and_feature_table(spark, text_pairs, monkeypatch):
    vectors = spark.createDataFrame([("rice", [1.0, 0.0]), ("cook", [0.0, 2.0]), ("how", [1.0, 1.0])], "word string, vector array<double>")
    model = tfidf.fit_tfidf(text_pairs, "a", "b")
    built = features.build_features(text_pairs, "pair_id", "a", "b", model, vectors)
    assert built.columns == ["pair_id", *features.FEATURES, "wv_cosine_similarity"]
    rows = {r["pair_id"]: r for r in built.collect()}
    assert len(rows) == 8
    assert all(v is not None and math.isfinite(v) for r in rows.values() for v in r)
    assert rows[1]["wv_cosine_similarity"] == 0.0
    # means (0.75, 0.5) and (1/3, 4/3)
    expected = (0.75 / 3 + 0.5 * 4 / 3) / (math.hypot(0.75, 0.5) * math.hypot(1 / 3, 4 / 3))
    assert rows[7]["wv_cosine_similarity"] == pytest.approx(expected)
    monkeypatch.setattr(features, "BROADCAST_WORDS", 1)
    again = {r["pair_id"]: r[1] for r in features.word_vector_cosine(text_pairs, "pair_id", "a", "b", vectors).collect()}
    assert again == pytest.approx({k: r["wv_cosine_similarity"] for k, r in rows.items()})


def test_find_similar_single_equals_batch(spark):
    docs = corpus_of(spark)
    encode = hashed_encoder(64)
    index = build_vector_index(encode(docs, "question_text", "embedding").select(F.col("question_id").alias("id"), "embedding"), cells=1)
    queries = search.encode_queries(
        spark.createDataFrame([(0, "how to cook rice"), (1, "windows update fails"), (2, "zebra")], "query_id long, query_text string"), encode)
    batch = search.find_similar(queries, index, docs, 2, 0.3)
    single = [search.find_similar(queries.filter(F.col("query_id") == i), index, docs, 2, 0.3).collect() for i in range(3)]
    assert sorted(batch.collect()) == sorted(r for part in single for r in part)
    answers = {r["query_id"]: r for r in search.responses(queries, batch).collect()}
    assert answers[0]["results"][0]["question_id"] == 1 and answers[0]["results"][0]["score"] == 1.0
    assert answers[2]["result_count"] == 0
    reranked = search.find_similar(queries, index, docs, 2, 0.3, scorer=overlap_scorer)
    assert reranked.filter("query_id = 1 and rank = 1").first()["question_id"] == 2


def test_hits_without_text_leave_no_gap(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.96, 0.28]), (3, [0.6, 0.8])], "id long, embedding array<double>")
    texts = spark.createDataFrame([(1, "first"), (3, "third")], "question_id long, question_text string")
    queries = spark.createDataFrame([(9, "q", [1.0, 0.0])], "query_id long, query_text string, query_embedding array<double>")
    rows = search.find_similar(queries, build_vector_index(vectors, cells=1), texts, 2, 0.3).orderBy("rank").collect()
    assert [(r["rank"], r["question_id"]) for r in rows] == [(1, 1), (2, 3)]
