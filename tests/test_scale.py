"""Steps whose memory, time or input must not depend on the size or layout of the tables."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearkin.functions import text as tx
from nearkin.operators import bm25, corpus, explore, features
from nearkin.operators import vectors as vx
from nearkin.plans import catalog


def _unit(n, dim, seed=5):
    raw = np.random.default_rng(seed).normal(size=(n, dim))
    return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype("float32")


@pytest.fixture()
def folder_tables(spark, tmp_path):
    """Tables that are folders of several part files, besides others in the same place."""
    docs = spark.createDataFrame([(i, f"How do I learn topic {i}?") for i in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"What is topic {i}?") for i in range(5)], "item_id long, text string")
    embeddings = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(_unit(12, 4).repeat(2, axis=0))], "vec_id long, embedding array<float>")
    events = spark.range(24).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id")).alias("ts"))
    for name, df in (("documents", docs), ("benchmark", items), ("embeddings", embeddings), ("events", events)):
        df.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_ingest_reads_a_table_of_part_files(spark, folder_tables):
    assert catalog.ingest_stream(spark, folder_tables).count() == 40


def test_reuse_reads_a_table_of_part_files(spark, folder_tables):
    streamed, whole = (q(spark, folder_tables).orderBy("query_id").collect() for q in (catalog.query_reuse_stream, catalog.query_reuse))
    assert len(streamed) == 24 and streamed == whole


@pytest.mark.parametrize("wanted", [1, 4, 20])
def test_cells_of_a_batch_are_scored_in_slices(spark, monkeypatch, wanted):
    centroids = np.round(_unit(30, 3), 1).repeat(2, axis=0)  # equal cells: the lower number goes first
    table = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centroids)], "cell int, centroid array<double>")
    rows = np.round(_unit(50, 3, 6), 1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id long, embedding array<float>").coalesce(1)
    monkeypatch.setattr(vx, "SCORE_BYTES", 8 * 60 * 7)
    scores = np.round(rows.astype("float64") @ centroids.astype("float64").T, 9)
    found = {r["id"]: r["cells"] for r in vx.nearest_cells(df, "embedding", table, wanted).collect()}
    assert [found[i] for i in range(50)] == np.argsort(-scores, axis=1, kind="stable")[:, :wanted].tolist()
    assert [s.stop - s.start for s in vx._score_slices(50, 60)] == [7] * 8


def test_tables_are_read_in_small_arrow_batches(spark, sf):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "10000")
        catalog.html_strip_pages(spark, sf)
        assert int(spark.conf.get(setting)) == 2000
    finally:
        spark.conf.set(setting, before)


def test_word_vectors_beyond_the_broadcast_bound(spark, monkeypatch):
    pairs = spark.createDataFrame(
        [(i, f"a{i % 7} b{i % 5} common a{i % 7} unknown", f"b{i % 3} common c{i}" if i % 9 else "nothing known") for i in range(60)] + [(3, "a1 a2", "b1")],
        "pair_id long, question1 string, question2 string")
    words = [f"{k}{i}" for k in "ab" for i in range(7)] + ["common", "common"]  # a word given twice counts twice
    table = spark.createDataFrame([(w, v.tolist()) for w, v in zip(words, _unit(len(words), 5))], "word string, vector array<float>")

    def cosines():
        found = features.word_vector_cosine(pairs, "pair_id", "question1", "question2", table)
        return sorted((r[0], round(r[1], 9)) for r in found.collect())

    shipped = cosines()
    monkeypatch.setattr(features, "BROADCAST_WORDS", 3)
    for group, chunk in ((1 << 21, 1 << 15), (40, 7)):
        monkeypatch.setattr(features, "GROUP_WORDS", group)
        monkeypatch.setattr(features, "CHUNK_WORDS", chunk)
        assert cosines() == shipped
    plan = features.word_vector_cosine(pairs, "pair_id", "question1", "question2", table)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInPandas" in plan


@pytest.mark.parametrize("bound, join", [(1 << 20, "BroadcastHashJoin"), (3, "SortMergeJoin")])
def test_pairs_get_the_numbers_of_their_words_without_a_shuffle(spark, monkeypatch, bound, join):
    pairs = spark.createDataFrame([(i, f"a{i % 7} b{i % 5} common a{i % 7}", f"b{i % 3} c{i}") for i in range(60)], "pair_id long, question1 string, question2 string")
    words = [f"{k}{i}" for k in "ab" for i in range(7)] + ["common", "common"]
    table = spark.createDataFrame([(w, v.tolist()) for w, v in zip(words, _unit(len(words), 5))], "word string, vector array<float>")
    shipped = sorted(map(tuple, features.word_vector_cosine(pairs, "pair_id", "question1", "question2", table).collect()))
    monkeypatch.setattr(features, "BROADCAST_WORDS", 3)
    monkeypatch.setattr(features, "NAMED_WORDS", bound)
    plans, write = {}, features.materialize
    monkeypatch.setattr(features, "materialize", lambda df, name, **o: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and None or write(df, name, **o))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = sorted(map(tuple, features.word_vector_cosine(pairs, "pair_id", "question1", "question2", table).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [f[0] for f in found] == [s[0] for s in shipped] and np.allclose([f[1] for f in found], [s[1] for s in shipped], atol=1e-9)
    assert join in plans["pair-words"]


def test_stop_words_are_looked_up_in_a_set(spark):
    pairs = spark.createDataFrame([(1, "the quick the fox", "quick a fox jumps")], "is_duplicate int, question1 string, question2 string")
    found = explore.top_bigrams(pairs, "question1", "question2")
    assert [(r["bigram"], r["n"]) for r in found.orderBy("rank").collect()] == [("quick fox", 2), ("fox jumps", 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan.upper() and "array_contains" not in plan


def test_few_ranges_hold_all_characters_that_are_taken_apart():
    ranges = [(int(a, 16), int(b, 16)) for a, b in re.findall(r"\\x\{(\w+)\}-\\x\{(\w+)\}", tx._MAYBE_LONG)]
    assert all(any(a <= code <= b for a, b in ranges) for code in tx._LONG_CODES)
    assert not any(a <= ord(c) <= b for a, b in ranges for c in "azéüßñøÿş“’")


@pytest.mark.parametrize("zeros", [1, 30, 100])
def test_clustering_takes_vectors_of_length_zero(spark, zeros):
    unit = _unit(100, 4)
    unit[100 - zeros:] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "id long, embedding array<float>")
    index = vx.build_vector_index(df, cells=5)
    assert index.vectors.count() == 100 and index.vectors.filter("cell IS NULL").count() == 0
    queries = df.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    scores = np.round(unit.astype("float64") @ unit.astype("float64").T, 9)
    np.fill_diagonal(scores, -2)
    found = {r["query_id"]: r["question_id"] for r in vx.knn_by_bounds(queries, index, 1, skip_self=True).collect()}
    assert [found[i] for i in range(100)] == scores.argmax(axis=1).tolist()


def test_many_query_terms_are_searched_in_rounds(spark, monkeypatch):
    """As many rounds as the query terms need, each against the packed shards, equal to one search with all."""
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 40, 12))) for i in range(300)], "question_id long, question_text string")
    asked = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 50, 4))) for i in range(30)], "query_id long, query_text string")
    index = bm25.build_index(docs)
    whole = bm25.search(index, asked, 5).orderBy("query_id", "rank").collect()
    rounds, search = [], bm25.block_max.search
    monkeypatch.setattr(bm25.block_max, "search", lambda shards, queries, k: rounds.append(len(queries)) or search(shards, queries, k))
    monkeypatch.setattr(bm25, "BROADCAST_QUERY_TERMS", 40)
    assert bm25.search(index, asked, 5).orderBy("query_id", "rank").collect() == whole
    assert len(rounds) > 1 and sum(rounds) == 30 and max(rounds) < 30
    # neither side needs ids, and nothing may be found
    nameless = bm25.build_index(docs.limit(20).unionByName(spark.createDataFrame([(None, "zz zz w1")], docs.schema)))
    lost = spark.createDataFrame([(None, "zz zz"), (7, "zz")] + [(8, f"y{i}") for i in range(50)], asked.schema)
    assert [(r["query_id"], r["question_id"]) for r in bm25.search(nameless, lost, 5).orderBy("query_id").collect()] == [(None, None), (7, None)]
    assert bm25.search(nameless, lost.filter("query_id = 8"), 5).count() == 0


def test_very_many_cells_come_from_two_levels_and_probes_from_packs(spark, monkeypatch):
    """No clustering beyond the bound, copies and zeros included, and hits equal to those of the probed cells by hand."""
    rows = np.round(np.concatenate([_unit(240, 4), _unit(1, 4, 9).repeat(60, axis=0), np.zeros((2, 4))]), 3).astype("float64")
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, embedding array<double>")
    asked, kmeans = [], vx.KMeans
    monkeypatch.setattr(vx, "KMeans", lambda k, **options: asked.append(k) or kmeans(k=k, **options))
    monkeypatch.setattr(vx, "ONE_LEVEL_CELLS", 12)
    monkeypatch.setattr(vx, "BLOCK_ROWS", 50)  # the copies take more than one block
    monkeypatch.setattr(vx, "PROBED_ROWS", 100)
    index = vx.build_vector_index(df, cells=100)
    centroids = np.array([r["centroid"] for r in index.centroids.orderBy("cell").collect()])
    cells = np.array([r["cell"] for r in index.vectors.orderBy("id").collect()])
    assert max(asked) <= 12 < 50 < len(centroids) and len(cells) == len(rows)
    assert sorted(set(cells)) == list(range(len(centroids)))
    for cell, centroid in enumerate(centroids):
        mean = np.sum([v / np.linalg.norm(v) for v in rows[cells == cell] if v.any()] or [np.zeros(4)], axis=0)
        assert np.allclose(centroid, mean / (np.linalg.norm(mean) or 1.0))
    queries = df.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    monkeypatch.setattr(vx, "nearest_cells", None)  # queries are not copied to each cell
    found = {}
    for r in vx.knn_clustered(queries, index, 5, probe=20).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["question_id"], r["score"]))
    near = np.argsort(-np.round(rows @ centroids.T, 9), axis=1, kind="stable")[:, :20]
    scores = np.round(rows @ rows.T, 9)
    for q in range(len(rows)):
        inside = np.flatnonzero(np.isin(cells, near[q]))
        best = inside[np.lexsort((inside, -scores[q, inside]))][:5]
        assert [i for i, _ in found[q]] == best.tolist()
        assert np.allclose([s for _, s in found[q]], scores[q, best], atol=1e-4)


def test_markup_is_removed_once_for_both_cleanings(spark):
    """Two removals for two sides, and the same words as punctuation first and white space afterwards, for any character."""
    rng = np.random.default_rng(4)
    codes = [c for c in [*range(1, 0x3100), 0xFEFF, 0x10400, 0x1D7D8, 0x1F600] if not 0xD800 <= c < 0xE000]
    texts = ["".join("aB " [x % 3] + chr(c) + " " * (x % 4) for c, x in zip(codes[i::40], rng.integers(0, 12, len(codes)))) for i in range(40)]
    texts += ["", "  ", "it's <b>won't</b> &amp; https://x.y z’s", "a`ll don't", None]
    pairs = spark.createDataFrame([(i, t, "Who's <i>there</i>?") for i, t in enumerate(texts)], "n int, question1 string, question2 string")
    cleaned = corpus.clean_pairs(pairs)
    assert cleaned._jdf.queryExecution().optimizedPlan().toString().count(tx.TAG) == 2
    text = tx.expand_contractions(tx.remove_urls(tx.remove_html(F.col("question1"))))
    words = F.coalesce(tx.collapse(F.regexp_replace(F.lower(text), tx.NON_WORD, " ")), F.lit(""))
    expected = pairs.select("n", words.alias("w")).filter("w != ''").orderBy("n").collect()
    assert [(r["n"], r["q1_classical"]) for r in cleaned.orderBy("n").collect()] == [tuple(r) for r in expected]
