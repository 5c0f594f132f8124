"""Segmented keyword index against an index built anew from the live rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from nearkin.functions.encoders import hashed_encoder
from nearkin.operators import bm25, vectors
from nearkin.sources import segments
from nearkin.streaming import ingest

WORDS = "red green blue round flat long short old new big".split()
SCHEMA = "question_id long, question_text string"


def hits(index, queries):
    return sorted(tuple(r) for r in bm25.search(index, queries, 5).collect())


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(1, "red round"), (2, "old old blue"), (3, "nowhere"), (4, "big 17")], "query_id long, query_text string")


def test_batches_with_replacements_equal_a_rebuild(spark, queries, tmp_path, monkeypatch):
    root, rng, live = str(tmp_path / "index"), random.Random(4), {}
    assert hits(segments.load(spark, root), queries) == []
    monkeypatch.setattr(segments, "FAN", 3)

    def text():
        return " ".join(rng.choices(WORDS, k=rng.randint(0, 9))) + f" {rng.randint(0, 30)}"

    for number in range(segments.BASE_BATCH, 3):
        ids = range(40) if number < 0 else [*rng.sample(range(40), 8), *range(40 + 5 * number, 45 + 5 * number)]
        rows = [(i, text()) for i in ids] + [(None, "red red red"), (100 + number, "")]
        if number >= 0:
            rows.append((number, None))  # deletes
            rows = [(i, t) for i, t in rows if i != number or t is None]
            rows.append((50, "a lesser text"))
            rows.append((50, "old of two rows of one id"))
            rows = [(i, t) for i, t in rows if i != 50 or t.startswith(("a lesser", "old of"))]
        batch = spark.createDataFrame(rows, SCHEMA).repartition(3)
        assert segments.append(batch, number, root)
        # a replay changes nothing
        assert not segments.append(batch, number, root)
        for i, t in rows:
            if i is not None:
                live[i] = t
        live = {i: t for i, t in live.items() if t is not None}
        built = bm25.build_index(spark.createDataFrame(list(live.items()), SCHEMA))
        grown = segments.load(spark, root)
        assert tuple(grown.stats.first())[:2] == pytest.approx(tuple(built.stats.first()))
        assert hits(grown, queries) == hits(built, queries)
    assert len(segments.read_state(spark, root).segments) == 4
    assert segments.merge_due(spark, root) > 0
    state = segments.read_state(spark, root)
    assert len(state.segments) < 4 and sum(s.n for s in state.segments) == len(live)
    assert hits(segments.load(spark, root), queries) == hits(built, queries)
    # a state without a manifest is invisible, what is named nowhere can go
    queries.write.parquet(f"{root}/state=99/other")
    assert segments.read_state(spark, root) == state
    assert segments.remove_unused(spark, root, keep=1)
    assert hits(segments.load(spark, root), queries) == hits(built, queries)


def test_more_query_terms_than_are_shipped(spark, queries, tmp_path, monkeypatch):
    root = str(tmp_path / "index")
    rows = [(i, f"{WORDS[i % 10]} {WORDS[i % 7]} {i}") for i in range(30)]
    segments.append(spark.createDataFrame(rows, SCHEMA), 0, root)
    segments.append(spark.createDataFrame([(3, "red round 17"), (4, None)], SCHEMA), 1, root)
    few = hits(segments.load(spark, root), queries)
    monkeypatch.setattr(bm25, "BROADCAST_QUERY_TERMS", 0)
    assert few and hits(segments.load(spark, root), queries) == few


def test_merge_rule():
    def state(*sizes):
        return segments.State(tuple(segments.Segment(str(i), i, n, n, n) for i, n in enumerate(sizes)))

    def merged(*sizes):
        return [int(s.name) for s in segments.due(state(*sizes))]

    assert merged(1000, 10, 10) == [] and merged() == []
    assert merged(10_000, 10, 11, 9, 10) == [1, 2, 3, 4]
    # many batches leave few segments
    sizes = []
    for _ in range(300):
        sizes.append(100)
        while chosen := merged(*sizes):
            sizes = [n for i, n in enumerate(sizes) if i not in chosen] + [sum(sizes[i] for i in chosen)]
    assert len(sizes) <= 16
    mostly_dead = segments.Segment("a", 0, 10, 4, 9)
    assert segments.due(segments.State((mostly_dead,))) == [mostly_dead]


def test_ingested_questions_are_found_by_keyword(spark, queries, tmp_path):
    root, keywords, source = str(tmp_path / "out"), str(tmp_path / "keywords"), tmp_path / "in"
    base = spark.createDataFrame([(i, f"question {i} about {WORDS[i % 10]}", i) for i in range(20)], "question_id long, question_text string, vec_id long")
    encoder = hashed_encoder()
    index = vectors.build_vector_index(encoder(base, "question_text", "embedding").select(F.col("question_id").alias("id"), "embedding"), cells=2)
    segments.append(base.select("question_id", "question_text"), segments.BASE_BATCH, keywords)
    target = ingest.IngestTarget.after(base, root, index.centroids, encoder, keywords)
    source.mkdir()
    for number, word in enumerate(("apple", "pear")):
        (source / f"{number}.json").write_text("\n".join(json.dumps({"n": i, "question_text": f"{word} number {i}"}) for i in range(6)))
        stream = spark.readStream.schema("n int, question_text string").json(str(source))
        ingest.start_ingest(stream, target, f"{root}/cp", ["n"], available_now=True).awaitTermination()
    wanted = spark.createDataFrame([(0, "apple 3"), (1, "pear 5"), (2, "about blue")], "query_id long, query_text string")
    found = hits(segments.load(spark, keywords), wanted)
    assert [h[2] for h in found if h[1] == 1] == [23, 31, 2]
    # a replayed micro-batch adds nothing
    again = spark.read.schema("n int, question_text string").json(str(source / "1.json"))
    ingest.ingest_batch(again, 1, target, ["n"])
    assert hits(segments.load(spark, keywords), wanted) == found
    assert segments.load(spark, keywords).stats.first()["n"] == 32


def test_postings_lie_by_bucket_and_hash(spark, tmp_path):
    """One number orders the postings, so that terms are not compared; rows of a bucket and of a term stay together."""
    root = str(tmp_path / "index")
    rows = [(i, " ".join(f"word{(i * 7 + j * j) % 300}" for j in range(40))) for i in range(200)]
    segments.append(spark.createDataFrame(rows, "question_id long, question_text string"), 0, root)
    postings = spark.read.parquet(f"{root}/segments/*/postings").select(
        "bucket", F.shiftrightunsigned(F.xxhash64("term"), 9).alias("hash"), "question_id", F.input_file_name().alias("file")).collect()
    assert len(postings) > 2000
    for file in {r["file"] for r in postings}:
        own = [(r["bucket"], r["hash"]) for r in postings if r["file"] == file]
        assert own == sorted(own)
