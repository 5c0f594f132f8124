import zlib
from collections import Counter

import numpy as np
from helpers import empty, odd_documents

from nearkin.llm import exact_shuffle as X


def test_matrix_has_the_sums_and_the_law():
    sources, shards = [7, 0, 5, 13], [7, 6, 6, 6]
    seen = []
    for seed in range(3000):
        matrix = X.communication_matrix(sources, shards, seed)
        assert [sum(r) for r in matrix] == sources and [sum(c) for c in zip(*matrix)] == shards
        seen.append(matrix[3][0])
    # 13 draws out of 25 of which 7 are in the shard
    assert abs(np.mean(seen) - 13 * 7 / 25) < 0.1
    assert abs(np.var(seen) - 13 * (7 / 25) * (18 / 25) * (12 / 24)) < 0.15


def test_own_draw_beyond_the_library(monkeypatch):
    monkeypatch.setattr(X, "LIBRARY_LIMIT", 1)
    rng = np.random.default_rng(0)
    seen = [X._hypergeometric(rng, 300, 700, 100) for _ in range(4000)]
    assert abs(np.mean(seen) - 30) < 0.4 and abs(np.var(seen) - 100 * 0.3 * 0.7 * 900 / 999) < 1.5
    assert X._hypergeometric(rng, 5, 0, 3) == 3 and X._hypergeometric(rng, 0, 5, 3) == 0


def laws(rows, shards):
    sizes = Counter(r.shard for r in rows)
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_law_of_rows(spark, monkeypatch):
    df = spark.range(0, 1003, numPartitions=7).selectExpr("id AS doc_id", "repeat('x', cast(id % 9 as int)) AS text")
    rows = X.digests(df).collect()
    laws(rows, 40)
    assert sorted(r.doc_id for r in rows) == list(range(1003))
    assert all(r.size == 16 + r.doc_id % 9 and r.text_crc32 == zlib.crc32(b"x" * (r.doc_id % 9)) and r.law == "rows" and r.grown_shard is None for r in rows)
    # neighbours do not stay together, and places are not in the order of ids
    place = {r.doc_id: (r.shard, r.slot) for r in rows}
    assert sum(place[i][0] == place[i + 1][0] for i in range(1002)) < 60
    monkeypatch.setattr(X, "RANGE_ROWS", 5)
    monkeypatch.setattr(X, "SOURCES", 2)
    laws(X.digests(df).collect(), 40)


def test_odd_rows(spark, tmp_path):
    rows = odd_documents(spark)
    found = X.digests(rows).collect()
    assert len(found) == rows.count()
    laws(found, 40)
    assert X.shuffle(rows, 3).columns == [*rows.columns, "shard_", "slot_"]
    assert X.digests(empty(spark, "doc_id long, text string")).count() == 0
    X.write_shards(rows.select("doc_id"), str(tmp_path / "out"), 3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()


def test_native(spark):
    plan = X.digests(spark.range(10).selectExpr("id AS doc_id", "'a' AS text"))._jdf.queryExecution().toString()
    assert not any(n in plan for n in ("Python", "Arrow", "Pandas"))


def test_slots_do_not_depend_on_ranges(spark, monkeypatch):
    df = spark.range(0, 3000, 1, 4).toDF("id")
    whole = sorted(map(tuple, X.shuffle(df, 7).collect()))
    monkeypatch.setattr(X, "RANGE_ROWS", 50)
    assert sorted(map(tuple, X.shuffle(df, 7).collect())) == whole
