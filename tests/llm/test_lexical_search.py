import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import empty, odd_documents, prose

from nearkin.llm import lexical_search as L


def brute(documents, items, k=10):
    """Scores of all documents by the formula."""
    counts = [(i, Counter(L.terms_of(t or ""))) for i, t in documents]
    n = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    rows = set()
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * n // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in L.terms_of(text or "") if c[t])
            if score > 0:
                scored.append((-score, math.inf if i is None else i, i))
        rows |= {(item, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:k], 1)}
    return rows


def result(df):
    return {(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()}


def corpus(rng, n):
    """Words of very different frequency, texts of very different length, copies."""
    words = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([3, 20, 80, 300]))) for _ in range(n)]
    return [(i, texts[i] if i % 9 else texts[0]) for i in range(n)]


def shard_of(documents, numbers):
    writer = L.ShardWriter(numbers)
    for i, t in documents:
        writer.add(i, t)
    n, total = writer.n, writer.l
    batch = writer.flush()
    return {c: batch.column(c)[0].as_py() for c in batch.schema.names}, n, total


def test_terms():
    assert L.terms_of("Ab-cD É_é 9x\x7f\x00ẞ") == ["ab", "cd", "É", "é", "9x", "ẞ"]


def test_range_maxima_against_scanning():
    rng = random.Random(2)
    documents = corpus(rng, 300)
    numbers = {f"w{i}": i for i in range(200)}
    row, n, total = shard_of(documents, numbers)
    shard = L.Shard(row, n, total)
    for first, last in shard.span.values():
        for _ in range(5):
            a, b = sorted(rng.randint(first, last) for _ in range(2))
            value, at = shard.highest(np.array([a]), np.array([b]))
            assert value[0] == (shard.impact[a:b].max() if b > a else 0)
            assert b == a or (a <= at[0] < b and shard.impact[at[0]] == value[0])


@pytest.mark.parametrize(("leaf", "entries"), [(512, 1 << 16), (4, 1), (4, 40)])
def test_search_of_one_shard_against_brute_force(monkeypatch, leaf, entries):
    monkeypatch.setattr(L, "LEAF_POSTINGS", leaf)
    monkeypatch.setattr(L, "OPEN_ENTRIES", entries)
    rng = random.Random(4)
    documents = corpus(rng, 500)
    items = [(q, " ".join(f"w{min(199, int(rng.expovariate(0.02)))}" for _ in range(rng.randint(1, 12)))) for q in range(20)]
    numbers = {f"w{i}": i for i in range(200)}
    row, n, total = shard_of(documents, numbers)
    shard = L.Shard(row, n, total)
    df = {t: b - a for t, (a, b) in shard.span.items()}
    found, work = set(), L.Work()
    for item, text in items:
        best = L.Best(10)
        terms = {numbers[t]: c * L.weight(n, df[numbers[t]]) for t, c in Counter(text.split()).items() if numbers[t] in df}
        L.search_shard(shard, terms, best, work)
        found |= {(item, r, int(i), int(s)) for r, (i, s) in enumerate(zip(best.ids, best.scores), 1)}
    assert found == brute(documents, items)
    if leaf == 4:
        # most of the documents are never scored
        assert work.splits + work.leaves < 0.5 * len(items) * len(documents) and work.closed > 0


@pytest.mark.parametrize(("documents_of_shard", "block"), [(4096, 1 << 20), (7, 60)])
def test_query_against_brute_force(spark, monkeypatch, documents_of_shard, block):
    monkeypatch.setattr(L, "SHARD_DOCUMENTS", documents_of_shard)
    monkeypatch.setattr(L, "BLOCK_BYTES", block)
    rng = random.Random(6)
    documents = [(i, prose(rng, rng.randint(0, 30))) for i in range(120)] + [(None, "dog wizards"), (500, None), (501, ""), (7, "dog dog")]
    items = [(1, "Dog seven wizards"), (2, "the the potion"), (3, None), (4, "nowhere"), (5, ""), (6, "river bank near old lazy fox")]
    found = L.rank(spark.createDataFrame(documents, "doc_id long, text string").repartition(3),
                   spark.createDataFrame(items, "item_id long, text string"))
    assert result(found) == brute(documents, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_odd_rows(spark):
    rows = odd_documents(spark)
    items = spark.createDataFrame([(1, "quick wizards", 5), (1, "quick wizards", 5), (None, "id", 2)], "item_id long, text string, score int")
    found = L.rank(rows, items).collect()
    plain = [(r["doc_id"], r["text"]) for r in rows.collect()]
    wanted = brute(plain, [(1, "quick wizards"), (None, "id")])
    assert {(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found} == wanted
    assert len(found) == 2 * sum(w[0] == 1 for w in wanted) + sum(w[0] is None for w in wanted)
    assert L.rank(empty(spark, "doc_id long, text string"), items).count() == 0
    assert L.rank(rows, items.limit(0)).count() == 0
