import hashlib
import random

import numpy as np
from helpers import empty, odd_documents, prose

from nearkin.llm import fm_index as M


def brute(texts, items, window):
    owners = {}
    for item, text in items:
        words = M.words_of(text)
        for start in range(max(1, len(words) - window + 1) if words else 0):
            owners.setdefault(tuple(words[start:start + window]), set()).add(item)
    found = []
    for text in texts:
        words, hit, ids = M.words_of(text), set(), set()
        for start in range(len(words)):
            for length in {len(o) for o in owners}:
                some = tuple(words[start:start + length])
                if len(some) == length and some in owners:
                    hit.update(range(start, start + length))
                    ids |= owners[some]
        found.append((len(words), len(hit), sorted(ids)))
    return found


def test_words():
    assert M.words_of("It's İ 3x-é_ [Zz]\x00ok") == [b"it", b"s", "İ".encode(), b"3x", "é".encode(), b"zz", b"ok"]


def test_search_equals_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))) for i in range(6)]
        texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(5)] + [items[0][1]] * 3
        found = M.search(texts, M.phrases_of(items, 4))
        assert [(n, sum(e - s for s, e in spans), ids) for n, spans, ids in zip(*found)] == brute(texts, items, 4)


def test_index_counts_and_positions():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(0, 4, 3000), 0)
    index = M.FMIndex(text, 4)
    windows = np.array([[0, 1, 2], [1, 2, 3], [3, 3, 3], [0, 0, 2]])
    lengths = np.array([2, 3, 3, 1])
    low, high = index.find(windows, lengths)
    for window, length, a, b in zip(windows, lengths, low, high):
        wanted = [i for i in range(len(text) - length + 1) if (text[i:i + length] == window[3 - length:]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == wanted


def test_tables_and_blocks(spark, monkeypatch):
    rng = random.Random(9)
    rows = odd_documents(spark)
    texts = [r.text or "" for r in rows.collect()]
    long = next(t for t in texts if len(t.split()) > 10_000)
    items = [(1, long[:80]), (2, None), (3, "  "), (None, "no id here"), (4, "x"), (1, prose(rng, 30)), (30, " ".join(long.split()[50:75]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [("" if i is None else str(i), t) for i, t in items if t is not None]
    want = sorted(repr((r.doc_id, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0))
                  for r, (n, hit, ids) in zip(rows.collect(), brute([r.text or "" for r in rows.collect()], named, 10)))
    assert sorted(repr(tuple(r)) for r in M.digests(rows, bench).collect()) == want
    monkeypatch.setattr(M, "BLOCK_BYTES", 40)
    assert sorted(repr(tuple(r)) for r in M.digests(rows, bench).collect()) == want
    monkeypatch.undo()
    assert M.find(rows, bench)[0].columns == [*rows.columns, "words_", "spans_", "items_"]
    assert not M.digests(rows, empty(spark, "item_id long, text string")).filter("contaminated").count()
    assert M.digests(empty(spark, "doc_id long, text string"), bench).count() == 0


def test_removal(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    rows = spark.createDataFrame([(1, f"Before, {passage.upper()}! After."), (2, "clean"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert {r.doc_id: r.text for r in M.remove(rows, bench).collect()} == {1: "Before, ! After.", 2: "clean", 3: None}
