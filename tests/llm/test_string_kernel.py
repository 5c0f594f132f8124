import random
from itertools import combinations

import numpy as np
import pytest
from helpers import empty, odd_documents, prose
from pyspark.sql import functions as F

from nearkin.llm import string_kernel as S
from nearkin.llm.queries import QUERIES


def brute_features(word):
    """Weights of all gapped subsequences by enumeration."""
    marked, found = f"\x02{word}\x03", {}
    for places in combinations(range(len(marked)), S.ORDER):
        span = places[-1] - places[0] + 1
        if span <= S.SPAN:
            key = tuple(marked[p] for p in places)
            found[key] = found.get(key, 0) + S.DECAY ** (span - S.ORDER)
    return found


def brute_kernel(a, b):
    x, y = brute_features(a), brute_features(b)
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return sum(v * y.get(k, 0) for k, v in x.items()) / norm if norm else 0.0


def test_kernel_against_enumeration():
    rng = random.Random(3)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(40)] + ["x", "", "ünï", "aaaaaaaaaa", "😀😀b"]
    found = S.kernels(words, words[:25])
    wanted = [[brute_kernel(a, b) for b in words[:25]] for a in words]
    assert np.allclose(found, wanted, atol=1e-5)


def test_gaps_and_insertions_stay_close():
    near, far = S.kernels(["foolish", "fooxlish", "folish", "fo0lish", "mountain"], ["foolish"])[:4, 0], S.kernels(["mountain"], ["foolish"])[0, 0]
    assert near[0] == pytest.approx(1, abs=1e-6) and min(near[1:]) > 0.3 and far < 0.05


def test_words():
    assert S.words_of("F-o-o, b a r! Foo_bar x") == {"foo", "bar", "foobar", "x"}
    long = "".join(chr(97 + i % 26) for i in range(500))
    parts = S.words_of(long)
    assert all(len(p) <= S.LONGEST for p in parts)
    assert all(any(long[i:i + S.SPAN] in p for p in parts) for i in range(len(long) - S.SPAN + 1))
    assert S.words_of("") == set() == S.words_of("... --")


def trained():
    rng = random.Random(5)
    clean = [set(prose(rng, 30).split()) for _ in range(300)]
    toxic = [set(prose(rng, 30).split()) | {rng.choice(["gnarfbol", "snivelrat"])} for _ in range(100)]
    words = sorted(set().union(*clean, *toxic))
    count = lambda texts: np.array([sum(w in t for t in texts) for w in words], float)
    return S.train_words(words, count(toxic), count(clean), 100, 300, landmarks=20), words


def test_folded_weights_equal_the_sum_over_landmarks():
    model, words = trained()
    margins = S.toxic_words(model, ["gnarfbol", "gnarxfbol", "snivelrrat", "wizards", "river"])
    assert margins["gnarfbol"] > 0 and margins["gnarxfbol"] > margins["wizards"] and margins["snivelrrat"] > margins["river"]
    assert margins["wizards"] < 0 and margins["river"] < 0
    # a word's margin by plain enumeration over the folded table
    table = dict(zip(model.keys.tolist(), model.weights.tolist()))
    for word in words[:5] + ["gnaarfbol"]:
        keys = S._keys([word], len(word) + 2)[0].tolist()
        weights = S._places(len(word) + 2)[1].tolist()
        own = {}
        for k, w in zip(keys, weights):
            own[k] = own.get(k, 0) + w
        norm = sum(v * v for v in own.values()) ** 0.5 or 1
        wanted = model.offset + sum(v / norm * table.get(k, 0) for k, v in own.items())
        assert S.toxic_words(model, [word])[word] == pytest.approx(wanted)


def test_memory_changes_no_result(monkeypatch):
    model, words = trained()
    rng = random.Random(1)
    texts = [prose(rng, 50) + " gnarfbol", prose(rng, 30), "", prose(rng, 400)]
    wanted = model.values(texts, {})
    monkeypatch.setattr(S, "MEMORY", 3)
    assert np.allclose(model.values(texts, {}), wanted)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op13_string_kernel"](spark, folder).join(labels, "doc_id").filter("held_out")
    right = F.avg((F.col("predicted") == F.col("toxic")).cast("int"))
    found = {r["toxic"]: r["share"] for r in rows.groupBy("toxic").agg(right.alias("share")).collect()}
    assert found[1] > 0.88 and found[0] > 0.985


def test_odd_rows(spark):
    rows = odd_documents(spark)
    labels = spark.createDataFrame([(5, 1), (6, 1), (4, 0), (4, 0), (9, None), (None, 1), (10, 0)], "doc_id long, toxic int")
    model = S.fit(rows, labels)
    scored = S.score(rows, model)
    assert scored.columns == [*rows.columns, "score_"]
    found = scored.collect()
    assert len(found) == rows.count() and all(0 <= r.score_ <= 1 for r in found)
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.text or "", r.score_) == r.score_
    assert S.score(empty(spark, "doc_id long, text string"), model).count() == 0
    none = S.fit(rows, labels.limit(0))
    assert {r.score_ for r in S.score(rows, none).collect()} == {0.5}
    assert S.fit(empty(spark, "doc_id long, text string"), labels).text_weights is None
