import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd  # noqa: F401  pyarrow imports it when needed, which must not count as memory of a shard
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from helpers import empty, odd_documents, prose

from nearkin.llm import backoff_lm as B
from nearkin.llm import queries
from nearkin.llm.common import id_remainder


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


class Plain:
    """The model from its definition, with dictionaries and recursion."""

    def __init__(self, texts):
        self.words = Counter(w for t in texts for w in B.words_of(t))
        self.documents = len(texts)
        self.tokens = sum(self.words.values()) + self.documents
        self.kinds = len(self.words) + (self.documents > 0)
        self.grams = Counter()
        for word, n in self.words.items():
            spelled = b" " + word + b" "
            for i in range(1, len(spelled)):
                for order in range(1, min(B.ORDER, i + 1) + 1):
                    self.grams[spelled[i - order + 1:i + 1]] += n
        self.after = {}
        for gram, n in self.grams.items():
            self.after.setdefault(gram[:-1], Counter())[gram[-1]] += n

    def byte(self, context, symbol):
        lower = 1 / B.SYMBOLS if not context else self.byte(context[1:], symbol)
        after = self.after.get(context)
        if not after:
            return lower
        return (after[symbol] + len(after) * lower) / (sum(after.values()) + len(after))

    def word(self, word):
        spelled = b" " + word + b" "
        p = 1.0
        logs = sum(math.log10(self.byte(spelled[max(0, i - B.ORDER + 1):i], spelled[i])) for i in range(1, len(spelled)))
        if not self.tokens:
            return math.log10(0.5) + logs
        own = max(self.words[word] - B.DISCOUNT, 0) / self.tokens
        rest = math.log10(B.DISCOUNT * self.kinds / self.tokens) + logs
        return rest if not own else math.log10(own) + math.log10(1 + 10 ** (rest - math.log10(own))) * p

    def score(self, text):
        end = math.log10((self.documents - B.DISCOUNT) / self.tokens) if self.tokens else math.log10(0.5)
        return end + sum(map(self.word, B.words_of(text)))

    def base(self, text):
        floor = self.tokens + 0.1 * (self.kinds + 1)
        return sum(math.log10((c + 0.1) / floor) for c in [*(self.words[w] for w in B.words_of(text)), self.documents])


def check(df, rows):
    model = Plain([t or "" for i, t in rows if not held(i)])
    found = B.score(df, id_remainder("doc_id", 10) == 0).collect()
    assert len(found) == len(rows)
    want = {}
    for i, t in rows:
        words = B.words_of(t or "")
        known = sum(model.words[w] > 0 for w in words) + (model.documents > 0)
        want.setdefault((held(i), len(words) + 1, known, model.tokens), []).append((model.base(t or ""), model.score(t or "")))
    for r in found:
        options = want[r.held_out, r.n_tokens, r.n_known, r.train_tokens]
        assert any(r.base_score == pytest.approx(b) and r.score == pytest.approx(s) for b, s in options)


def test_equals_the_definition(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(B, "SHARD_BYTES", 4000)
    monkeypatch.setattr(B, "BUCKET_BYTES", 3000)
    rows = [(i, prose(rng, rng.randint(0, 60)) + f" rare{rng.randrange(40)} É") for i in range(150)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_odd_rows(spark):
    df = odd_documents(spark)
    check(df, [(r.doc_id, r.text) for r in df.collect()])
    assert B.score(empty(spark, "doc_id long, text string"), id_remainder("doc_id", 10) == 0).count() == 0
    untaught = df.filter(id_remainder("doc_id", 10) == 0)
    check(untaught, [(r.doc_id, r.text) for r in untaught.collect()])


def test_spelling_is_a_distribution():
    """Over all words up to some length the probabilities stay below one and come near it."""
    words = [b"ab", b"a", b"ba"]
    keys, counts = B.ngrams(words, np.array([5, 3, 1]))
    contexts, of = np.unique(B.contexts_of(keys), return_inverse=True)
    totals, kinds = np.bincount(of, counts), np.bincount(of, counts > 0)
    automaton = B.Automaton(keys, counts, totals[of], kinds[of])
    frontier, total = [b""], 0.0
    for _ in range(4):
        frontier = [w + bytes([b]) for w in frontier for b in b"abc"]
        total += (10 ** automaton.spell(frontier)).sum()
    assert 0.5 < total < 1


class PlainPairs(Plain):
    """The model whose states are words, from its definition."""

    def __init__(self, texts):
        super().__init__(texts)
        self.pairs = Counter(p for t in texts for p in self.steps(t))

    def steps(self, text):
        tokens = [b"", *B.words_of(text), b""]
        return list(zip(tokens, tokens[1:]))

    def behind(self, before, word):
        end = math.log10((self.documents - B.DISCOUNT) / self.tokens) if self.tokens else math.log10(0.5)
        lower = 10 ** (self.word(word) if word else end)
        count = self.words[before] if before else self.documents
        return math.log10((self.pairs[before, word] + B.CONTEXT_WEIGHT * lower) / (count + B.CONTEXT_WEIGHT))

    def score(self, text):
        return sum(self.behind(*step) for step in self.steps(text))


def test_contexts_equal_the_definition(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(B, "SHARD_BYTES", 4000)
    monkeypatch.setattr(B, "BUCKET_BYTES", 3000)
    rows = [(i, prose(rng, rng.randint(0, 60)) + f" rare{rng.randrange(40)} \u00c9") for i in range(150)] + [(150, None), (151, ""), (None, "a b")]
    model = PlainPairs([t or "" for i, t in rows if not held(i)])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in B.score(df, id_remainder("doc_id", 10) == 0, contexts=True).collect()}
    assert len(found) == len(rows)
    for i, t in rows:
        words = B.words_of(t or "")
        got = found[i]
        assert (got.held_out, got.n_tokens, got.train_tokens) == (held(i), len(words) + 1, model.tokens)
        assert got.n_known == sum(model.words[w] > 0 for w in words) + 1
        assert got.base_score == pytest.approx(model.base(t or "")) and got.score == pytest.approx(model.score(t or ""))
    # the followers of a word and the end share what there is
    assert 0 < sum(10 ** model.behind(b"fox", w) for w in [*model.words, b""]) <= 1 + 1e-9


def test_query_scores_words_behind_the_word_before(spark, tmp_path):
    """Two texts of the same words score apart if only one has them in an order that was learnt."""
    learnt = [i for i in range(1, 90) if not held(i)]
    rows = [(i, "red fox jumps high") for i in learnt] + [(next(i for i in range(100) if held(i)), "high jumps fox red")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.held_out: r for r in queries.op10_backoff_lm(spark, str(tmp_path)).collect()}
    assert found[True].base_score == pytest.approx(found[False].base_score)
    assert found[True].score < found[False].score - 4


def test_contexts_without_training(spark):
    """Without training documents every word is spelled, as without contexts; an empty table gives no rows."""
    df = odd_documents(spark)
    untaught = df.filter(id_remainder("doc_id", 10) == 0)
    scores = [sorted(r.score for r in B.score(untaught, id_remainder("doc_id", 10) == 0, contexts=c).collect()) for c in (False, True)]
    assert scores[0] == pytest.approx(scores[1])
    assert B.score(empty(spark, "doc_id long, text string"), id_remainder("doc_id", 10) == 0, contexts=True).count() == 0
    assert B.score(df, id_remainder("doc_id", 10) == 0, contexts=True).count() == df.count()


def test_memory_of_a_shard_per_token(monkeypatch):
    """What is computed for every token of a shard is held for a slice of them, when asking and when scoring."""
    monkeypatch.setattr(B, "SOME_TOKENS", 1 << 12)
    rng = np.random.default_rng(3)
    number = {b"w%d" % i: i for i in range(500)}
    arrays = [rng.integers(0, 500, 1000).astype(np.uint32) for _ in range(300)]
    tokens = 300 * 1001
    schema = pa.schema([
        ("shard", pa.int64()), ("bucket", pa.int32()), ("word_keys", pa.binary()), ("word_counts", pa.binary()), ("gram_keys", pa.binary()),
        ("gram_counts", pa.binary()), ("pair_keys", pa.binary()), ("pair_counts", pa.binary()), ("ids", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("stream", pa.binary()), ("vocabulary", pa.binary())])

    def peak_of(function):
        tracemalloc.start()
        result = function()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return result, peak / tokens

    batches, asking = peak_of(lambda: list(B._shard_rows(0, list(range(300)), [False] * 300, arrays, number, 4, schema, True)))
    rows = pa.Table.from_batches(batches)
    asks = rows.filter(pc.greater_equal(rows["bucket"], 0))
    answers = pa.concat_tables([B._answer(asks.filter(pc.equal(asks["bucket"], b))) for b in range(4)])
    documents = rows.filter(pc.less(rows["bucket"], 0)).select(["shard", "ids", "held", "sizes", "stream", "vocabulary"])
    scored, scoring = peak_of(lambda: B._scored(
        documents, answers.filter(pc.equal(answers["shard"], 0)), B.Totals(tokens, 501, 300), "doc_id", pa.int64(), 4, True))
    assert scored.num_rows == 300
    assert asking < 40 and scoring < 40


def test_long_rows_are_stored_in_small_groups(spark, monkeypatch):
    """Readers decode a group of rows at once, so rows that hold a shard or a bucket must not share large ones."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join("w%d" % w for w in rng.integers(0, 10**6, 1500))) for i in range(120)]
    monkeypatch.setattr(B, "BUCKET_BYTES", 3000)
    monkeypatch.setitem(B.LONG_ROWS, "parquet.block.size", str(1 << 16))
    stored = []
    monkeypatch.setattr(B, "materialize", lambda *args, write=B.materialize, **options: stored.append(write(*args, **options)) or stored[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert B.score(df, id_remainder("doc_id", 10) == 0, contexts=True).count() == 120
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in stored[0].inputFiles()]
    assert max(m.num_row_groups for m in files) > 1
    assert {m.row_group(0).column(0).compression for m in files if m.num_row_groups} == {"ZSTD"}
