"""LM scoring by a weighted backoff automaton.

A text is a run of words and one end. A known word has an arc of its own from the start of
words; with the discounted rest of the probability a word is spelled. Spelling follows smoothed
n-grams of bytes (Witten-Bell, up to ``ORDER`` bytes, from the start of a word to the blank
behind it). Contexts become states; an arc carries the log-probability of a byte after a
context; where a state lacks a byte, its failure arc adds the weight of backing off and leads
to the next shorter context. A traversal goes through a word from left to right, carrying the
state and the sum of the weights; all distinct words of a shard go through it in step.

With ``contexts`` the automaton has a state for every word, and one for the start of a text. A pair
of words seen in training has an arc from the state of the first; the failure arc of a state adds
the weight of backing off, ``CONTEXT_WEIGHT`` of its count and that, and leads to the arcs of words
without a context. So a traversal carries its state from word to word up to the end of the text.

Neither the vocabulary nor the automaton of the corpus ever stands in one place. A shard is a
slice of documents of about ``SHARD_BYTES`` of text. It sends the words, pairs and n-grams that occur
in it, with their training counts, to buckets chosen by hash; a bucket adds up what all shards
sent and answers each shard for what it asked. So every shard gets the part of the automaton
that its own texts can reach, with counts over all training documents. N-grams with a common
context meet in one bucket, which is what smoothing needs. Counts are added up per shard before
they move, so a frequent word is one number per shard.

Words are keyed by 64-bit hashes within buckets that come from other bits of the hash, pairs by 56
bits whose highest decide on the bucket; it depends on both words, so the followers of a frequent
word are spread. Counts of words and pairs come back in the order in which a shard asked for them,
without keys.

Defined results: a null or empty text is one end; without training documents the base score is
that of an empty table and the model spells all words evenly; repeated rows count repeatedly;
ids may be null or tied; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.llm.common import chunks, texts_of
from nearkin.session import materialize

ORDER = 5
SHARD_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20
DISCOUNT = 0.5
CONTEXT_WEIGHT = 16.0
PAIR_KEY_BYTES = 7
SENT_BYTES = 2 << 20
SOME_WORDS = 1 << 15
SOME_TOKENS = 1 << 17
# Rows are long: a writer holds a group of rows and a reader decodes one at once. Snappy keeps pages outside the heap until it is collected.
LONG_ROWS = {"parquet.block.size": str(8 << 20), "compression": "zstd"}
SYMBOLS = 257  # bytes and one more, so that no distribution is without a rest
BLANK = 32
_LENGTH_AT = 56


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket per key, from the high bits of a product so that it is independent of the order of keys."""
    mixed = (keys ^ keys >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(buckets)).astype(np.int64)


def _slices(rows: int) -> Iterator[slice]:
    """Cuts the tokens of a shard so that what is computed of them takes little room at a time."""
    return (slice(at, min(at + SOME_TOKENS, rows)) for at in range(0, rows, SOME_TOKENS))


def _behind(stream: np.ndarray, sizes: np.ndarray, boundary: int) -> np.ndarray:
    """The tokens of all texts, each text with a boundary as its end; the boundary before the first one stands before a text."""
    behind = np.empty(len(stream) + len(sizes), stream.dtype)
    inside = np.ones(len(behind), bool)
    inside[np.cumsum(sizes + 1) - 1] = False
    behind[inside], behind[~inside] = stream, boundary
    return behind


def _before(behind: np.ndarray, some: slice) -> np.ndarray:
    """The tokens before those of a slice; texts begin behind a boundary, as the last one ends."""
    return behind[some.start - 1:some.stop - 1] if some.start else np.append(behind[-1:], behind[:some.stop][:-1])


def _pair_keys(behind: np.ndarray, keys: np.ndarray, some: slice) -> np.ndarray:
    """A key of ``PAIR_KEY_BYTES`` for each token of a slice with the one before it, from the hashes of both."""
    mixed = keys[_before(behind, some)]
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed += keys[behind[some]]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(29)
    mixed >>= np.uint64(64 - 8 * PAIR_KEY_BYTES)
    return mixed


def _counted_pairs(behind: np.ndarray, keys: np.ndarray, taught: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, and how many tokens of each are ``taught``."""
    flagged = np.empty(len(behind), np.uint64)
    for some in _slices(len(behind)):
        flagged[some] = _pair_keys(behind, keys, some) << np.uint64(1) | taught[some]
    # sorted in place, with the flag in the bit that a key leaves free
    flagged.sort()
    counted, new = np.empty(len(flagged), bool), np.ones(len(flagged), bool)
    for some in _slices(len(flagged)):
        counted[some] = flagged[some] & np.uint64(1)
    flagged >>= np.uint64(1)
    np.not_equal(flagged[1:], flagged[:-1], out=new[1:])
    distinct = flagged[new]
    del flagged
    first = np.flatnonzero(new)
    counts = np.add.reduceat(counted, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    return distinct, counts


def _pair_bounds(buckets: int) -> np.ndarray:
    """The first pair key of every bucket, and one behind the last: sorted keys are sorted by bucket, too."""
    keys = 1 << 8 * PAIR_KEY_BYTES
    return np.array([-(-keys * b // buckets) for b in range(buckets + 1)], np.uint64)


def contexts_of(keys: np.ndarray) -> np.ndarray:
    """The n-gram without its last byte."""
    mask = np.uint64((1 << _LENGTH_AT) - 1)
    return ((keys >> np.uint64(_LENGTH_AT)) - np.uint64(1)) << np.uint64(_LENGTH_AT) | (keys & mask) >> np.uint64(8)


def suffixes_of(keys: np.ndarray) -> np.ndarray:
    """The n-gram without its first byte; the empty one stays."""
    length = keys >> np.uint64(_LENGTH_AT)
    shorter = np.maximum(length, np.uint64(1)) - np.uint64(1)
    return shorter << np.uint64(_LENGTH_AT) | keys & ((np.uint64(1) << (np.uint64(8) * shorter)) - np.uint64(1))


def ngrams(words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all orders in the words and their counts, in order.

    A key holds the length in its highest byte and the bytes below it. Words are taken some
    thousands at a time, which bounds the memory.
    """
    parts = [_ngrams(words[at:at + SOME_WORDS], counts[at:at + SOME_WORDS]) for at in range(0, len(words), SOME_WORDS)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def _ngrams(words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    at = np.arange(len(data))
    blank = np.maximum.accumulate(np.where(data == BLANK, at, 0))
    behind = at[1:] - blank[:-1]  # bytes between a symbol and the start of its word
    weight = np.repeat(counts, np.array([len(w) + 1 for w in words]))
    keys, totals = [], []
    packed = np.zeros(len(data) - 1, np.uint64)
    for order in range(1, ORDER + 1):
        back = order - 1
        low = max(0, back - 1)
        packed[low:] |= data[low + 1 - back:len(data) - back].astype(np.uint64) << np.uint64(8 * back)
        valid = behind >= back
        distinct, inverse = np.unique(packed[valid], return_inverse=True)
        keys.append(distinct | np.uint64(order) << np.uint64(_LENGTH_AT))
        totals.append(np.bincount(inverse, weight[valid], len(distinct)).astype(np.int64))
    return np.concatenate(keys), np.concatenate(totals)


class Automaton:
    """States, arcs and failure arcs from n-grams with their counts and those of their contexts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, context_counts: np.ndarray, context_kinds: np.ndarray) -> None:
        seen = counts > 0
        order = np.argsort(keys[seen], kind="stable")
        keys, counts = keys[seen][order], counts[seen][order].astype(np.float64)
        totals, kinds = context_counts[seen][order].astype(np.float64), context_kinds[seen][order].astype(np.float64)
        self.arcs = keys
        contexts = contexts_of(keys)
        # probabilities from short n-grams to long ones: keys sort by length first
        probability = np.empty(len(keys))
        lengths = (keys >> np.uint64(_LENGTH_AT)).astype(np.int64)
        for length in range(1, ORDER + 1):
            own = np.flatnonzero(lengths == length)
            if length == 1:
                lower = np.full(len(own), 1 / SYMBOLS)
            else:
                lower = probability[np.searchsorted(keys, suffixes_of(keys[own]))]
            probability[own] = (counts[own] + kinds[own] * lower) / (totals[own] + kinds[own])
        self.weights = np.log10(probability)
        self.states, first = np.unique(np.append(contexts, np.uint64(0)), return_index=True)
        rest = np.append(kinds / (totals + kinds), 1.0)[first]
        self.failures = np.searchsorted(self.states, suffixes_of(self.states))
        self.failure_weights = np.log10(rest)
        self.start = self.longest(np.array([np.uint64(1) << np.uint64(_LENGTH_AT) | np.uint64(BLANK)], np.uint64))[0]

    def longest(self, contexts: np.ndarray) -> np.ndarray:
        """The state of the longest suffix of each context that is a state."""
        while True:
            at = np.searchsorted(self.states, contexts)
            missing = self.states[np.minimum(at, len(self.states) - 1)] != contexts
            if not missing.any():
                return at
            contexts = np.where(missing, suffixes_of(contexts), contexts)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights and states after one byte, over as many failure arcs as it takes."""
        weight, after = np.zeros(len(state)), np.zeros(len(state), np.int64)
        left = np.arange(len(state))
        state = state.copy()
        while len(left):
            context = self.states[state]
            length = context >> np.uint64(_LENGTH_AT)
            body = context & np.uint64((1 << _LENGTH_AT) - 1)
            key = (length + np.uint64(1)) << np.uint64(_LENGTH_AT) | body << np.uint64(8) | symbol
            at = np.searchsorted(self.arcs, key)
            found = self.arcs[np.minimum(at, len(self.arcs) - 1)] == key if len(self.arcs) else np.zeros(len(key), bool)
            weight[left[found]] += self.weights[at[found]]
            trimmed = np.where(length + np.uint64(1) < ORDER, key, suffixes_of(key))
            after[left[found]] = self.longest(trimmed[found])
            weight[left[~found]] += self.failure_weights[state[~found]]
            # a byte that even the empty context lacks
            lost = ~found & (length == 0)
            weight[left[lost]] -= np.log10(SYMBOLS)
            after[left[lost]] = np.searchsorted(self.states, np.uint64(0))
            on = ~found & (length > 0)
            left, state, symbol = left[on], self.failures[state[on]], symbol[on]
        return weight, after

    def spell(self, words: list[bytes]) -> np.ndarray:
        """The log10 probability of each word, up to the blank behind it."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        total, state = np.zeros(len(words)), np.full(len(words), self.start, np.int64)
        longest = np.argsort(-lengths, kind="stable")
        sorted_lengths = -lengths[longest]
        for place in range(int(lengths.max(initial=-1)) + 1):
            live = longest[:np.searchsorted(sorted_lengths, -place, side="right")]
            inside = lengths[live] > place
            symbol = np.full(len(live), BLANK, np.uint64)
            symbol[inside] = data[starts[live[inside]] + place]
            weight, state[live] = self.step(state[live], symbol)
            total[live] += weight
        return total


class Totals(NamedTuple):
    """Over all training documents: tokens, distinct tokens, documents."""

    tokens: int
    kinds: int
    documents: int


_ASKS = ("shard long, bucket int, word_keys binary, word_counts binary, gram_keys binary, gram_counts binary, "
         "pair_keys binary, pair_counts binary")
_ANSWERS = "shard long, bucket int, words binary, gram_keys binary, grams binary, contexts binary, kinds binary, pairs binary"


def _packed(array: np.ndarray) -> bytes:
    return array.tobytes()


def _planes(numbers: np.ndarray, width: int = 4) -> bytes:
    """All lowest bytes, then all second ones and so on up to ``width``: the upper ones compress to little."""
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize)[:, :width].T.tobytes()


def _from_planes(packed: bytes, width: int = 4, kind: type = np.uint32) -> np.ndarray:
    numbers = np.zeros((len(packed) // width, np.dtype(kind).itemsize), np.uint8)
    numbers[:, :width] = np.frombuffer(packed, np.uint8).reshape(width, -1).T
    return numbers.view(kind).ravel()


def _squeezed(data: bytes) -> bytes:
    """Compressed behind its length."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unsqueezed(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as few planes as the highest needs, compressed."""
    return _squeezed(_planes(counts, max(1, (int(counts.max(initial=0)).bit_length() + 7) // 8)))


def _from_narrow(packed: bytes, n: int) -> np.ndarray:
    data = _unsqueezed(packed)
    return _from_planes(data, max(1, len(data) // max(1, n)), np.int64)


def _shard_rows(shard: int, ids: list, held: list[bool], arrays: list[np.ndarray], number: dict[bytes, int],
                buckets: int, schema: pa.Schema, contexts: bool) -> Iterator[pa.RecordBatch]:
    """The row with a shard's documents, and one for each bucket that it asks."""
    stream, sizes = np.concatenate(arrays), np.array([len(a) for a in arrays], np.int64)
    arrays.clear()  # they would weigh beside what follows
    # frequent words get small numbers, whose upper bytes take no room once compressed
    often = np.zeros(len(number), np.int64)
    for some in _slices(len(stream)):
        np.add.at(often, stream[some], 1)
    frequent = np.argsort(-often, kind="stable")
    rank = np.empty(len(frequent), np.uint32)
    rank[frequent] = np.arange(len(frequent), dtype=np.uint32)
    for some in _slices(len(stream)):
        stream[some] = rank[stream[some]]
    words = list(number)
    words = [words[i] for i in frequent.tolist()]
    number.clear()
    learnt = ~np.array(held, bool)
    taught = np.repeat(learnt, sizes)
    counts = np.zeros(len(words), np.int64)
    for some in _slices(len(stream)):
        np.add.at(counts, stream[some], taught[some])
    del taught
    rows = [{"shard": shard, "bucket": -1, "ids": ids, "held": held, "sizes": sizes.tolist(), "stream": _squeezed(_planes(stream)),
             "vocabulary": _squeezed(b" ".join(words))}]
    yield pa.RecordBatch.from_pylist(rows, schema)
    rows, volume = [], 0
    grams, gram_counts = ngrams(words, counts)
    if contexts:
        keys, counts = hashes([*words, b""]), np.append(counts, learnt.sum())
        pairs, pair_counts = _counted_pairs(_behind(stream, sizes, len(words)), keys, np.repeat(learnt, sizes + 1))
    else:
        keys, pairs, pair_counts = hashes(words), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    pair_bounds = np.searchsorted(pairs, _pair_bounds(buckets))
    places = [_bucket(keys, buckets), _bucket(contexts_of(grams), buckets)]
    orders = [np.argsort(p, kind="stable") for p in places]
    bounds = [np.searchsorted(p[o], np.arange(buckets + 1)) if len(p) > buckets else None for p, o in zip(places, orders)]
    asked = np.unique(np.concatenate([*places, np.flatnonzero(np.diff(pair_bounds))]))
    sorted_places = [p[o] for p, o in zip(places, orders)]
    for bucket in asked.tolist():
        row = {"shard": shard, "bucket": bucket}
        for name, k, c, o, s, b in zip(("word", "gram"), (keys, grams), (counts, gram_counts), orders, sorted_places, bounds):
            low, high = (b[bucket], b[bucket + 1]) if b is not None else (
                np.searchsorted(s, bucket), np.searchsorted(s, bucket, side="right"))
            some = o[low:high]
            row[f"{name}_keys"], row[f"{name}_counts"] = _packed(k[some]), _packed(c[some])
        some = slice(*pair_bounds[bucket:bucket + 2])
        row["pair_keys"], row["pair_counts"] = _planes(pairs[some], PAIR_KEY_BYTES), _narrow(pair_counts[some])
        rows.append(row)
        volume += sum(len(x) for x in row.values() if isinstance(x, bytes))
        if volume >= SENT_BYTES:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows, volume = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def _joined(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed arrays, and how many each row has."""
    parts = [np.frombuffer(x or b"", kind) for x in column.to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, kind), np.array([len(p) for p in parts], np.int64)


def _answer(asks: pa.Table) -> pa.Table:
    """Totals over all shards for what each shard asked of one bucket."""
    shards, bucket = asks.column("shard").to_pylist(), asks.column("bucket")[0].as_py()
    keys, sizes = _joined(asks.column("word_keys"), np.uint64)
    counts, _ = _joined(asks.column("word_counts"), np.int64)
    distinct, inverse = np.unique(keys, return_inverse=True)
    totals = np.bincount(inverse, counts, len(distinct)).astype(np.int64)
    grams, gram_sizes = _joined(asks.column("gram_keys"), np.uint64)
    gram_counts, _ = _joined(asks.column("gram_counts"), np.int64)
    kinds, gram_inverse = np.unique(grams, return_inverse=True)
    gram_totals = np.bincount(gram_inverse, gram_counts, len(kinds)).astype(np.int64)
    contexts, of = np.unique(contexts_of(kinds), return_inverse=True)
    context_totals = np.bincount(of, gram_totals, len(contexts)).astype(np.int64)
    context_kinds = np.bincount(of, gram_totals > 0, len(contexts)).astype(np.int64)

    pair_keys = [_from_planes(x, PAIR_KEY_BYTES, np.uint64) for x in asks.column("pair_keys").to_pylist()]
    pair_sizes = np.array([len(x) for x in pair_keys], np.int64)
    pairs = np.concatenate(pair_keys)
    pair_counts = np.concatenate([_from_narrow(x, n) for x, n in zip(asks.column("pair_counts").to_pylist(), pair_sizes.tolist())])
    pairs, pair_inverse = np.unique(pairs, return_inverse=True)
    pair_totals = np.bincount(pair_inverse, pair_counts, len(pairs)).astype(np.int64)

    def cut(array: np.ndarray, by: np.ndarray, packed: Callable[[np.ndarray], bytes] = _packed) -> list[bytes]:
        ends = np.cumsum(by)
        return [packed(array[e - n:e]) for e, n in zip(ends.tolist(), by.tolist())]

    summary = np.array([totals.sum(), (totals > 0).sum()], np.int64)
    columns = {
        "shard": [*shards, -1], "bucket": [bucket] * (len(shards) + 1), "words": [*cut(totals[inverse], sizes), _packed(summary)],
        "gram_keys": [*cut(grams, gram_sizes), b""], "grams": [*cut(gram_totals[gram_inverse], gram_sizes), b""],
        "contexts": [*cut(context_totals[of[gram_inverse]], gram_sizes), b""],
        "kinds": [*cut(context_kinds[of[gram_inverse]], gram_sizes), b""],
        "pairs": [*cut(pair_totals[pair_inverse], pair_sizes, _narrow), b""]}
    kinds_of = {"shard": pa.int64(), "bucket": pa.int32()}
    return pa.table({k: pa.array(v, kinds_of.get(k, pa.binary())) for k, v in columns.items()})


def token_scores(words: list[bytes], counts: np.ndarray, spelled: np.ndarray, totals: Totals) -> np.ndarray:
    """The model's log10 probability of each word: its own arc and its spelling together."""
    if not totals.tokens:
        return np.log10(0.5) + spelled
    own = np.maximum(counts - DISCOUNT, 0) / totals.tokens
    rest = np.log10(DISCOUNT * totals.kinds / totals.tokens) + spelled
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(own), rest * np.log(10)) / np.log(10)


def follower_scores(model: np.ndarray, before: np.ndarray, together: np.ndarray) -> np.ndarray:
    """log10 probability of tokens behind others: the arc of the pair, or the failure arc and the arc behind it.

    ``model`` is that of the tokens without a context, ``before`` counts the tokens before them and ``together`` both.
    """
    with np.errstate(divide="ignore"):
        both = np.logaddexp(np.log(together), (np.log10(CONTEXT_WEIGHT) + model) * np.log(10)) / np.log(10)
    return both - np.log10(before + CONTEXT_WEIGHT)


def _asked_pairs(answers: pa.Table, behind: np.ndarray, keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of a shard's texts in order and how often each occurs, from answers in the order of their buckets."""
    distinct, _ = _counted_pairs(behind, keys, np.zeros(len(behind), bool))
    asked = np.diff(np.searchsorted(distinct, _pair_bounds(buckets)))
    counts = np.concatenate([_from_narrow(x, asked[bucket]) for bucket, x in zip(
        answers.column("bucket").to_pylist(), answers.column("pairs").to_pylist())])
    return distinct, counts


def _scored(documents: pa.Table, answers: pa.Table, totals: Totals, doc_id: str, id_type: pa.DataType, buckets: int,
            contexts: bool) -> pa.Table:
    """Scores of one shard's documents."""
    answers = answers.sort_by("bucket")
    out: dict[str, list] = {k: [] for k in ("id", "held_out", "n_tokens", "n_known", "base_score", "score")}
    for row in documents.to_pylist():
        words = _unsqueezed(row["vocabulary"]).split()
        keys = hashes([*words, b""] if contexts else words)
        counts = np.zeros(len(keys), np.int64)
        counts[np.argsort(_bucket(keys, buckets), kind="stable")] = _joined(answers.column("words"), np.int64)[0]
        n_words = len(words)
        counts = counts[:n_words]
        automaton = Automaton(*[_joined(answers.column(c), k)[0] for c, k in (
            ("gram_keys", np.uint64), ("grams", np.int64), ("contexts", np.int64), ("kinds", np.int64))])
        spelled = np.concatenate([automaton.spell(words[at:at + SOME_WORDS]) for at in range(0, max(1, n_words), SOME_WORDS)])
        model = token_scores(words, counts, spelled, totals)
        del automaton, words, spelled  # they would weigh beside what follows
        floor = totals.tokens + 0.1 * (totals.kinds + 1)
        base = np.log10((counts + 0.1) / floor)
        sizes = np.array(row["sizes"], np.int64)
        stream = _from_planes(_unsqueezed(row["stream"]))
        document = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        end_model = np.log10((totals.documents - DISCOUNT) / totals.tokens) if totals.tokens else np.log10(0.5)
        end_base = np.log10((totals.documents + 0.1) / floor)

        def summed(values: np.ndarray) -> np.ndarray:
            totals_of = np.zeros(len(sizes))
            for some in _slices(len(stream)):
                np.add.at(totals_of, document[some], values[stream[some]])
            return totals_of

        n_known, base_score = summed((counts > 0).astype(np.float64)).astype(np.int64), summed(base) + end_base
        if contexts:
            behind = _behind(stream, sizes, n_words)
            document = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
            del stream
            pairs, pair_counts = _asked_pairs(answers, behind, keys, buckets)
            tokens, before = np.append(model, end_model), np.append(counts, totals.documents)
            score = np.zeros(len(sizes))
            for some in _slices(len(behind)):
                together = pair_counts[np.searchsorted(pairs, _pair_keys(behind, keys, some))]
                np.add.at(score, document[some], follower_scores(tokens[behind[some]], before[_before(behind, some)], together))
        else:
            score = summed(model) + end_model

        out["id"] += row["ids"]
        out["held_out"] += row["held"]
        out["n_tokens"] += (sizes + 1).tolist()
        out["n_known"] += (n_known + int(totals.documents > 0)).tolist()
        out["base_score"] += base_score.tolist()
        out["score"] += score.tolist()
    n = len(out["id"])
    return pa.table({
        doc_id: pa.array(out["id"], id_type), "held_out": pa.array(out["held_out"], pa.bool_()),
        "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
        "train_tokens": pa.array([totals.tokens] * n, pa.int64()), "base_score": pa.array(out["base_score"], pa.float64()),
        "score": pa.array(out["score"], pa.float64())})


def score(df: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", contexts: bool = False) -> DataFrame:
    """Tokens, known tokens, base score and model score per row; learns from rows where ``held_out`` is false.

    With ``contexts`` the model scores every word and the end behind the word before, else each by itself.
    """
    rows = df.select(F.col(doc_id).alias("id"), held_out.alias("held"), F.col(text).alias("text"))
    id_field = df.schema[doc_id]
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    fields = T.StructType([
        *T._parse_datatype_string(_ASKS).fields, T.StructField("ids", T.ArrayType(id_field.dataType)),
        T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("stream", T.BinaryType()), T.StructField("vocabulary", T.BinaryType())])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held_bytes = TaskContext.get().partitionId(), 0, 0
        ids, held, arrays, number = [], [], [], {}
        schema = None
        for batch in chunks(batches, "text"):  # never empty
            if schema is None:
                id_type = batch.schema.field("id").type
                schema = pa.schema([
                    ("shard", pa.int64()), ("bucket", pa.int32()), ("word_keys", pa.binary()), ("word_counts", pa.binary()),
                    ("gram_keys", pa.binary()), ("gram_counts", pa.binary()), ("pair_keys", pa.binary()),
                    ("pair_counts", pa.binary()), ("ids", pa.list_(id_type)),
                    ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("stream", pa.binary()),
                    ("vocabulary", pa.binary())])
            ids += batch.column(0).to_pylist()
            held += batch.column(1).to_pylist()
            for t in texts_of(batch, "text"):
                words = words_of(t)
                for word in set(words).difference(number):
                    number[word] = len(number)
                arrays.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                held_bytes += len(t)
            if held_bytes >= SHARD_BYTES:
                yield from _shard_rows(part << 24 | made, ids, held, arrays, number, buckets, schema, contexts)
                made, held_bytes = made + 1, 0
                ids, held, arrays, number = [], [], [], {}
        if ids:
            yield from _shard_rows(part << 24 | made, ids, held, arrays, number, buckets, schema, contexts)

    stored = materialize(rows.mapInArrow(asked, fields), "lm-shards", **LONG_ROWS)
    asks = stored.filter("bucket >= 0").select(
        "shard", "bucket", "word_keys", "word_counts", "gram_keys", "gram_counts", "pair_keys", "pair_counts")
    answers = materialize(asks.groupBy("bucket").applyInArrow(_answer, _ANSWERS), "lm-answers", **LONG_ROWS)
    documents = stored.filter("bucket < 0").select("shard", "ids", "held", "sizes", "stream", "vocabulary")
    taught = documents.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    tokens = kinds = 0
    # one row per bucket, two numbers each, added up on the executors
    pair = answers.filter("shard = -1").mapInArrow(_summaries, "tokens long, kinds long").agg(
        F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    tokens, kinds = pair["tokens"] or 0, pair["kinds"] or 0
    # with contexts the boundary of texts is counted as a word
    totals = Totals(tokens, kinds, taught) if contexts else Totals(tokens + taught, kinds + int(taught > 0), taught)
    schema = T.StructType([
        T.StructField(doc_id, id_field.dataType), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scored(left, right, totals, doc_id, left.schema.field("ids").type.value_type, buckets, contexts)

    return (documents.groupBy("shard").cogroup(answers.filter("shard >= 0").groupBy("shard")).applyInArrow(scored, schema))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [np.frombuffer(x, np.int64) for x in batch.column(batch.schema.get_field_index("words")).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(b[0]) for b in both], pa.int64()), pa.array([int(b[1]) for b in both], pa.int64())],
            names=["tokens", "kinds"])
