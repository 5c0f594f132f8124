"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks.

Two words are compared by the subsequences of ``ORDER`` characters that they share, of which at
most ``SPAN - ORDER`` characters may be skipped between the first and the last; each skipped character
halves the weight. An insult with a letter put in, left out or spaced out therefore stays close
to its plain form. Words are read with marks for their begin and end, so that a stem at the
begin of a word is told from the same letters inside it.

Labels belong to whole texts, of which only some words are toxic. Every distinct word of the
labelled texts is an example of either class, weighted by the share of texts of the class that
hold it; positive weights are scaled by ``TRUST`` below one, so that words common to both classes end on
the clean side. The machine is linear in the kernels with ``LANDMARKS`` words (Nyström map), picked by
pivoted Cholesky among the words with the strongest evidence and the most common ones. As the
kernel is a product of subsequence weights, the sum over all landmarks folds into one weight per
subsequence, and the margin of a word costs the same for any number of landmarks. The score of
a text is a logistic function of the largest margins of its distinct words, their number and size.

The model is fitted on at most ``fit_rows`` labelled texts, those with the smallest hashed ids.
Words are counted in Spark over all of these texts; the driver receives at most ``EXAMPLES`` words and
seven numbers a text. Scoring is one narrow pass over whole texts; margins of seen words are
remembered up to a fixed number, which changes no result.

Defined results: null text counts as empty, and texts without words have the score of no
evidence; case, punctuation and the order of words do not matter; single characters in a row
count as one word, and words beyond ``LONGEST`` characters are read in overlapping parts; labels that
are null are left out; a document with several labels has their rounded mean; without labels of
both kinds the score is the smoothed share of label 1. Equal texts get equal scores, whatever
their ids; an empty table gives no rows. New columns are named apart from existing ones.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.llm.common import Steps, chunks, free_name, texts_of, with_columns

FIT_ROWS = 20_000
THRESHOLD = 0.5
ORDER, SPAN, DECAY = 4, 7, 0.5
LONGEST = 32
LANDMARKS = 192
TRUST, COST = 0.6, 4.0
EVIDENT, COMMON, RANDOM = 4000, 3000, 12_000
EXAMPLES = EVIDENT + COMMON + RANDOM
MEMORY = 500_000
BLOCK_KEYS = 1 << 18
GROUP_CHARACTERS = 1 << 20
SIEVE_BITS = 20
TOP = 3

_MARKS = re.compile(r"[^\w\s]+|_+")
_BEGIN, _END = "\x02", "\x03"
_STEP, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _parts(word: str) -> list[str]:
    """The word, or parts of it so that every run of ``SPAN`` characters lies within one."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i:i + LONGEST] for i in range(0, len(word) - SPAN + 1, LONGEST - SPAN + 1)]


def words_of(text: str) -> set[str]:
    """Distinct words of a text as the kernel reads them."""
    found: set[str] = set()
    letters: list[str] = []
    for token in [*_MARKS.sub("", text.lower()).split(), ""]:
        if len(token) == 1:
            letters.append(token)
            continue
        if letters:
            found.update(_parts("".join(letters)))
            letters.clear()
        if token:
            found.update(_parts(token))
    return found


@lru_cache(maxsize=64)
def _places(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all subsequences in a string of a length, and their weights."""
    chosen = [(first, *rest) for first in range(length) for rest in combinations(range(first + 1, min(length, first + SPAN)), ORDER - 1)]
    places = np.array(chosen, np.int64).reshape(-1, ORDER)
    return places, DECAY ** (places[:, -1] - places[:, 0] + 1.0 - ORDER)


def _keys(words: list[str], length: int) -> np.ndarray:
    """A number for each subsequence of marked words of one length."""
    marked = "".join(f"{_BEGIN}{w}{_END}" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint64) * _SPREAD
    places, _ = _places(length)
    keys = np.zeros((len(words), len(places)), np.uint64)
    for j in range(ORDER):
        keys = (keys * _STEP) ^ codes[:, places[:, j]]
        keys ^= keys >> np.uint64(29)
    return keys


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (place in ``words``, subsequence, weight); the squares of a word's weights add up to one."""
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word) + 2, []).append(i)
    for length, members in by_length.items():
        places, weights = _places(length)
        if not len(places):
            continue
        step = max(1, BLOCK_KEYS // len(places))
        for start in range(0, len(members), step):
            some = members[start:start + step]
            keys = _keys([words[i] for i in some], length)
            order = np.argsort(keys, axis=1)
            keys = np.take_along_axis(keys, order, 1)
            first = np.ones(keys.shape, bool)
            first[:, 1:] = keys[:, 1:] != keys[:, :-1]
            at = np.flatnonzero(first)
            total = np.add.reduceat(weights[order].ravel(), at)
            row = at // keys.shape[1]
            norm = np.sqrt(np.bincount(row, total * total, len(some)))
            yield np.array(some)[row], keys.ravel()[at], total / norm[row]


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys stand in the sorted table, and where."""
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    held = table[at] == keys
    return held, at[held]


def kernels(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernels of all words with all landmarks."""
    result = np.zeros((len(words), len(landmarks)))
    blocks = list(subsequences(landmarks))
    if not blocks:
        return result
    rows, keys, weights = (np.concatenate(x) for x in zip(*blocks))
    table = np.unique(keys)
    by_key = np.zeros((len(table), len(landmarks)), np.float32)
    by_key[np.searchsorted(table, keys), rows] = weights
    for start in range(0, len(words), 512):
        some = words[start:start + 512]
        dense = np.zeros((len(some), len(table)), np.float32)
        for row, key, weight in subsequences(some):
            held, at = _found(table, key)
            dense[row[held], at] = weight[held]
        result[start:start + 512] = dense @ by_key
    return result


def spread_out(words: list[str], worth: np.ndarray, number: int) -> list[str]:
    """Words picked by pivoted Cholesky: each time the one whose worth the picked ones explain least."""
    blocks = list(subsequences(words))
    if not blocks:
        return []
    rows, keys, weights = (np.concatenate(x) for x in zip(*blocks))
    places = np.unique(keys, return_inverse=True)[1]
    own = np.zeros(places.max() + 1)
    rest, factors, picked = np.bincount(rows, weights * weights, len(words)), np.zeros((len(words), number)), []
    for j in range(min(number, len(words))):
        best = int((rest * worth).argmax())
        if rest[best] < 1e-3 or worth[best] <= 0:
            break
        chosen = rows == best
        own[:] = 0
        own[places[chosen]] = weights[chosen]
        column = np.bincount(rows, weights * own[places], len(words))
        factors[:, j] = (column - factors[:, :j] @ factors[best, :j]) / np.sqrt(rest[best])
        rest = np.maximum(rest - factors[:, j] ** 2, 0)
        rest[best] = 0
        picked.append(words[best])
    return picked


def hinge(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray, cost: float = COST) -> np.ndarray:
    """Weights of a support vector machine with squared hinge loss, by Newton steps; the last column is the constant."""
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-3

    def loss(b: np.ndarray) -> float:
        m = x @ b
        return 0.5 * (ridge * b * b).sum() + cost * (toxic @ np.maximum(0, 1 - m) ** 2 + clean @ np.maximum(0, 1 + m) ** 2)

    b = np.zeros(x.shape[1])
    for _ in range(60):
        m = x @ b
        up, down = toxic * (m < 1), clean * (m > -1)
        slope = ridge * b + 2 * cost * (x.T @ (up * (m - 1) + down * (m + 1)))
        step = np.linalg.solve(np.diag(ridge) + 2 * cost * (x.T * (up + down)) @ x, slope)
        size, before = 1.0, loss(b)
        while loss(b - size * step) > before and size > 1e-4:
            size /= 2
        b = b - size * step
        if np.abs(step).max() < 1e-6:
            break
    return b


def _logistic(values: np.ndarray, labels: np.ndarray, ridge: float) -> np.ndarray:
    b, flat = np.zeros(values.shape[1]), np.full(values.shape[1], ridge)
    flat[-1] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(values @ b, -30, 30)))
        step = np.linalg.solve((values.T * (p * (1 - p) + 1e-9)) @ values + np.diag(flat), values.T @ (p - labels) + flat * b)
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    return b


_remembered: dict[str, dict[str, float]] = {}


def _memory(model: Model) -> dict[str, float]:
    """Margins that earlier tasks of this Python worker computed with the same model."""
    if model.name not in _remembered:
        _remembered.clear()
    return _remembered.setdefault(model.name, {})


@dataclass
class Model:
    """Weights of subsequences for the margin of a word, and of a text's margins for its score."""

    share: float
    name: str = ""
    keys: np.ndarray | None = None
    weights: np.ndarray | None = None
    offset: float = 0.0
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    text_weights: np.ndarray | None = None

    def word_margins(self, words: list[str]) -> np.ndarray:
        total = np.full(len(words), self.offset)
        # most subsequences have no weight: their upper bits tell without a search
        shift = np.uint64(64 - SIEVE_BITS)
        sieve = np.zeros(1 << SIEVE_BITS, bool)
        sieve[self.keys >> shift] = True
        for row, key, weight in subsequences(words):
            likely = np.flatnonzero(sieve[key >> shift])
            held, at = _found(self.keys, key[likely])
            chosen = likely[held]
            total += np.bincount(row[chosen], self.weights[at] * weight[chosen], len(words))
        return total

    def margins(self, texts: list[set[str]], memory: dict[str, float]) -> Iterator[np.ndarray]:
        """Margins of the words of each text, largest first."""
        new = sorted(set().union(*texts).difference(memory))
        if len(memory) + len(new) > MEMORY:
            memory.clear()
            new = sorted(set().union(*texts))
        memory.update(zip(new, self.word_margins(new).tolist()))
        for words in texts:
            yield np.sort(np.array([memory[w] for w in words] + [min(self.offset, -1.0)] * TOP))[::-1]

    def values(self, texts: list[str], memory: dict[str, float]) -> np.ndarray:
        """Largest margins, sum and number of positive ones, number of words and share of positive ones."""
        result: list[list[float]] = []
        group: list[set[str]] = []
        size = 0
        for place, text in enumerate(texts):
            group.append(words_of(text))
            size += len(text)
            if size < GROUP_CHARACTERS and place + 1 < len(texts):
                continue
            for words, margins in zip(group, self.margins(group, memory)):
                positive = margins[margins > 0]
                result.append([*margins[:TOP], positive.sum(), np.log1p(len(positive)), np.log1p(len(words)), len(positive) / (len(words) + 5)])
            group, size = [], 0
        return np.array(result).reshape(-1, TOP + 4)

    def scores(self, texts: list[str], memory: dict[str, float]) -> np.ndarray:
        if self.text_weights is None:
            return np.full(len(texts), self.share)
        return self.of_values(self.values(texts, memory))

    def of_values(self, values: np.ndarray) -> np.ndarray:
        shaped = np.c_[(values - self.center) / self.scale, np.ones(len(values))]
        return 1 / (1 + np.exp(-np.clip(shaped @ self.text_weights, -30, 30)))


def train_words(words: list[str], toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, landmarks: int = LANDMARKS) -> Model:
    """The machine over words, from the numbers of toxic and clean texts that hold each."""
    model = Model((n_toxic + 1) / (n_toxic + n_clean + 2), uuid.uuid4().hex)
    evidence = toxic * np.log((toxic + 0.5) / (n_toxic + 1) * (n_clean + 1) / (clean + 0.5))
    evident = [i for i in np.lexsort((np.arange(len(words)), -evidence)) if evidence[i] > 0][:2000]
    common = [i for i in np.lexsort((np.arange(len(words)), -clean)) if clean[i] > 0][:1500]
    picked = spread_out([words[i] for i in evident], evidence[evident], landmarks * 2 // 3)
    picked += spread_out([words[i] for i in common], np.sqrt(clean[common]), landmarks - len(picked))
    picked = list(dict.fromkeys(picked))
    values, vectors = np.linalg.eigh(kernels(picked, picked))
    held = values > 1e-4 * values.max(initial=0)
    nystroem = vectors[:, held] / np.sqrt(values[held])
    x = np.c_[kernels(words, picked) @ nystroem, np.ones(len(words))]
    scale = (n_toxic + n_clean) / 20
    b = hinge(x, toxic / n_toxic * TRUST * scale, clean / n_clean * scale)
    per_landmark, model.offset = nystroem @ b[:-1], float(b[-1])
    blocks = list(subsequences(picked))
    if blocks:
        rows, keys, weights = (np.concatenate(x) for x in zip(*blocks))
        model.keys, place = np.unique(keys, return_inverse=True)
        model.weights = np.bincount(place, per_landmark[rows] * weights)
    else:
        model.keys, model.weights = np.zeros(1, np.uint64), np.zeros(1)
    return model


def _chosen(labels: DataFrame, doc_id: str, label: str, held_out: Column | None, fit_rows: int) -> DataFrame:
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    if held_out is not None:
        known = known.filter(~held_out)
    return (known.groupBy(doc_id).agg(F.round(F.avg(label)).cast("int").alias("_label"))
            .orderBy(F.xxhash64(doc_id), doc_id).limit(fit_rows))


def _counted(rows: DataFrame, text: str) -> DataFrame:
    """Per word the numbers of toxic and clean texts that hold it; the word null counts the texts."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            counts: tuple[Counter, Counter] = Counter(), Counter()
            for value, label in zip(texts_of(batch, text), batch.column(batch.schema.get_field_index("_label")).to_pylist()):
                counts[label].update([None, *words_of(value)])
            words = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *(pa.array([counts[k][w] for w in words], pa.int64()) for k in (1, 0))],
                names=["word", "toxic", "clean"])

    return (rows.mapInArrow(counted, "word string, toxic long, clean long").groupBy("word")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _examples(counts: DataFrame, n_toxic: int, n_clean: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words with the strongest evidence, the most common ones and random others."""
    words = counts.filter(F.col("word").isNotNull())
    evidence = F.col("toxic") * F.log((F.col("toxic") + 0.5) / (n_toxic + 1) * (n_clean + 1) / (F.col("clean") + 0.5))
    picks = [
        words.filter((F.col("toxic") > 1) & (F.length("word") > 2) & (evidence > 0)).orderBy(F.round(evidence, 6).desc(), "word").limit(EVIDENT),
        words.filter("clean > 0").orderBy(F.desc("clean"), "word").limit(COMMON),
        words.orderBy(F.xxhash64("word"), "word").limit(RANDOM)]
    held = {r["word"]: (r["toxic"], r["clean"]) for pick in picks for r in pick.collect()}
    names = sorted(held)
    numbers = np.array([held[w] for w in names], np.float64).reshape(-1, 2)
    return names, numbers[:, 0], numbers[:, 1]


def _text_values(rows: DataFrame, text: str, model: Model) -> DataFrame:
    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(model)
        for batch in chunks(batches, text):
            yield with_columns(batch, ["_label"], {
                "values": pa.array(list(model.values(texts_of(batch, text), memory)), pa.list_(pa.float64()))})

    return rows.mapInArrow(computed, "_label int, values array<double>")


def fit(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        held_out: Column | None = None, fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS) -> Model:
    """A model from at most ``fit_rows`` labelled documents for which ``held_out`` is false."""
    # at most fit_rows pairs of numbers
    chosen = F.broadcast(_chosen(labels, doc_id, label, held_out, fit_rows))
    rows = documents.select(doc_id, text).join(chosen, doc_id).select(text, "_label")
    steps = Steps(documents.sparkSession)
    counts = steps.write(_counted(rows, text), "word-counts")
    texts = counts.filter(F.col("word").isNull()).first()
    n_toxic, n_clean = (texts["toxic"], texts["clean"]) if texts else (0, 0)
    if not n_toxic or not n_clean:
        steps.drop()
        return Model((n_toxic + 1) / (n_toxic + n_clean + 2))
    words, toxic, clean = _examples(counts, n_toxic, n_clean)
    steps.drop()
    model = train_words(words, toxic, clean, n_toxic, n_clean, landmarks)
    held = _text_values(rows, text, model).toArrow()
    values = np.array(held.column("values").to_pylist(), np.float64).reshape(-1, TOP + 4)
    model.center, model.scale = values.mean(0), values.std(0) + 1e-9
    shaped = np.c_[(values - model.center) / model.scale, np.ones(len(values))]
    model.text_weights = _logistic(shaped, held.column("_label").to_numpy().astype(np.float64), 1e-4 * len(values))
    return model


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 for each text."""
    keep, name = df.columns, free_name(df, out)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(model)
        for batch in chunks(batches, text):
            yield with_columns(batch, keep, {name: pa.array(model.scores(texts_of(batch, text), memory), pa.float64())})

    return df.mapInArrow(scored, schema)


def toxic_words(model: Model, words: Iterable[str]) -> dict[str, float]:
    """Margins of words, for a look into the model; above 0 is toxic."""
    names = sorted({w for word in words for w in words_of(word)})
    return dict(zip(names, model.word_margins(names).tolist()))
