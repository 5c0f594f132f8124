"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins and owns a lookup table of log-odds; some pairs of
features own a two-dimensional table. The tables come from cyclic boosting: round after round
each feature in turn gets a shallow tree over its ordered bins, fitted to the gradient of the
logistic loss and added, shrunk, to its table. Afterwards the pairs that reduce the loss most
are boosted in the same way on what the single features leave unexplained. Scoring is a sum of
table entries, vectorised over the texts of a batch.

The model is fitted on at most ``fit_rows`` labelled rows, those with the smallest hashed ids;
only their feature numbers, never texts, reach the driver. Scoring is one narrow pass over all
whole texts.

Defined results: null text counts as empty, and the empty text has a score like any other;
labels that are null are left out; a document with several labels has their rounded mean;
without labels of both kinds the score is the smoothed share of label 1. Equal texts get equal
scores, whatever their ids; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.llm.common import chunks, free_name, texts_of, with_columns

FIT_ROWS = 20_000
THRESHOLD = 0.7
FEATURES = (
    "log_words", "word_bytes", "distinct_words", "top_word", "repeated_neighbour", "short_words", "long_words",
    "upper", "digits", "beyond_ascii", "stops", "signs", "shouts", "bars", "log_lines", "distinct_lines",
    "line_bytes", "most_upper_line", "most_signs_line", "most_digits_line")

# class of each byte: 1 lower, 2 upper, 3 digit, 4 beyond ASCII, 5 sentence marks, 6 other signs, 7 shouts, 0 the rest
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 4
_CLASS[list(b".,;:'\"()-")], _CLASS[list(b"#$%&*+/<=>@[\\]^_`{|}~")], _CLASS[list(b"!?")] = 5, 6, 7


def features(text: str) -> list[float]:
    """The numbers of ``FEATURES`` for a text."""
    raw = text.encode()
    words = raw.split()
    n_words, n_bytes = max(1, len(words)), max(1, len(raw))
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(raw, np.uint8)
    classes = _CLASS[data]
    held = np.bincount(classes, minlength=8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends + 1])
    sizes = np.diff(np.append(starts, len(raw) + 1)) - 1
    lines = raw.split(b"\n")
    worst = [0.0, 0.0, 0.0]
    if len(raw):
        for place, kinds in enumerate(((2,), (6, 7), (3,))):
            total = np.concatenate([[0], np.cumsum(np.isin(classes, kinds) if len(kinds) > 1 else classes == kinds[0])])
            within = total[starts + sizes] - total[starts]
            worst[place] = float((within / np.maximum(sizes, 20)).max())
    letters = max(1, held[1] + held[2] + held[4])
    return [
        float(np.log1p(len(words))), float(lengths.mean()) if len(words) else 0.0, len(counts) / n_words,
        (max(counts.values()) if counts else 0) / n_words, sum(map(eq, words, words[1:])) / n_words,
        float((lengths <= 3).sum()) / n_words, float((lengths >= 16).sum()) / n_words,
        held[2] / letters, held[3] / n_bytes, held[4] / n_bytes, held[5] / n_words, held[6] / n_words, held[7] / n_words,
        raw.count(b"|") / n_words, float(np.log1p(len(lines))), len(set(lines)) / len(lines),
        n_bytes / len(lines), *worst]


@dataclass
class Model:
    """Log-odds: ``start`` plus a table entry for each feature and each pair of features."""

    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.start)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, values[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_edges[a], values[:, a], side="right"),
                           np.searchsorted(self.pair_edges[b], values[:, b], side="right")]
        return total

    def scores(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(values), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Bin edges at quantiles; each distinct value gets a bin of its own where there are few."""
    distinct = np.unique(values)
    if len(distinct) > bins:
        distinct = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))
        return distinct
    return (distinct[1:] + distinct[:-1]) / 2


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Step per bin of a regression tree over ordered bins, grown best split first."""
    bounds = [(0, len(g))]
    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])

    def best(low: int, high: int) -> tuple[float, int]:
        if high - low < 2:
            return 0.0, low
        cut = np.arange(low + 1, high)
        gain = (_gain(gs[cut] - gs[low], hs[cut] - hs[low], ridge) + _gain(gs[high] - gs[cut], hs[high] - hs[cut], ridge)
                - _gain(gs[high] - gs[low], hs[high] - hs[low], ridge))
        at = int(gain.argmax())
        return float(gain[at]), int(cut[at])

    options = {bounds[0]: best(*bounds[0])}
    while len(options) < leaves:
        (low, high), (gain, cut) = max(options.items(), key=lambda x: x[1][0])
        if gain <= 0:
            break
        del options[low, high]
        options[low, cut], options[cut, high] = best(low, cut), best(cut, high)
    step = np.empty(len(g))
    for low, high in options:
        step[low:high] = (gs[high] - gs[low]) / (hs[high] - hs[low] + ridge)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The gain and steps of the best cut of both axes of a table."""
    def sums(table: np.ndarray) -> tuple[np.ndarray, ...]:
        total = np.cumsum(np.cumsum(table, 0), 1)
        low = total[:-1, :-1]
        right, below = total[:-1, -1:] - low, total[-1:, :-1] - low
        return low, right, below, total[-1, -1] - low - right - below

    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    gq, hq = sums(g), sums(h)
    gain = sum(_gain(a, b, ridge) for a, b in zip(gq, hq)) - _gain(g.sum(), h.sum(), ridge)
    row, column = np.unravel_index(int(gain.argmax()), gain.shape)
    value = [a[row, column] / (b[row, column] + ridge) for a, b in zip(gq, hq)]
    step = np.empty(g.shape)
    step[:row + 1, :column + 1], step[:row + 1, column + 1:] = value[0], value[1]
    step[row + 1:, :column + 1], step[row + 1:, column + 1:] = value[2], value[3]
    return float(gain[row, column]), step


def boost(values: np.ndarray, labels: np.ndarray, bins: int = 64, leaves: int = 4, rounds: int = 120, rate: float = 0.1,
          n_pairs: int = 6, pair_bins: int = 12, pair_rounds: int = 40, ridge: float = 2.0) -> Model:
    """Tables of single features, then of the strongest pairs, by cyclic boosting."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Model(float(np.log(share / (1 - share))))
    if labels.sum() in (0, len(labels)):
        return model
    model.edges = [_cuts(values[:, j], bins) for j in range(values.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    place = [np.searchsorted(e, values[:, j], side="right") for j, e in enumerate(model.edges)]
    total = np.full(len(labels), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for j, at in enumerate(place):
            n = len(model.tables[j])
            if n < 2:
                continue
            g, h = slopes()
            step = rate * _tree(np.bincount(at, g, n), np.bincount(at, h, n), leaves, ridge)
            model.tables[j] += step
            total += step[at]
    model.pair_edges = [_cuts(values[:, j], pair_bins) for j in range(values.shape[1])]
    coarse = [np.searchsorted(e, values[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    shape = [len(e) + 1 for e in model.pair_edges]

    def sums(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        cell, size = coarse[a] * shape[b] + coarse[b], shape[a] * shape[b]
        return (np.bincount(cell, g, size).reshape(shape[a], shape[b]), np.bincount(cell, h, size).reshape(shape[a], shape[b]))

    ranked = sorted(combinations(range(values.shape[1]), 2), key=lambda p: (-_quadrants(*sums(*p), ridge)[0], p))
    model.pairs = ranked[:n_pairs]
    model.pair_tables = [np.zeros((shape[a], shape[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            step = rate * _quadrants(*sums(a, b), ridge)[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def feature_rows(df: DataFrame, doc_id: str, text: str, extra: list[str]) -> DataFrame:
    """``doc_id``, ``extra`` and the feature array of each text."""
    rows = df.select(doc_id, text, *extra)
    schema = T.StructType([rows.schema[doc_id], *[rows.schema[c] for c in extra],
                           T.StructField("features", T.ArrayType(T.DoubleType()))])

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            yield with_columns(batch, [doc_id, *extra], {
                "features": pa.array([features(t) for t in texts_of(batch, text)], pa.list_(pa.float64()))})

    return rows.mapInArrow(computed, schema)


def fit(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        held_out: Column | None = None, fit_rows: int = FIT_ROWS) -> Model:
    """A model from at most ``fit_rows`` labelled documents for which ``held_out`` is false."""
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    if held_out is not None:
        known = known.filter(~held_out)
    chosen = (known.groupBy(doc_id).agg(F.round(F.avg(label)).cast("int").alias("_label"))
              .orderBy(F.xxhash64(doc_id), doc_id).limit(fit_rows))
    # at most fit_rows pairs of numbers
    joined = documents.select(doc_id, text).join(F.broadcast(chosen), doc_id)
    # rows that repeat an id count once
    rows = (feature_rows(joined, doc_id, text, ["_label"]).groupBy(doc_id)
            .agg(F.min("features").alias("features"), F.min("_label").alias("_label")).orderBy(doc_id).toArrow())
    values = np.array(rows.column("features").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return boost(values, np.array(rows.column("_label").to_pylist(), np.float64))


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 for each text."""
    keep, name = df.columns, free_name(df, out)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            values = np.array([features(t) for t in texts_of(batch, text)])
            yield with_columns(batch, keep, {name: pa.array(model.scores(values))})

    return df.mapInArrow(scored, schema)
