"""Benchmark decontamination by an FM-index per shard of training text.

A shard is a slice of a partition holding a few megabytes of text. Its words become symbols:
words of the benchmark get numbers, every other word and every end of a document is a break.
No window spans a break, so stretches between breaks that are shorter than the shortest window
are left out. Over what remains stand a suffix order (prefix doubling), its Burrows-Wheeler
transform in a wavelet matrix, and a sample of the suffix positions. All windows are searched
backward at once, each step being two rank queries; occurrences are located by walking left
until a sampled position, and the words they cover merge into removal spans.

Documents are read once and never shuffled. The benchmark travels as a broadcast of at most
``BLOCK_BYTES`` of text; a larger one is cut into blocks, one pass each, whose spans add up.

Defined results: a null or empty text has no words and no spans; a null item id is written as
the empty text; items without words match nothing; items that share an id count once; repeated
rows and copies give repeated results; an empty table of items leaves every document clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.llm.common import chunks, free_name, texts_of, with_columns
from nearkin.session import materialize

WINDOW = 10
BLOCK_BYTES = 16 << 20
SAMPLE_EVERY = 16
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))
WORD = re.compile(rb"[^ ]+")


def words_of(text: str) -> list[bytes]:
    """Lower-cased words: digits, ASCII letters and everything beyond ASCII."""
    return text.encode().translate(FOLD).split()


class Phrases(NamedTuple):
    """Windows of a block of items as rows of word numbers, right-aligned."""

    number_of: dict[bytes, int]  # words from 1; 0 is a break
    windows: np.ndarray  # shape (windows, longest), padded with 0 on the left
    lengths: np.ndarray
    item_starts: np.ndarray  # items of window w: items[item_starts[w]:item_starts[w + 1]]
    items: np.ndarray


def phrases_of(items: list[tuple[str, str]], window: int) -> Phrases:
    number_of: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], dict[str, None]] = {}
    for item, text in items:
        numbers = [number_of.setdefault(w, len(number_of) + 1) for w in words_of(text)]
        for start in range(max(1, len(numbers) - window + 1) if numbers else 0):
            owners.setdefault(tuple(numbers[start:start + window]), {})[item] = None
    windows = np.zeros((len(owners), window), np.int64)
    for row, numbers in zip(windows, owners):
        row[window - len(numbers):] = numbers
    return Phrases(
        number_of, windows, np.array([len(x) for x in owners], np.int64),
        np.cumsum([0, *(len(x) for x in owners.values())]), np.array([i for x in owners.values() for i in x], object))


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text``; each 0 is smaller than the next 0 and than all else.

    Prefix doubling: after each round suffixes are ranked by twice as many symbols.
    """
    breaks = text == 0
    rank = text + int(breaks.sum())
    rank[breaks] = np.arange(int(breaks.sum()))
    n, width = len(text), 1
    while True:
        further = np.zeros(n, np.int64)
        further[:-width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + further
        order = np.argsort(key, kind="stable")
        changed = np.empty(n, np.int64)
        changed[0] = 0
        changed[1:] = key[order[1:]] != key[order[:-1]]
        ranks = np.cumsum(changed)
        rank = np.empty(n, np.int64)
        rank[order] = ranks
        width *= 2
        if ranks[-1] == n - 1 or width >= n:
            return order


class WaveletMatrix:
    """Rank queries over a sequence of numbers, one bit level after another."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.bits = max(1, int(symbols - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        self.ones_from: list[int] = []
        for level in range(self.bits):
            bit = (sequence >> (self.bits - 1 - level)) & 1
            before = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(1 - bit, out=before[1:])
            self.zeros.append(before)
            self.ones_from.append(int(before[-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        first = self._down(np.arange(symbols), np.zeros(symbols, np.int64))
        self.first = first

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.bits):
            zeros = self.zeros[level][at]
            one = (symbol >> (self.bits - 1 - level)) & 1
            at = np.where(one, self.ones_from[level] + at - zeros, zeros)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``at``."""
        return self._down(symbol, at) - self.first[symbol]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at ``at`` and how often each stands before there."""
        symbol = np.zeros(len(at), np.int64)
        for level in range(self.bits):
            zeros = self.zeros[level][at]
            one = self.zeros[level][at + 1] == zeros
            symbol = symbol << 1 | one
            at = np.where(one, self.ones_from[level] + at - zeros, zeros)
        return symbol, at - self.first[symbol]


class FMIndex:
    """Index of a sequence of numbers in which 0 is a break and stands last."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        order = suffix_order(text)
        self.size = len(text)
        self.matrix = WaveletMatrix(text[order - 1], symbols)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        # a walk to the left never crosses a break: what follows one is sampled too
        sampled = (order % SAMPLE_EVERY == 0) | (text[order - 1] == 0)
        self.sampled = sampled
        self.slot = np.cumsum(sampled) - 1
        self.positions = order[sampled]

    def find(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffix order between which the suffixes starting with each window stand."""
        low = np.zeros(len(windows), np.int64)
        high = np.full(len(windows), self.size, np.int64)
        live = np.arange(len(windows))
        for step in range(1, windows.shape[1] + 1):
            live = live[(lengths[live] >= step) & (low[live] < high[live])]
            symbol = windows[live, -step]
            low[live] = self.below[symbol] + self.matrix.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.matrix.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix order."""
        found = np.zeros(len(rows), np.int64)
        at, left, steps = rows.copy(), np.arange(len(rows)), 0
        while len(left):
            done = self.sampled[at]
            found[left[done]] = self.positions[self.slot[at[done]]] + steps
            at, left = at[~done], left[~done]
            symbol, before = self.matrix.read(at)
            at = self.below[symbol] + before
            steps += 1
        return found


class Found(NamedTuple):
    """Per document of a shard: words, covered stretches of words, items that occur."""

    n_words: list[int]
    spans: list[list[tuple[int, int]]]
    items: list[list[str]]


def search(texts: list[str], phrases: Phrases) -> Found:
    """Occurrences of all windows in the texts of one shard."""
    number = phrases.number_of.get
    parts, n_words = [], []
    for text in texts:
        words = words_of(text)
        n_words.append(len(words))
        parts.append(np.fromiter(map(number, words, repeat(0)), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))
    found = Found(n_words, [[] for _ in texts], [[] for _ in texts])
    if not texts or not len(phrases.windows):
        return found
    symbols = np.concatenate(parts)
    ends = np.cumsum(np.array(n_words, np.int64) + 1)
    # stretches between breaks, long enough for the shortest window, each with the break behind it
    breaks = np.flatnonzero(symbols == 0)
    lengths = np.diff(breaks, prepend=-1) - 1
    keep = lengths >= phrases.lengths.min()
    if not keep.any():
        return found
    counts = lengths[keep] + 1
    starts = breaks[keep] - lengths[keep]
    origin = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    index = FMIndex(symbols[origin], len(phrases.number_of) + 1)
    low, high = index.find(phrases.windows, phrases.lengths)
    times = high - low
    window = np.repeat(np.arange(len(times)), times)
    if not len(window):
        return found
    rows = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(len(window))
    at = origin[index.locate(rows)]
    cover = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[window], -1)
    hit = np.concatenate([[False], np.cumsum(cover) > 0, [False]])
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    document_starts = ends - np.array(n_words, np.int64) - 1
    for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
        document = int(np.searchsorted(ends, start, side="right"))
        offset = int(document_starts[document])
        found.spans[document].append((start - offset, stop - offset))
    pairs = np.unique(np.searchsorted(ends, at, side="right") * len(times) + window)
    items: dict[int, set[str]] = {}
    for document, w in zip((pairs // len(times)).tolist(), (pairs % len(times)).tolist()):
        items.setdefault(document, set()).update(phrases.items[phrases.item_starts[w]:phrases.item_starts[w + 1]])
    for document, some in items.items():
        found.items[document] = sorted(some)
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap made one."""
    result: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if result and start <= result[-1][1]:
            result[-1] = (result[-1][0], max(stop, result[-1][1]))
        else:
            result.append((start, stop))
    return result


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[bool, list[tuple[str, str]]]]:
    """The items in lists of about ``BLOCK_BYTES`` of text each, and whether a list is the last."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")).filter(
        F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // BLOCK_BYTES) or 1
    for block in range(count):
        some = rows if count == 1 else rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block)
        yield block == count - 1, [(r["item"], r["text"]) for r in some.collect()]


def _column(kind: str) -> T.DataType:
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    return {"words": T.LongType(), "spans": T.ArrayType(span), "items": T.ArrayType(T.StringType())}[kind]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its number of words, the covered spans of word positions and the ids of occurring items.

    The second value names the three new columns, under ``words``, ``spans`` and ``items``.
    """
    return _passes(df, items, text, item_id, item_text, window, cut=False)


def remove(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
           window: int = WINDOW) -> DataFrame:
    """``df`` with the covered spans cut out of its texts; clean texts stay as they are."""
    return _passes(df, items, text, item_id, item_text, window, cut=True)[0]


def _passes(df: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, window: int,
            cut: bool) -> tuple[DataFrame, dict[str, str]]:
    """One pass per block of items; the last one also cuts the texts if they are to be cut."""
    columns = df.columns
    names = {kind: free_name(df, kind) for kind in ("words", "spans", "items")}
    schema = T.StructType([*df.schema.fields, *[T.StructField(names[k], _column(k)) for k in names]])
    result = None
    for last, block in _blocks(items, item_id, item_text):
        shared = df.sparkSession.sparkContext.broadcast(phrases_of(block, window))
        first, cuts = result is None, cut and last

        def searched(batches: Iterator[pa.RecordBatch], shared=shared, first=first, cuts=cuts) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, text):
                found = search(texts_of(batch, text), shared.value)
                spans, ids = found.spans, found.items
                if not first:
                    earlier = [batch.column(batch.schema.get_field_index(names[k])).to_pylist() for k in ("spans", "items")]
                    spans = [merged([*[(s["start"], s["end"]) for s in a], *b]) for a, b in zip(earlier[0], spans)]
                    ids = [sorted({*a, *b}) for a, b in zip(earlier[1], ids)]
                if cuts:
                    column = batch.column(batch.schema.get_field_index(text))
                    texts = [without_spans(t, some) if some else t for t, some in zip(column.to_pylist(), spans)]
                    yield batch.select(columns).set_column(columns.index(text), text, pa.array(texts, column.type))
                    continue
                yield with_columns(batch, columns, {
                    names["words"]: pa.array(found.n_words, pa.int64()),
                    names["spans"]: pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPANS),
                    names["items"]: pa.array(ids, pa.list_(pa.string()))})

        result = (df if first else materialize(result, "spans")).mapInArrow(searched, df.schema if cuts else schema)
    return result, names


def span_words(spans: str) -> Column:
    """Number of words that the spans cover."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def digests(df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Words, hit words, occurring items and their digest, per row."""
    found, names = find(df.select(doc_id, text), items, text)
    return found.select(
        doc_id, F.col(names["words"]).alias("n_words"), span_words(names["spans"]).alias("n_hit"),
        F.size(names["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(names["items"])), 256).alias("items_sha256"),
        (F.size(names["spans"]) > 0).alias("contaminated"))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given spans of words; what stands between the words goes with them."""
    if not spans:
        return text
    raw = text.encode()
    bounds = [m.span() for m in WORD.finditer(raw.translate(FOLD))]
    parts, at = [], 0
    for start, stop in spans:
        parts.append(raw[at:bounds[start][0]])
        at = bounds[stop - 1][1]
    return b"".join([*parts, raw[at:]]).decode()
