"""Ranked keyword search by range-maximum tables over posting lists.

Documents stand in shards of at most ``SHARD_DOCUMENTS`` documents and ``SHARD_POSTINGS`` postings.
Within a shard every term of the searched items has its postings by document number, with a
sparse table that names the posting of highest impact of any range in two look-ups. An interval
of documents is bounded for an item by the sum of its terms' range maxima. The search takes the
intervals with the highest bounds, a few at a time, splits each at the document of the greatest
single impact, scores that document and bounds the two rests; an interval with few postings is
scored at once. It ends when no bound reaches the item's k-th score, which is carried from shard
to shard of a task, so that most intervals are never opened.

The postings are stored once per block of items; a block holds about ``BLOCK_BYTES`` of item text,
so its terms travel to the tasks whatever the number of items. Document counts of terms and the
size of the corpus come from all documents and items by partial aggregates. The scores are whole
numbers: ``w * (1000000000 * tf div (1000 * tf + 8 * m))`` summed over the item's terms, with
``m = 25 + 75 * n * N div L`` and ``w`` the floored weight of the term.

Defined results: null and empty texts have no terms, are found by nothing and find nothing, and
do not count as documents; equal scores are ordered by id, null ids last; repeated rows are
documents and items of their own (the numbers of rows of a repeated item come from one ranking);
an empty table on either side gives no rows. Other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearkin.llm.common import Steps, chunks, texts_of
from nearkin.session import materialize

SHARD_DOCUMENTS = 4096
SHARD_POSTINGS = 1 << 20
BLOCK_BYTES = 1 << 20
LEAF_POSTINGS = 512
OPEN_ENTRIES = 1 << 16
_LAST = np.iinfo(np.int64).max

_TERM = re.compile("[0-9a-z\x80-\U0010ffff]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SHARD = "ids binary, lengths binary, terms binary, sizes binary, places binary, counts binary, n long, l long"


def terms_of(text: str) -> list[str]:
    return _TERM.findall(text.translate(_LOWER))


class ShardWriter:
    """Collects documents until a shard is full."""

    def __init__(self, numbers: dict[str, int]) -> None:
        self.numbers = numbers
        self._clear()

    def _clear(self) -> None:
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.terms: list[int] = []
        self.counts: list[int] = []
        self.places: list[int] = []
        self.n = self.l = 0

    def add(self, doc_id: int | None, text: str) -> None:
        words = terms_of(text)
        self.n += bool(words)
        self.l += len(words)
        counts = Counter(words)
        held = counts.keys() & self.numbers.keys()
        if held:
            self.places.extend([len(self.ids)] * len(held))
            self.ids.append(_LAST if doc_id is None else doc_id)
            self.lengths.append(len(words))
            self.terms.extend(map(self.numbers.__getitem__, held))
            self.counts.extend(map(counts.__getitem__, held))

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCUMENTS or len(self.terms) >= SHARD_POSTINGS

    def flush(self) -> pa.RecordBatch:
        terms, places = np.array(self.terms, np.int32), np.array(self.places, np.int32)
        order = np.lexsort((places, terms))
        distinct, sizes = np.unique(terms, return_counts=True)
        row = [np.array(self.ids, np.int64), np.array(self.lengths, np.int64), distinct.astype(np.int32), sizes.astype(np.int32),
               places[order], np.array(self.counts, np.int32)[order]]
        batch = pa.RecordBatch.from_arrays(
            [*(pa.array([a.tobytes()], pa.binary()) for a in row), pa.array([self.n], pa.int64()), pa.array([self.l], pa.int64())],
            names=["ids", "lengths", "terms", "sizes", "places", "counts", "n", "l"])
        self._clear()
        return batch


def shards(documents: DataFrame, numbers: dict[str, int], doc_id: str, text: str) -> DataFrame:
    """Postings of the numbered terms over whole texts, by shard."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ShardWriter(numbers)
        for batch in chunks(batches, "text"):
            for own, value in zip(batch.column(0).to_pylist(), texts_of(batch, "text")):
                writer.add(own, value)
                if writer.full():
                    yield writer.flush()
        if writer.n:
            yield writer.flush()

    return rows.mapInArrow(built, _SHARD)


def document_counts(stored: DataFrame) -> dict[int, int]:
    """Number of documents per term over all shards; as many rows as the block has terms."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(batch.column(c)[i].as_py(), np.int32)) for c in (0, 1)], names=["term", "df"])

    rows = stored.select("terms", "sizes").mapInArrow(counted, "term int, df int").groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in rows.collect()}


class Best:
    """The ``k`` best documents of an item so far."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        reach = scores >= self.floor()
        if not reach.any():
            return
        scores, ids = np.concatenate([self.scores, scores[reach]]), np.concatenate([self.ids, ids[reach]])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


class Shard:
    """Posting lists of a shard one after another, and the sparse table of their impacts.

    ``level[j][p]`` is the posting of highest impact among the ``2**j`` from ``p`` on; ranges that are
    asked for never leave a list.
    """

    def __init__(self, row: dict, total_n: int, total_l: int) -> None:
        self.ids = np.frombuffer(row["ids"], np.int64)
        terms, sizes = np.frombuffer(row["terms"], np.int32), np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        self.places = np.frombuffer(row["places"], np.int32).astype(np.int64)
        ends = np.cumsum(sizes)
        self.span = {t: (e - s, e) for t, s, e in zip(terms.tolist(), sizes.tolist(), ends.tolist())}
        # sorted over all lists, so that one search finds a document in several lists
        self.keys = np.repeat(np.arange(len(terms)), sizes) * len(self.ids) + self.places
        self.list_of = {t: i for i, t in enumerate(terms.tolist())}
        counts = np.frombuffer(row["counts"], np.int32).astype(np.int64)
        m = 25 + 75 * np.frombuffer(row["lengths"], np.int64) * total_n // max(total_l, 1)
        self.impact = (1_000_000_000 * counts // (1000 * counts + 8 * m[self.places])).astype(np.int32)
        self.level = [np.arange(len(self.impact), dtype=np.int32)]
        width = 1
        while 2 * width <= sizes.max(initial=0):
            left = self.level[-1]
            right = np.concatenate([left[width:], left[-1:].repeat(width)])
            self.level.append(np.where(self.impact[left] >= self.impact[right], left, right))
            width *= 2
        self.table = np.stack(self.level) if len(self.impact) else np.zeros((1, 0), np.int32)
        self.log = np.zeros(int(sizes.max(initial=0)) + 2, np.int64)
        for i in range(2, len(self.log)):
            self.log[i] = self.log[i >> 1] + 1

    def highest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Impact and posting of the range maxima; 0 for empty ranges."""
        some = high > low
        j = self.log[np.where(some, high - low, 1)]
        first = self.table[j, np.where(some, low, 0)]
        second = self.table[j, np.where(some, high - (1 << j), 0)]
        at = np.where(self.impact[first] >= self.impact[second], first, second)
        return np.where(some, self.impact[at], 0), at


@dataclass
class Work:
    """What a search has done: documents scored by splits and by leaves, intervals left closed."""

    splits: int = 0
    leaves: int = 0
    closed: int = 0


def search_shard(shard: Shard, terms: dict[int, int], best: Best, work: Work | None = None) -> None:
    """Offer the documents of a shard to an item; ``terms`` are its terms and their weights, repeats included."""
    work = work if work is not None else Work()
    held = [t for t in terms if t in shard.span and terms[t] > 0]
    if not held:
        return
    weight = np.array([terms[t] for t in held], np.int64)
    base = np.array([shard.list_of[t] for t in held], np.int64) * len(shard.ids)
    low = np.array([[shard.span[t][0] for t in held]], np.int64)
    high = np.array([[shard.span[t][1] for t in held]], np.int64)
    impact, at = shard.highest(low, high)
    bound = impact.astype(np.int64) @ weight
    few = max(LEAF_POSTINGS, 4 * len(held))
    together = max(1, OPEN_ENTRIES // len(held))
    while True:
        open_ = bound >= best.floor()
        work.closed += int((~open_).sum())
        if not open_.any():
            return
        low, high, bound, impact, at = low[open_], high[open_], bound[open_], impact[open_], at[open_]
        # the first step opens one interval, later steps the highest of those that are left
        chosen = np.argsort(-bound, kind="stable")[:together]
        rest = np.ones(len(bound), bool)
        rest[chosen] = False
        small = (high[chosen] - low[chosen]).sum(1) <= few
        leaves, inner = chosen[small], chosen[~small]
        if len(leaves):
            starts, sizes = low[leaves].ravel(), (high[leaves] - low[leaves]).ravel()
            before = np.cumsum(sizes) - sizes
            postings = np.repeat(starts - before, sizes) + np.arange(sizes.sum())
            part = shard.impact[postings].astype(np.int64) * np.repeat(np.tile(weight, len(leaves)), sizes)
            documents, place = np.unique(shard.places[postings], return_inverse=True)
            scores = np.zeros(len(documents), np.int64)
            np.add.at(scores, place, part)
            work.leaves += len(documents)
            best.offer(scores, shard.ids[documents])
        if len(inner):
            top = (impact[inner] * weight).argmax(1)
            split = shard.places[at[inner, top]]
            found = np.searchsorted(shard.keys, base[None, :] + split[:, None])
            found = np.clip(found, low[inner], high[inner])
            inside = found < high[inner]
            held_there = inside & (shard.places[np.where(inside, found, 0)] == split[:, None])
            scores = np.where(held_there, shard.impact[np.where(inside, found, 0)], 0).astype(np.int64) @ weight
            work.splits += len(inner)
            best.offer(scores, shard.ids[split])
            new_low = np.concatenate([low[inner], found + held_there])
            new_high = np.concatenate([found, high[inner]])
            new_impact, new_at = shard.highest(new_low, new_high)
            low, high = np.concatenate([low[rest], new_low]), np.concatenate([high[rest], new_high])
            impact, at = np.concatenate([impact[rest], new_impact]), np.concatenate([at[rest], new_at])
            bound = impact.astype(np.int64) @ weight
        else:
            low, high, bound, impact, at = low[rest], high[rest], bound[rest], impact[rest], at[rest]


def _blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """Numbered items that have a text, and the number of blocks they are dealt to."""
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    return items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), blocks


def weight(n: int, df: int) -> int:
    """Whole-number weight of a term that ``df`` of ``n`` documents hold."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def rank(documents: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: item, rank, document, score."""
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    numbered, blocks = _blocks(asked)
    kind = asked.schema["item_id"].dataType.simpleString()
    results = []
    for block in range(blocks):
        # about BLOCK_BYTES of text
        some = [(r["item_id"], Counter(terms_of(r["text"] or "")), r["times"]) for r in
                numbered.filter(F.col("block") == block).groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("times")).collect()]
        some = [s for s in some if s[1]]
        numbers = {t: i for i, t in enumerate(sorted(set().union(*(s[1] for s in some))))}
        if numbers:
            results.append(_rank_block(documents, some, numbers, k, doc_id, text, kind, block))
    if not results:
        return documents.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, results)


def _rank_block(documents: DataFrame, some: list[tuple], numbers: dict[str, int], k: int, doc_id: str, text: str,
                kind: str, block: int) -> DataFrame:
    spark = documents.sparkSession
    steps = Steps(spark)
    stored = steps.write(shards(documents, numbers, doc_id, text), "postings")
    total = stored.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("l"), F.lit(0))).first()
    total_n, total_l = int(total[0]), int(total[1])
    weights = {t: weight(total_n, df) for t, df in document_counts(stored).items()}
    queries = [{numbers[t]: c * weights[numbers[t]] for t, c in counts.items() if numbers[t] in weights} for _, counts, _ in some]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}, total_n, total_l)
                for own, terms in zip(best, queries):
                    search_shard(shard, terms, own)
        sizes = [len(b.ids) for b in best]
        ids = np.concatenate([b.ids for b in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best), dtype=np.int32), sizes)), pa.array(ids, mask=ids == _LAST),
             pa.array(np.concatenate([b.scores for b in best]))], names=["item", "doc_id", "score"])

    found = stored.select("ids", "lengths", "terms", "sizes", "places", "counts").mapInArrow(searched, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = materialize(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), f"ranked-{block}")
    steps.drop()
    # as many rows as the block has items
    names = spark.createDataFrame([(i, s[0], s[2]) for i, s in enumerate(some)], f"item int, item_id {kind}, times long")
    return (ranked.join(F.broadcast(names), "item").withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times"))))
            .select("item_id", "rank", "doc_id", "score"))
