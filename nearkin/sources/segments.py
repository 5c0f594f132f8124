"""A keyword index that grows by immutable segments.

Each batch of rows becomes a segment with its own postings, ids and lengths; nothing written is
changed. A batch that replaces or deletes ids of older segments writes them to a table of dead
rows, which a search leaves out. A state lists the segments, their numbers of live rows and
tokens, and the tables of dead rows; it lies in ``state=N/manifest`` and counts once it is complete,
so a batch or a merge becomes visible at once or not at all. Small neighbouring segments are
merged when there are ``FAN`` of about one size, and a segment of mostly dead rows is
written anew, so a corpus has a number of segments that grows with the logarithm of its rows.

Document frequencies are those of the live postings of the searched terms, summed over the
segments at search time; together with the live totals the scores are those of an index built
anew. One writer at a time.

Defined results: rows without id are left out; a null text deletes its id; of the rows of one id in a batch the
greatest text stays, before null; a batch that was already taken in changes nothing; an empty
batch is recorded; a missing folder is an empty index.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.operators import bm25
from nearkin.session import materialize, remove_table
from nearkin.sources.versions import children, complete_parts, numbers_of

# Segments of about one size that are merged, and the batch number of the rows an index starts with.
FAN = 4
BASE_BATCH = -1
_STATE = "name string, kind string, batch long, written long, n long, tokens long"
_POSTINGS = "term string, question_id long, tf int, doc_len int, bucket int"
_IDS = "question_id long, doc_len int"
_DEAD = "segment string, question_id long, doc_len int"


@dataclass(frozen=True)
class Segment:
    """``written`` rows, of which ``n`` with ``tokens`` are live; ``batch`` is the last one taken in."""

    name: str
    batch: int
    written: int
    n: int
    tokens: int


@dataclass(frozen=True)
class State:
    segments: tuple[Segment, ...] = ()
    dead: tuple[str, ...] = ()

    def batch(self) -> int | None:
        return max((s.batch for s in self.segments), default=None)


def read_state(spark: SparkSession, root: str, number: int | None = None) -> State:
    """The newest complete state, or one of a given number. It has a few rows for any corpus."""
    complete = complete_parts(spark, root, "state")
    if not complete:
        return State()
    rows = spark.read.schema(_STATE).parquet(f"{root}/state={number or complete[-1]}/manifest").collect()
    return State(
        tuple(sorted((Segment(r["name"], r["batch"], r["written"], r["n"], r["tokens"]) for r in rows if r["kind"] == "segment"),
                     key=lambda s: (s.batch, s.name))),
        tuple(sorted(r["name"] for r in rows if r["kind"] == "dead")))


def _write_state(spark: SparkSession, root: str, state: State) -> None:
    number = max(numbers_of(spark, root, "state"), default=0) + 1
    rows = [(s.name, "segment", s.batch, s.written, s.n, s.tokens) for s in state.segments] + [(d, "dead", 0, 0, 0, 0) for d in state.dead]
    spark.createDataFrame(rows, _STATE).coalesce(1).write.parquet(f"{root}/state={number}/manifest")


def _write_segment(postings: DataFrame, ids: DataFrame, root: str, batch: int) -> Segment:
    """Postings in order of bucket and hash of the term, ids in order: a search and a lookup skip what their filters exclude.

    Segments are often small, so a bucket is a column of sorted files and no folder of its own. Bucket and hash
    are one number, which sorts without comparing terms.
    """
    name = uuid.uuid4().hex
    # the upper 8 bits hold the bucket, below the sign; not a column, so that it does not move with the rows
    place = F.shiftleft(F.col("bucket").cast("long"), 55).bitwiseOR(F.shiftrightunsigned(F.xxhash64("term"), 9))
    placed = postings.withColumn("bucket", bm25.bucket_of(F.col("term"))).repartitionByRange(place, "question_id").sortWithinPartitions(place)
    placed.write.parquet(f"{root}/segments/{name}/postings")
    ids.repartitionByRange("question_id").sortWithinPartitions("question_id").write.parquet(f"{root}/segments/{name}/ids")
    size = _ids(ids.sparkSession, root, name).agg(F.count("*").alias("n"), F.coalesce(F.sum("doc_len"), F.lit(0)).alias("tokens")).first()
    return Segment(name, batch, size["n"], size["n"], size["tokens"])


def _ids(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(_IDS).parquet(f"{root}/segments/{name}/ids")


def _dead(spark: SparkSession, root: str, state: State, segments: Iterable[Segment] | None = None) -> DataFrame:
    """Dead rows of some segments, by default of all that are live."""
    names = [s.name for s in (state.segments if segments is None else segments)]
    tables = [spark.read.schema(_DEAD).parquet(f"{root}/dead/{d}") for d in state.dead]
    rows = reduce(DataFrame.unionByName, tables) if tables else spark.createDataFrame([], _DEAD)
    return rows.filter(F.col("segment").isin(names)) if names else rows.limit(0)


def _live(spark: SparkSession, root: str, state: State, segments: Iterable[Segment], table: str, schema: str) -> DataFrame:
    """Rows of the segments without their dead ones. Only segments with dead rows are joined with them."""
    parts = []
    for s in segments:
        rows = spark.read.schema(schema).parquet(f"{root}/segments/{s.name}/{table}")
        if s.n < s.written:
            rows = rows.join(_dead(spark, root, state, [s]).select("question_id"), "question_id", "left_anti").select(*rows.columns)
        parts.append(rows)
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def append(batch: DataFrame, batch_id: int, root: str, tokenizer: bm25.Tokenizer = bm25.bm25_tokens) -> bool:
    """Take in ``batch(question_id, question_text)``; False if its number, or a later one, already was."""
    spark = batch.sparkSession
    state = read_state(spark, root)
    if state.segments and state.batch() >= batch_id:
        return False
    one = batch.filter(F.col("question_id").isNotNull()).groupBy(F.col("question_id").cast("long").alias("question_id")).agg(
        F.max("question_text").alias("question_text"))
    counted = materialize(_with_gone(one, tokenizer), "segment-documents")
    kept = counted.filter("NOT gone")
    segment = _write_segment(bm25.postings_of(kept), kept.select("question_id", "doc_len"), root, batch_id)

    # ids of a batch lie in a range; ordered ids let the scan skip what is outside
    span = counted.agg(F.min("question_id").alias("low"), F.max("question_id").alias("high")).first()
    older, dead = list(state.segments), list(state.dead)
    if older and span["low"] is not None:
        stored = reduce(DataFrame.unionByName, [
            _ids(spark, root, s.name).filter(F.col("question_id").between(span["low"], span["high"])).withColumn("segment", F.lit(s.name))
            for s in older])
        name = uuid.uuid4().hex
        hit = stored.join(counted.select("question_id"), "question_id", "left_semi").join(
            _dead(spark, root, state).select("segment", "question_id"), ["segment", "question_id"], "left_anti")
        hit.select("segment", "question_id", "doc_len").write.parquet(f"{root}/dead/{name}")
        # one row per segment
        lost = {r["segment"]: r for r in spark.read.schema(_DEAD).parquet(f"{root}/dead/{name}").groupBy("segment").agg(
            F.count("*").alias("n"), F.sum("doc_len").alias("tokens")).collect()}
        if lost:
            dead.append(name)
            older = [replace(s, n=s.n - lost[s.name]["n"], tokens=s.tokens - lost[s.name]["tokens"]) if s.name in lost else s for s in older]
    _write_state(spark, root, State((*older, segment), tuple(dead)))
    remove_table(counted)
    return True


def _with_gone(rows: DataFrame, tokenizer: bm25.Tokenizer) -> DataFrame:
    """Counted documents with a mark for those whose text is null."""
    counted = bm25.counted_documents(rows.filter(F.col("question_text").isNotNull()), tokenizer=tokenizer).withColumn("gone", F.lit(False))
    gone = rows.filter(F.col("question_text").isNull()).select("question_id", F.lit(0).alias("doc_len"), F.lit(True).alias("gone"))
    return counted.unionByName(gone, allowMissingColumns=True)


def due(state: State) -> list[Segment]:
    """Segments to write as one: the newest ones of a size and below it once there are ``FAN``, or one of mostly dead rows."""
    tiers = [int(math.log(max(s.n, 1), FAN)) for s in state.segments]
    for tier in sorted(set(tiers)):
        start = len(tiers)
        while start and tiers[start - 1] <= tier:
            start -= 1
        if len(tiers) - start >= FAN:
            return list(state.segments[start:])
    return [s for s in state.segments if s.written > 2 * s.n][:1]


def merge(spark: SparkSession, root: str, chosen: list[Segment]) -> None:
    """Write the live rows of some segments as one segment; dead rows of the others go to one table."""
    state = read_state(spark, root)
    names = {s.name for s in chosen}
    rest = [s for s in state.segments if s.name not in names]
    merged = _write_segment(
        _live(spark, root, state, chosen, "postings", _POSTINGS).drop("bucket"), _live(spark, root, state, chosen, "ids", _IDS),
        root, max(s.batch for s in chosen))
    dead: tuple[str, ...] = ()
    if any(s.n < s.written for s in rest):
        dead = (uuid.uuid4().hex,)
        _dead(spark, root, state, rest).write.parquet(f"{root}/dead/{dead[0]}")
    _write_state(spark, root, State((*rest, merged), dead))


def merge_due(spark: SparkSession, root: str) -> int:
    """Merge until nothing is due; number of merges."""
    merges = 0
    while chosen := due(read_state(spark, root)):
        merge(spark, root, chosen)
        merges += 1
    return merges


def remove_unused(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the segments, dead rows and states that the newest ``keep`` states do not name; their names.

    Searches that began on an older state must have ended, and no batch may be under way.
    """
    complete = complete_parts(spark, root, "state")[-keep:]
    states = [read_state(spark, root, n) for n in complete]
    used = {s.name for st in states for s in st.segments} | {d for st in states for d in st.dead}
    unused = [f"{kind}/{name}" for kind in ("segments", "dead") for name in children(spark, f"{root}/{kind}") if name not in used]
    unused += [f"state={n}" for n in numbers_of(spark, root, "state") if complete and n < complete[0]]
    for name in unused:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return unused


def load(spark: SparkSession, root: str, tokenizer: bm25.Tokenizer = bm25.bm25_tokens) -> bm25.Bm25Index:
    """The live rows of all segments as one index for ``bm25.search``."""
    state = read_state(spark, root)
    postings = _live(spark, root, state, state.segments, "postings", _POSTINGS)
    n, tokens = sum(s.n for s in state.segments), sum(s.tokens for s in state.segments)
    stats = spark.createDataFrame([(n, tokens / n if n else 0.0, bm25.TERM_BUCKETS)], "n long, avgdl double, buckets int")
    return bm25.Bm25Index(postings, postings.groupBy("bucket", "term").agg(F.count("*").alias("df")), stats, tokenizer)
