"""MinHash near-dedup by bottom-k sketches from one hash function.

Each text is the set of its hashed shingles; its sketch holds the ``SKETCH`` smallest hashes.
Texts with equal sets are folded to one representative. Inverted lists over the retained values
bring representatives together: the key of a list is two values that stand next to each other
among the ``LISTED`` smallest of a sketch. Two sets of similarity 0.75 share such a key unless
no two neighbours among the 32 smallest hashes of their union are common to both, which happens
with a probability of 3e-8; for sets of up to ``LISTED`` shingles it cannot happen.

A list is never expanded into all its pairs. Every member meets the member that has most company
in its lists, the middle of a group of near copies. The sketch of the union estimates the
similarity of the two; pairs under ``ESTIMATE`` are dropped (at similarity 0.75 an estimate falls
that low with a probability of about 1e-8), the others are compared on full sets, and the links
found give components. Members of other components then try one member of each of their lists,
chosen by hash.

What is left open are members of different components of one list. Two linked sets have so many
shingles in common that one of them is among the rarest quarter of each (rarity counted among the
open sets). Only pairs that share one of those are estimated and compared. Texts around a common
passage and copies with many edits have rarest shingles of their own, so they do not meet; no link
is lost.

Full sets are computed only for members of lists with two or more representatives. A bitmap of
fixed size tells the scan of the texts which rows those may be; when it fills up, sets are
computed that nobody asks for, and the result stays the same.

Defined results: null and empty texts have no shingles and link with nothing; texts shorter
than a shingle have one; equal sets are linked; rows that share an id share a component; a row
without an id has no component and is kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.llm.common import Steps, chunks, free_name, texts_of
from nearkin.session import materialize

SHINGLE = 5
SKETCH = 64
LISTED = 32
ESTIMATE = 0.4375
TRIALS = 1
MARKS = 4  # longs of bits, one bit for each retained value
SHARE_PERCENT = 75
FILTER_BITS = 1 << 25
WORD_MEMORY = 1_000_000
_BITMAP = 1 << 15  # bits per row of Spark's bitmap aggregate


Writer = Callable[[DataFrame, str], DataFrame]


def _mixed(x: np.ndarray, step: int) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9 + 2 * step)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Shingler:
    """Sets of hashed shingles; remembers the hashes of words."""

    def __init__(self, size: int = SHINGLE) -> None:
        self.size = size
        self.known: dict[bytes, int] = {}

    def of(self, text: str) -> np.ndarray:
        """Distinct shingle hashes of 63 bits in order."""
        words = text.encode("utf-8", "replace").lower().split()
        known = self.known
        if len(known) > WORD_MEMORY:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.size, len(hashes))
        if not width:
            return np.zeros(0, np.int64)
        last = len(hashes) - width
        joined = _mixed(hashes[:last + 1] + np.uint64(width), 0)
        for step in range(1, width):
            joined = _mixed(joined * np.uint64(3) + hashes[step:last + step + 1], 0)
        return np.unique(joined >> np.uint64(1)).astype(np.int64)


def _marks() -> list[str]:
    return [f"m{i}" for i in range(MARKS)]


def _marked(sketch: np.ndarray) -> np.ndarray:
    """The bits of the retained values."""
    bits = np.zeros(64 * MARKS, np.uint8)
    bits[sketch % (64 * MARKS)] = 1
    return np.packbits(bits).view(np.int64)


def sketches(df: DataFrame, doc_id: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """Per row: id, set size, fingerprint of the set in two numbers, sketch."""
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in ("n", "f1", "f2")],
                           T.StructField("sketch", T.ArrayType(T.LongType())), *[T.StructField(m, T.LongType()) for m in _marks()]])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle)
        for batch in chunks(batches, "text"):
            sets = [shingler.of(t) for t in texts_of(batch, "text")]
            prints = [[int(_mixed(s.astype(np.uint64), step).sum().astype(np.int64)) for s in sets] for step in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[0], pa.int64()),
                 pa.array(prints[1], pa.int64()), pa.array([s[:SKETCH] for s in sets], pa.list_(pa.int64())),
                 *map(pa.array, np.array([_marked(s[:SKETCH]) for s in sets], np.int64).T)],
                names=["id", "n", "f1", "f2", "sketch", *_marks()])

    return rows.mapInArrow(sketched, schema)


def _place(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def _bitmap(ids: DataFrame) -> DataFrame:
    """The places of ids as rows (b, m) of 4 KB, at most FILTER_BITS / 32768 of them."""
    at = _place("id")
    return ids.groupBy(F.floor(at / _BITMAP).alias("b")).agg(F.bitmap_construct_agg(at % _BITMAP).alias("m"))


def full_sets(df: DataFrame, ids: DataFrame, doc_id: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """The full sets of the rows whose ``id`` is in ``ids``, and of few others."""
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in _bitmap(ids).collect():  # of fixed size, whatever the number of ids
        start = row["b"] * (_BITMAP // 8)
        bits[start:start + _BITMAP // 8] = np.frombuffer(bytes(row["m"]), np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(bits.tobytes())
    rows = df.select(F.col(doc_id).alias("id"), _place(doc_id).alias("at"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("set", T.ArrayType(T.LongType()))])

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, wanted = Shingler(shingle), np.frombuffer(shared.value, np.uint8)
        for batch in chunks(batches, "text"):
            where = batch.column(1).to_numpy(zero_copy_only=False)
            some = batch.filter(pa.array((wanted[where >> 3] >> (where & 7).astype(np.uint8)) & 1 == 1))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array([shingler.of(t) for t in texts_of(some, "text")], pa.list_(pa.int64()))], names=["id", "set"])

    return rows.mapInArrow(computed, schema)


def components(edges: DataFrame, write: Writer = materialize) -> DataFrame:
    """Connected components of an (a, b) table: each node that has an edge, and its least node.

    Large and small stars in turn: neighbours are hung on the least neighbour until every edge
    leads from a node to the least node of its component. Each round is written, which also
    cuts the lineage; nothing is collected but a count and a checksum.
    """
    def stamp(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = write(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, now = None, stamp(current)
    while now != before and now[0]:
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = write(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                                                F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        current = write(small.select("e.*").filter("a != b").distinct(), "small-star")
        before, now = now, stamp(current)
    roots = current.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    both = pairs.join(left, "a").join(right, "b").select(
        "a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b")).cast("long").alias("sizes"))
    return both.filter(100 * F.col("common") >= SHARE_PERCENT * (F.col("sizes") - F.col("common"))).select("a", "b")


def _estimated(pairs: DataFrame, representatives: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow a link."""
    x, y = representatives.alias("x"), representatives.alias("y")
    kept = pairs.join(x, F.col("a") == F.col("x.id")).join(y, F.col("b") == F.col("y.id")).filter(
        _sizes_allow() & _marks_allow() & (_estimate() >= ESTIMATE))
    return kept.select("a", "b").distinct()


def _estimate() -> Column:
    """Similarity from the sketch of the union: up to which value both sketches are complete, what they share."""
    def end(side: str) -> Column:
        full = F.lit((1 << 63) - 1)
        return F.when(F.col(f"{side}.n") <= SKETCH, full).otherwise(F.element_at(f"{side}.sketch", -1))

    limit = F.least(end("x"), end("y"))
    shared = F.size(F.array_intersect("x.sketch", "y.sketch"))
    held = [F.size(F.filter(f"{s}.sketch", lambda v: v <= limit)) for s in ("x", "y")]
    return shared / (held[0] + held[1] - shared)


def _marks_allow() -> Column:
    """Whether enough bits are common: shared values share their bits, and few of them fall together."""
    common = sum((F.bit_count(F.col(f"x.{m}").bitwiseAND(F.col(f"y.{m}"))) for m in _marks()), F.lit(0))
    return common >= 0.34 * F.least(F.lit(SKETCH), F.greatest("x.n", "y.n")) - 1


def _sizes_allow() -> Column:
    return 100 * F.least("x.n", "y.n") >= SHARE_PERCENT * F.greatest("x.n", "y.n")


def _keys(sketch: str) -> Column:
    """Keys of the lists of a sketch: neighbours among its first values."""
    listed = F.slice(sketch, 1, LISTED)
    return F.zip_with(F.slice(listed, 1, F.size(listed) - 1), F.slice(listed, 2, F.size(listed)), lambda a, b: F.xxhash64(a, b))


def _merged(labelled: DataFrame, links: DataFrame, write: Writer) -> DataFrame:
    """``labelled`` with components joined by the links between them."""
    of = labelled.select("id", "component").distinct()
    ends = (links.join(of.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a")
            .join(of.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b"))
    new = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")), write).select(
        F.col("id").alias("component"), F.col("component").alias("new"))
    return labelled.join(new, "component", "left").withColumn("component", F.coalesce("new", "component")).drop("new")


def links(representatives: DataFrame, df: DataFrame, doc_id: str, text: str, shingle: int = SHINGLE,
          write: Writer = materialize) -> DataFrame:
    """Links (a, b) between representatives that connect what is connected."""
    # sets of one or two shingles are similar enough to equal sets alone
    postings = representatives.filter("n > 2").select("id", F.explode(_keys("sketch")).alias("key"))
    lengths = postings.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("length"))
    members = write(postings.join(lengths.filter("low < high").select("key", "length"), "key"), "members")
    # the first of a list is the member with most company in all its lists: the middle of a group of near copies
    company = members.groupBy("id").agg(F.sum("length").alias("company"))
    met = write(members.select("key", "id").distinct().join(company, "id"), "lists")
    order = F.struct(F.col("company"), -F.col("id")) if dict(met.dtypes)["id"] == "bigint" else F.struct("company", "id")
    first = met.groupBy("key").agg(F.max_by("id", order).alias("a"))
    lists = write(met.select("key", "id").join(first, "key"), "starred")
    star = write(lists.filter("id != a").select("a", F.col("id").alias("b")).distinct(), "stars")
    asked = star.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # rows that repeat an id and its set are one; an id may have several sets
    sets = write(full_sets(df, asked, doc_id, text, shingle).join(asked, "id", "left_semi")
                       .withColumn("which", F.xxhash64("set")).dropDuplicates(["id", "which"]), "sets")
    found = write(_compared(_estimated(star, representatives), sets), "star-links")
    labelled = write(lists.join(components(found, write).withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")), "labelled")
    for turn in range(TRIALS):
        # members of other components against one of the list, another one in each list
        chance = F.xxhash64("key", "id", F.lit(turn))
        trial = labelled.groupBy("key").agg(
            F.min("component").alias("c1"), F.max("component").alias("c2"), F.min_by("id", chance).alias("b"),
            F.min_by("component", chance).alias("cb")).filter("c1 < c2")
        pairs = labelled.join(trial, "key").filter("component != cb").select(F.col("id").alias("a"), "b").distinct()
        new = write(_compared(_estimated(pairs, representatives), sets), "trial-links")
        found = found.unionAll(new)
        labelled = write(_merged(labelled, new, write), "labelled")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 < c2").select("key")
    rest = labelled.join(mixed, "key").select("id", "component").distinct()
    pairs = write(_share_a_rare_shingle(sets.join(rest, "id"), write), "open-pairs")
    return found.unionAll(_compared(_estimated(pairs, representatives), sets))


def _share_a_rare_shingle(sets: DataFrame, write: Writer) -> DataFrame:
    """Pairs (a, b) of different components among whose rarest shingles one is common.

    Of a set of n shingles the first n - ceil(0.75 n) + 1 in the order of rarity count, which
    those that no other set holds use up first. The places of their first common shingle bound
    what two sets can have in common at most; pairs that fall short of a link do not meet.
    """
    shingles = write(sets.select("id", "which", "component", F.size("set").alias("n"), F.explode("set").alias("h")), "shingles")
    shared = shingles.groupBy("h").agg(F.count("*").alias("holders")).filter("holders > 1")
    own = Window.partitionBy("id", "which")  # one set
    count = F.col("n") - F.ceil(F.col("n") * SHARE_PERCENT / 100) + 1
    rare = write(
        shingles.join(shared, "h").withColumn("place", F.row_number().over(own.orderBy("holders", "h")))
        .withColumn("alone", F.col("n") - F.count("*").over(own)).withColumn("place", F.col("place") + F.col("alone")).filter(F.col("place") <= count)
        .select("h", "id", "component", "n", "place"), "rare")
    x, y = rare.alias("x"), rare.alias("y")
    most = 1 + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    met = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component"))
                 & (100 * most >= SHARE_PERCENT * (F.col("x.n") + F.col("y.n") - most)))
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: id, n_shingles, component_id and whether it is the document of its component that is kept."""
    stored = materialize(sketches(df, doc_id, text, shingle), "sketches")
    sets = stored.filter("n > 0 AND id IS NOT NULL")
    folded = materialize(sets.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep")), "folded")
    chosen = sets.join(folded.withColumnRenamed("rep", "id"), ["id", "n", "f1", "f2"], "left_semi")
    steps = Steps(df.sparkSession)
    representatives = steps.write(chosen.select("id", "n", "sketch", *_marks()), "representatives")
    edges = materialize(links(representatives, df, doc_id, text, shingle, steps.write), "links")
    steps.drop()
    members = sets.select("id", "n", "f1", "f2").join(folded, ["n", "f1", "f2"])
    # different texts under one id
    tied = members.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b").select("id", "a")
    tied = members.join(tied, "id").filter("rep != a").select("a", F.col("rep").alias("b"))
    of = components(edges.unionAll(tied)).withColumnRenamed("id", "rep")
    labelled = folded.join(of, "rep", "left").select("n", "f1", "f2", F.coalesce("component", "rep").alias("component"))
    rows = stored.select("id", "n", "f1", "f2").join(labelled, ["n", "f1", "f2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one document of each group of near copies; of rows that repeat an id one stays.

    Rows without an id stay.
    """
    found = near_duplicates(df, doc_id, text).filter(F.col(doc_id).isNotNull())
    counts = materialize(found.groupBy(F.col(doc_id).alias("id")).agg(F.min("kept").alias("kept"), F.count("*").alias("n")), "kept")
    dropped = counts.filter("NOT kept").select("id")
    # only rows that may be dropped meet the ids that are; the others, mostly all, are not shuffled
    b, m = free_name(df, "_b"), free_name(df, "_m")
    bits = _bitmap(dropped).select(F.col("b").alias(b), F.col("m").alias(m))
    at = _place(doc_id)
    byte = F.conv(F.hex(F.substring(m, (at % _BITMAP / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    marked = df.withColumn(b, F.floor(at / _BITMAP)).join(F.broadcast(bits), b, "left")
    maybe = F.col(doc_id).isNotNull() & F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    rest = marked.filter(maybe).select(*df.columns).join(dropped.withColumnRenamed("id", doc_id), doc_id, "left_anti")
    result = marked.filter(~maybe).select(*df.columns).unionByName(rest.select(*df.columns))
    if counts.filter("kept AND n > 1").limit(1).count():
        nameless = result.filter(F.col(doc_id).isNull())
        result = result.filter(F.col(doc_id).isNotNull()).dropDuplicates([doc_id]).unionByName(nameless)
    return result
