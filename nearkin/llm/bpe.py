"""Byte-level BPE: a rank queue over linked lists encodes, the byte table of the ids decodes.

The bytes of all pre-tokens that are to be merged stand in one linked list, with a break after
each pre-token. Each adjacent pair whose concatenation has a rank waits in the bucket of that
rank. A hierarchy of bitmaps tells by find-first-set which bucket is next. A bucket's positions
are merged from left to right; entries whose pair is gone are skipped as stale. Every merge
costs constant time, so a pre-token of a megabyte takes no longer per byte than a short one,
and pre-tokens never influence one another because no pair spans a break.

Pre-tokens are merged together up to ``MERGED_BYTES`` at a time. Ids of pre-tokens seen before come
from a memory of two generations, each bounded by bytes: when the younger is full, it becomes the
older one, which is forgotten. It changes no result. A Python worker builds one codec and keeps it.

Defined results: a null text is empty; the empty text has no ids and decodes to no bytes. Rows
are independent: repeated rows give repeated results and an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from nearkin.llm.common import chunks, free_name, texts_of, with_columns

MEMORY_BYTES = 48 << 20  # of either generation, estimated
ENTRY_BYTES = 180
MERGED_BYTES = 1 << 16
SLICE_BYTES = 1 << 20
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]*")


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: lines of base64 and rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class RankQueue:
    """A set of ranks below ``size`` whose least member is found in three steps.

    Level 0 has a bit per rank, each bit of a higher level tells whether a word below is not
    empty. Buckets are unordered until they are taken.
    """

    def __init__(self, size: int) -> None:
        self.low = [0] * ((size >> 6) + 1)
        self.mid = [0] * ((size >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, positions: list[int]) -> None:
        self.buckets[rank] = positions
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def least(self) -> int:
        """The least rank that has a bucket, or -1."""
        if not self.top:
            return -1
        high = (self.top & -self.top).bit_length() - 1
        word = self.mid[high]
        at = high << 6 | (word & -word).bit_length() - 1
        word = self.low[at]
        return at << 6 | (word & -word).bit_length() - 1

    def drop(self, rank: int) -> None:
        del self.buckets[rank]
        self.low[rank >> 6] &= ~(1 << (rank & 63))
        if not self.low[rank >> 6]:
            self.mid[rank >> 12] &= ~(1 << (rank >> 6 & 63))
            if not self.mid[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))


class Codec:
    """Encoder and decoder of one vocabulary and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.split = regex.compile(pattern).findall
        # Without letters and numbers beyond Latin and ASCII digits both engines agree, and the
        # standard one is faster.
        self.plain_split = re.compile(
            pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")).findall
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.byte_rank = [ranks[bytes([b])] for b in range(256)]
        self.whole = ranks
        self.size = max(ranks.values()) + 1
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        # to the right (left) of an id: the other id of the pair -> rank of the merge
        self.rights: dict[int, dict[int, int]] = {}
        self.lefts: dict[int, dict[int, int]] = {}
        # ids with a pair of a lower rank than their own: after such a merge another rank may be next
        self.early: set[int] = set()
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.rights.setdefault(left, {})[right] = rank
                    self.lefts.setdefault(right, {})[left] = rank
                    if left > rank:
                        self.early.add(left)
                    if right > rank:
                        self.early.add(right)
        self.byte_pair = np.full((257, 257), -1, np.int64)  # 256 stands for a break
        for a in range(256):
            found = self.rights.get(self.byte_rank[a], {})
            for b in range(256):
                self.byte_pair[a, b] = found.get(self.byte_rank[b], -1)

    def pieces(self, text: str) -> list[str]:
        return self.plain_split(text) if PLAIN.fullmatch(text) else self.split(text)

    def merge(self, parts: list[bytes]) -> list[list[int]]:
        """Ids of each byte string, merged together in one list with breaks."""
        lengths = np.array([len(p) for p in parts], np.int64)
        starts = np.cumsum(lengths + 1) - lengths  # after the break before each part
        count = int(lengths.sum()) + len(parts) + 1
        symbols = np.full(count, 256, np.int64)
        inside = np.ones(count, bool)
        inside[0] = False
        inside[starts + lengths] = False
        symbols[inside] = np.frombuffer(b"".join(parts), np.uint8)
        pairs = np.full(count, -1, np.int64)
        pairs[:-1] = self.byte_pair[symbols[:-1], symbols[1:]]
        order = np.argsort(pairs, kind="stable")
        order = order[np.searchsorted(pairs[order], 0):]
        ranks, firsts = np.unique(pairs[order], return_index=True)
        queue = RankQueue(self.size)
        for rank, positions in zip(ranks.tolist(), np.split(order, firsts[1:])):
            queue.open(rank, positions.tolist())
        ids = np.array([*self.byte_rank, -1])[symbols].tolist()
        pair = pairs.tolist()  # rank of the pair that starts at a position, -1 for none
        following = list(range(1, count + 1))
        previous = list(range(-1, count - 1))
        buckets, opened, none = queue.buckets, queue.open, {}
        resumed: dict[int, int] = {}
        while (rank := queue.least()) >= 0:
            bucket = buckets[rank]
            early = rank in self.early
            if resumed.pop(rank, -1) != len(bucket):
                bucket.sort(reverse=True)
            right_of, left_of = self.rights.get(rank, none), self.lefts.get(rank, none)
            lower = False
            while bucket:
                at = bucket.pop()
                if pair[at] != rank:
                    continue  # stale
                after = following[at]
                beyond = following[after]
                ids[at] = rank
                pair[after] = -1
                following[at] = beyond
                previous[beyond] = at
                new = right_of.get(ids[beyond], -1)
                pair[at] = new
                if new >= 0:
                    if new in buckets:
                        buckets[new].append(at)
                    else:
                        opened(new, [at])
                    lower = new < rank
                before = previous[at]
                new = left_of.get(ids[before], -1)
                pair[before] = new
                if new >= 0:
                    if new in buckets:
                        buckets[new].append(before)
                    else:
                        opened(new, [before])
                    lower = lower or new < rank
                if early and lower:
                    resumed[rank] = len(bucket)  # still in order unless something comes in
                    break
            if not bucket:
                queue.drop(rank)
                resumed.pop(rank, None)
        result: list[list[int]] = []
        for at in starts.tolist():
            merged = []
            while ids[at] >= 0:
                merged.append(ids[at])
                at = following[at]
            result.append(merged)
        return result

    def _remember(self, piece: str, ids: bytes) -> None:
        self.known[piece] = ids
        self.held += ENTRY_BYTES + len(piece) + len(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if self.held > MEMORY_BYTES:
            self.older, self.known, self.held = self.known, {}, 0
        split = [self.pieces(t) for t in texts]
        known, whole = self.known, self.whole
        rest: list[tuple[str, bytes]] = []
        size = 0
        for piece in {p for pieces in split for p in pieces if p not in known}:
            ids = self.older.get(piece)
            if ids is None:
                data = piece.encode("utf-8", "surrogatepass")
                rank = whole.get(data)
                if rank is None:
                    rest.append((piece, data))
                    size += len(data)
                    if size >= MERGED_BYTES:
                        self._merged(rest)
                        size = 0
                    continue
                ids = rank.to_bytes(4, "little")
            self._remember(piece, ids)
        self._merged(rest)
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]

    def _merged(self, rest: list[tuple[str, bytes]]) -> None:
        """Merge the pre-tokens that wait and empty the list."""
        if rest:
            for (piece, _), ids in zip(rest, self.merge([data for _, data in rest])):
                self._remember(piece, array("I", ids).tobytes())
            rest.clear()

    def decode(self, ids: bytes) -> bytes:
        numbers = array("I")
        numbers.frombytes(ids)
        return b"".join(map(self.bytes_of.__getitem__, numbers))


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(vocabulary: str, pattern: str) -> Codec:
    """The codec of this Python worker."""
    if (vocabulary, pattern) not in _codecs:
        _codecs.clear()
        _codecs[vocabulary, pattern] = Codec(load_ranks(vocabulary), pattern)
    return _codecs[vocabulary, pattern]


def digests(df: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of ids, digest of the ids and digest of the decoded bytes, per row."""
    rows = df.select(doc_id, text)
    schema = T.StructType([
        rows.schema[doc_id], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for batch in chunks(batches, text, SLICE_BYTES):
            ids = codec.encode(texts_of(batch, text))
            yield with_columns(batch, [doc_id], {
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                "decoded_sha256": pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in ids])})

    return rows.mapInArrow(digested, schema)


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of its texts in an array column, named apart from existing columns."""
    keep, out = df.columns, free_name(df, ids)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.LongType()))])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for batch in chunks(batches, text, SLICE_BYTES):
            arrays = []
            for packed in codec.encode(texts_of(batch, text)):
                numbers = array("I")
                numbers.frombytes(packed)
                arrays.append(numbers.tolist())
            yield with_columns(batch, keep, {out: pa.array(arrays, pa.list_(pa.int64()))})

    return df.mapInArrow(encoded, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its ids; null ids give no bytes."""
    keep, out = df.columns, free_name(df, out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {rank: token for token, rank in load_ranks(vocabulary).items()}
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            yield with_columns(batch, keep, {
                out: pa.array([b"".join(map(bytes_of.__getitem__, x or ())) for x in lists], pa.binary())})

    return df.mapInArrow(decoded, schema)
