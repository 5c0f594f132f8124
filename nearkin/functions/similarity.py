"""Similarity of two texts: lengths, word overlap and edit similarity."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.functions.text import let, word_count, words


def length_features(q1: Column, q2: Column) -> dict[str, Column]:
    """Characters and words of both sides and their absolute differences."""
    return {
        "len_q1_chars": F.length(q1),
        "len_q2_chars": F.length(q2),
        "len_diff_chars": F.abs(F.length(q1) - F.length(q2)),
        "len_q1_words": word_count(q1),
        "len_q2_words": word_count(q2),
        "len_diff_words": F.abs(word_count(q1) - word_count(q2)),
    }


def common_word_count(q1: Column, q2: Column) -> Column:
    """Distinct lower-cased words held by both sides."""
    return F.size(F.array_intersect(words(F.lower(q1)), words(F.lower(q2))))


def jaccard(q1: Column, q2: Column) -> Column:
    """Shared share of the distinct lower-cased words; 0 when neither side has a word."""
    return let(
        F.struct(words(F.lower(q1)).alias("a"), words(F.lower(q2)).alias("b")),
        lambda s: F.coalesce(
            F.try_divide(
                F.size(F.array_intersect(s["a"], s["b"])).cast("double"),
                F.size(F.array_union(s["a"], s["b"])),
            ),
            F.lit(0.0),
        ),
    )


def overlap_features(q1: Column, q2: Column) -> dict[str, Column]:
    return {"common_word_ratio": jaccard(q1, q2), "common_word_count": common_word_count(q1, q2)}


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over Python integers."""
    if a == b:
        return len(a)
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return 0
    start = 0
    limit = len(b)
    while start < limit and a[start] == b[start]:
        start += 1
    tail = 0
    while tail < limit - start and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    shared = start + tail
    a, b = a[start:len(a) - tail], b[start:len(b) - tail]
    if not b:
        return shared
    positions: dict[str, list[int]] = defaultdict(list)
    for index, char in enumerate(a):
        positions[char].append(index)
    full = (1 << len(a)) - 1
    masks = {}
    for char in set(b) & positions.keys():
        bits = bytearray((len(a) + 7) // 8)
        for index in positions[char]:
            bits[index >> 3] |= 1 << (index & 7)
        mask = int.from_bytes(bits, "little")
        masks[char] = mask, full ^ mask
    # carries out of the highest bit add up above it, which takes few bits and touches none below
    open_bits = full
    for mask, others in map(masks.__getitem__, filter(masks.__contains__, b)):
        open_bits = (open_bits + (open_bits & mask)) | (open_bits & others)
    return shared + len(a) - (open_bits & full).bit_count()


@F.pandas_udf(T.LongType())
def _lcs(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else lcs_length(a, b) for a, b in zip(left, right)],
                     dtype="Int64")


def indel_ratio(a: Column, b: Column) -> Column:
    """``2·LCS / (len a + len b)``; 1 when both are empty."""
    trivial = (a == b) | (F.length(a) == 0) | (F.length(b) == 0)
    lcs = _lcs(F.when(~trivial, a), F.when(~trivial, b))
    return F.when(a == b, 1.0).when(trivial, 0.0).otherwise(2.0 * lcs / (F.length(a) + F.length(b)))


def _sorted_words(text: Column) -> Column:
    return F.array_join(F.sort_array(words(text)), " ")


FUZZY_SCHEMA = T.StructType([
    T.StructField("lcs_text", T.LongType()),
    T.StructField("lcs_sorted", T.LongType()),
    T.StructField("lcs_rest", T.LongType()),
])


@F.pandas_udf(FUZZY_SCHEMA)
def _lcs_triple(a: pd.Series, b: pd.Series, sort_a: pd.Series, sort_b: pd.Series,
                rest_a: pd.Series, rest_b: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({
        "lcs_text": [lcs_length(x, y) for x, y in zip(a, b)],
        "lcs_sorted": [lcs_length(x, y) for x, y in zip(sort_a, sort_b)],
        "lcs_rest": [lcs_length(x, y) for x, y in zip(rest_a, rest_b)],
    })


def fuzzy_features(df, q1: str, q2: str):
    """Add ``fuzz_ratio``, ``fuzz_token_sort_ratio`` and ``fuzz_token_set_ratio`` to ``df``.

    Sorting words and splitting them into shared and own sets is native; the three longest
    common subsequences of a row make one Arrow round trip.
    """
    a, b = F.coalesce(F.col(q1), F.lit("")), F.coalesce(F.col(q2), F.lit(""))
    prepared = (
        df.withColumns({
            "_wa": F.array_distinct(words(a)),
            "_wb": F.array_distinct(words(b)),
            "_sa": _sorted_words(a),
            "_sb": _sorted_words(b),
        })
        .withColumns({
            "_both": F.array_join(F.sort_array(F.array_intersect("_wa", "_wb")), " "),
            "_ra": F.array_join(F.sort_array(F.array_except("_wa", "_wb")), " "),
            "_rb": F.array_join(F.sort_array(F.array_except("_wb", "_wa")), " "),
        })
        .withColumn("_lcs", _lcs_triple(a, b, "_sa", "_sb", "_ra", "_rb"))
    )

    def ratio(lcs: Column, n1: Column, n2: Column) -> Column:
        return F.coalesce(F.try_divide(2.0 * lcs, n1 + n2), F.lit(1.0))

    shared = F.length("_both")
    gap = F.when(shared > 0, 1).otherwise(0)
    only_a, only_b = F.length("_ra"), F.length("_rb")
    full_a, full_b = shared + gap + only_a, shared + gap + only_b
    edits = only_a + only_b - 2 * F.col("_lcs.lcs_rest")
    rest_score = 1.0 - F.try_divide(edits.cast("double"), full_a + full_b)
    left_score = 1.0 - F.try_divide((gap + only_a).cast("double"), shared + full_a)
    right_score = 1.0 - F.try_divide((gap + only_b).cast("double"), shared + full_b)
    token_set = (
        F.when((F.size("_wa") == 0) | (F.size("_wb") == 0), 0.0)
        .when((shared > 0) & ((only_a == 0) | (only_b == 0)), 1.0)
        .when(shared == 0, rest_score)
        .otherwise(F.greatest(rest_score, left_score, right_score))
    )
    return prepared.withColumns({
        "fuzz_ratio": ratio(F.col("_lcs.lcs_text"), F.length(a), F.length(b)),
        "fuzz_token_sort_ratio": ratio(F.col("_lcs.lcs_sorted"), F.length("_sa"), F.length("_sb")),
        "fuzz_token_set_ratio": token_set,
    }).drop("_wa", "_wb", "_sa", "_sb", "_both", "_ra", "_rb", "_lcs")
