"""From raw labelled pairs to cleaned splits and corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.operators.corpus import (
    build_corpus, build_pairs, canonicalize_ids, clean_corpus, clean_pairs, normalize_pairs,
)
from nearkin.operators.splits import hash_split, stratified_split
from nearkin.session import materialize


@dataclass(frozen=True)
class Prepared:
    splits: DataFrame
    corpus: DataFrame


def prepare(raw: DataFrame, seed: int = 42, exact: bool = False, canonical_ids: bool = False) -> Prepared:
    """Flatten, deduplicate, split and clean a table of labelled pairs.

    ``exact`` takes the split of exact size and ratio instead of the shuffle-free hash split.
    ``canonical_ids`` gives repeated texts the id the corpus knows them by.
    """
    normalized = normalize_pairs(raw)
    corpus = build_corpus(normalized, one_text_per_id="questions" in raw.columns)
    pairs = build_pairs(normalized)
    if canonical_ids:
        corpus = materialize(corpus, "corpus")
        pairs = canonicalize_ids(pairs, corpus)
    keyed = pairs.withColumn("_key", F.concat_ws("-", "qid1", "qid2"))
    split = (stratified_split if exact else hash_split)(keyed, "_key", seed=seed)
    return Prepared(clean_pairs(split.drop("_key")), clean_corpus(corpus))
