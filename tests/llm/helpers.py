"""Rows with nulls, empty and long texts, copies, and columns that clash with the operators' own."""

import itertools
import random

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew potion near old river bank".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_documents(spark, schema="doc_id long, text string, score double, spans string, words int, items string, ids string, shard int, slot int"):
    """A table in which everything that may go wrong does."""
    rng = random.Random(7)
    texts = [None, "", " \n\t", "x", "Ünï cödé ẞ İ", prose(rng, 40), prose(rng, 40), prose(rng, 20_000), "a" * 50_000, "\x00\x1f é", "1 2 3"]
    texts += [texts[5], texts[5].upper(), texts[7]]
    rows = [(i, t, 0.5, "s", 1, "i", "k", 3, 4) for i, t in enumerate(texts)] + [(None, "no id here at all", 0.1, None, None, None, None, None, None)]
    rows += [rows[5]]
    return spark.createDataFrame(rows, schema).repartition(3)


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def brute_components(sets, percent=75):
    """Least id reachable over links of sufficient Jaccard similarity."""
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}
