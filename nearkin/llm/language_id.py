"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed n-grams of one to three bytes, damped counts times inverse
document frequency, scaled to length one. Each language has a few centroids from spherical
k-means; the text gets the language of the centroid with the largest cosine. A text farther
from it than nearly all of the language's own examples is marked as rejected.

Document frequencies are counted over all training texts, in Spark, into a fixed number of
dimensions. The centroids come from at most ``FIT_ROWS`` training texts in equal shares per
language, those with the smallest hashed ids, of which only the vectors reach the driver.

Defined results: null texts and texts without a letter get ``und`` and score 0; rows with a
null language teach nothing; without training rows every text is ``und``; equal texts get
equal results, ties go to the first language in order; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.llm.common import chunks, free_name, texts_of, with_columns

FIT_ROWS = 2_000
DIMENSIONS = 1 << 13
CLUSTERS = 3
PARTS = 64
REJECTED_SHARE = 0.005
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
_SPACES = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Dimensions that a text touches and how often."""
    raw = b" ".join([b"", *text.lower().encode("utf-8", "replace").translate(_SPACES).split(), b""])
    one = np.frombuffer(raw, np.uint8).astype(np.uint32)
    two = one[:-1] << np.uint32(8) | one[1:]
    three = two[:-1] << np.uint32(8) | one[2:]
    keys = np.concatenate([one, two | np.uint32(1 << 24), three | np.uint32(1 << 25)])
    counts = np.bincount((keys * np.uint32(2654435761)) >> np.uint32(32 - 13), minlength=DIMENSIONS)
    touched = np.flatnonzero(counts)
    return touched, counts[touched]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Touched dimensions and weights, of length one unless all weights are 0."""
    touched, counts = grams(text)
    weights = (1 + np.log(counts)) * idf[touched]
    return touched, weights / (np.linalg.norm(weights) or 1)


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]
    language_of: np.ndarray  # of each centroid
    centroids: np.ndarray  # shape (dimensions, centroids)
    least: np.ndarray  # cosine under which a text of the language is rejected

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, cosine and whether the text is too far away."""
        if not self.languages or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        touched, weights = vector(text, self.idf)
        cosines = weights @ self.centroids[touched]
        best = int(cosines.argmax())
        language = int(self.language_of[best])
        cosine = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[language], cosine, bool(cosine < self.least[language])


def clusters(rows: np.ndarray, count: int, seed: int = 42, rounds: int = 12) -> np.ndarray:
    """Centroids of unit rows by spherical k-means."""
    rng = np.random.default_rng(seed)
    centroids = rows[[int(rng.integers(len(rows)))]]
    while len(centroids) < min(count, len(rows)):
        far = 1 - (rows @ centroids.T).max(1)
        centroids = np.vstack([centroids, rows[[int(far.argmax())]]])
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(1)
        sums = np.array([rows[nearest == c].sum(0) if (nearest == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def document_frequencies(training: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many texts each dimension occurs, and the number of texts."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in chunks(batches, text):
            for t in texts_of(batch, text):
                total[grams(t)[0]] += 1
                total[-1] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["dimension", "n"])

    counts = (training.select(text).mapInArrow(counted, "dimension long, n long")
              .groupBy("dimension").agg(F.sum("n").alias("n")).toArrow())  # at most DIMENSIONS + 1 rows
    total = np.zeros(DIMENSIONS + 1, np.int64)
    total[counts.column("dimension").to_numpy()] = counts.column("n").to_numpy()
    return total[:-1], int(total[-1])


def fit(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", held_out: Column | None = None,
        fit_rows: int = FIT_ROWS, n_clusters: int = CLUSTERS) -> Model:
    """Centroids from the rows with a language for which ``held_out`` is false."""
    known = documents.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    if held_out is not None:
        known = known.filter(~held_out)
    seen, total = document_frequencies(known, text)
    idf = np.log((1 + total) / (1 + seen)) + 1
    n_languages = known.select(lang).distinct().count()
    share = max(1, fit_rows // max(1, n_languages))
    # first within parts of each language, so that no task meets what all tasks send
    ids = known.select(doc_id, F.col(lang).alias("_lang")).withColumn("_h", F.xxhash64(doc_id))
    parts = Window.partitionBy("_lang", F.pmod("_h", F.lit(PARTS))).orderBy("_h", doc_id)
    first = Window.partitionBy("_lang").orderBy("_h", doc_id)
    chosen = (ids.withColumn("_n", F.row_number().over(parts)).filter(F.col("_n") <= share)
              .withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= share).groupBy(doc_id).agg(F.min("_lang").alias("_lang")))
    examples = known.select(doc_id, text).join(F.broadcast(chosen), doc_id)  # at most fit_rows ids
    schema = "_id long, _lang string, dimensions array<int>, weights array<float>"
    rows = examples.select(F.xxhash64(doc_id).alias("_id"), "_lang", text)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            found = [vector(t, idf) if LETTER.search(t) else None for t in texts_of(batch, text)]
            keep = [i for i, v in enumerate(found) if v]
            yield with_columns(batch.take(pa.array(keep, pa.int64())), ["_id", "_lang"], {
                "dimensions": pa.array([found[i][0] for i in keep], pa.list_(pa.int32())),
                "weights": pa.array([found[i][1] for i in keep], pa.list_(pa.float32()))})

    # rows that repeat an id count once
    table = (rows.mapInArrow(vectors, schema).groupBy("_id", "_lang")
             .agg(F.min(F.struct("dimensions", "weights")).alias("v")).orderBy("_lang", "_id").select("_lang", "v.*").toArrow())
    langs = table.column("_lang").to_pylist()
    languages = sorted(set(langs))
    centroids, owner, least = [], [], np.zeros(len(languages))
    for number, language in enumerate(languages):
        own = [i for i, x in enumerate(langs) if x == language]
        dense = np.zeros((len(own), DIMENSIONS), np.float32)
        for row, i in zip(dense, own):
            row[table.column("dimensions")[i].values.to_numpy()] = table.column("weights")[i].values.to_numpy()
        found = clusters(dense, n_clusters)
        least[number] = np.quantile((dense @ found.T).max(1), REJECTED_SHARE)
        centroids.append(found)
        owner += [number] * len(found)
    stacked = np.vstack(centroids).T.copy() if centroids else np.zeros((DIMENSIONS, 0))
    return Model(idf, languages, np.array(owner, np.int64), stacked, least)


def identify(df: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``df`` with language, cosine and rejection; the second value names the new columns."""
    keep = df.columns
    names = {n: free_name(df, n) for n in ("lang_pred", "score", "rejected")}
    schema = T.StructType([*df.schema.fields, T.StructField(names["lang_pred"], T.StringType()),
                           T.StructField(names["score"], T.DoubleType()), T.StructField(names["rejected"], T.BooleanType())])

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            found = [model.predict(t) for t in texts_of(batch, text)]
            yield with_columns(batch, keep, {
                names["lang_pred"]: pa.array([f[0] for f in found], pa.string()),
                names["score"]: pa.array([f[1] for f in found], pa.float64()),
                names["rejected"]: pa.array([f[2] for f in found], pa.bool_())})

    return df.mapInArrow(identified, schema), names
