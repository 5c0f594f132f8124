"""Deep evaluation: overall, slices, errors, retrieval and the gap between splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearkin.operators.classification import best_threshold, evaluate_classifier, score_curve, top_errors
from nearkin.operators.corpus import length_slice
from nearkin.operators.retrieval import evaluate_retrieval, retrieval_queries
from nearkin.operators.vectors import VectorIndex, knn_clustered


def slice_metrics(scored: DataFrame, q1: str = "question1", q2: str = "question2", threshold: float = 0.5) -> DataFrame:
    """Classification metrics per text length slice; empty slices do not appear."""
    sliced = scored.select(length_slice(F.col(q1), F.col(q2)).alias("slice"), "y_true", "y_prob")
    return evaluate_classifier(sliced, threshold, by=["slice"])


def split_gap(scored: DataFrame, threshold: float = 0.5, left: str = "train", right: str = "val") -> DataFrame:
    """Difference of each metric between two splits, a sign of overfitting when large."""
    metrics = evaluate_classifier(scored, threshold, by=["split"])
    pick = lambda split, name: F.max(F.when(F.col("split") == split, F.col(name)))
    names = ["precision", "recall", "f1", "auc_roc", "avg_precision"]
    return metrics.agg(*[F.round(pick(left, n) - pick(right, n), 4).alias(f"{n}_gap") for n in names])


def errors_at_best_threshold(scored: DataFrame, n: int = 10, key: str = "id") -> DataFrame:
    """Most confident errors at the threshold of the best F1, with that ``threshold``; empty without scores."""
    best = best_threshold(score_curve(scored)).first()
    threshold = best["threshold"] if best and best["threshold"] is not None else None
    at = scored if threshold is not None else scored.limit(0)
    value = 0.5 if threshold is None else float(threshold)
    return top_errors(at, value, n, key).withColumn("threshold", F.lit(value))


def retrieval_quality(pairs: DataFrame, questions: DataFrame, index: VectorIndex, n: int | None = None, k: int = 10,
                      probe: int | None = None, exclude_self: bool = False) -> DataFrame:
    """Recall and MRR of the index on the positive pairs.

    A query is itself in the index and by default stays among its hits, which keeps recall at
    1 low; ``exclude_self`` removes it.
    """
    indexed = questions.filter(F.col("vec_id").isNotNull())
    queries, truth = retrieval_queries(pairs, indexed.select("question_id"), n)
    vectors = queries.join(index.vectors, queries["query_id"] == index.vectors["id"]).select(
        "query_id", F.col("embedding").alias("query_embedding"))
    return evaluate_retrieval(queries, knn_clustered(vectors, index, k, probe, exclude_self), truth)


def deep_evaluation(scored: DataFrame, key: str, threshold: float = 0.5, n_errors: int = 5,
                    retrieval: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables of a full report on ``scored(key, split, question1, question2, y_true, y_prob)``.

    ``retrieval`` is the row of ``retrieval_quality`` where an index is evaluated too.
    """
    test = scored.filter(F.col("split") == "test")
    found = {} if retrieval is None else {"retrieval": retrieval}
    return found | {
        "overall": evaluate_classifier(test, threshold),
        "slices": slice_metrics(test, threshold=threshold),
        "errors": top_errors(test, threshold, n_errors, key),
        "gap": split_gap(scored, threshold),
    }


def _values(table: DataFrame, part: str, item: Column, names: list[str]) -> DataFrame:
    """``part, item, metric, value`` of the named columns."""
    numbers = table.select(item.alias("item"), *[F.col(c).cast("double").alias(c) for c in names]).unpivot(["item"], names, "metric", "value")
    return numbers.select(F.lit(part).alias("part"), "item", "metric", "value")


def report_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """``part, item, metric, value`` of all tables of a report.

    The item is the slice, or the kind and rank of an error; it is empty for the other parts.
    """
    found = []
    for part in ("overall", "gap", "retrieval"):
        if part in tables:
            found.append(_values(tables[part], part, F.lit(""), tables[part].columns))
    slices, errors = tables["slices"], tables["errors"]
    found.append(_values(slices, "slices", F.col("slice"), [c for c in slices.columns if c != "slice"]))
    texts = {f.name for f in errors.schema.fields if f.dataType.simpleString() == "string"}
    found.append(_values(errors, "errors", F.concat_ws(" ", "error_type", "rank"), [c for c in errors.columns if c not in texts | {"rank"}]))
    return reduce(DataFrame.unionByName, found)
