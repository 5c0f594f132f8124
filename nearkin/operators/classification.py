"""Classification metrics, threshold sweep and error tables.

Scored tables have ``y_true`` (0/1) and ``y_prob``. ``by`` names group columns; all groups are
evaluated in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearkin.operators.ranking import cumulative_from_top, join_null_safe, top_k
from nearkin.session import materialize


def predicted(threshold: float = 0.5, prob: str = "y_prob") -> Column:
    """1 where the probability reaches the threshold, the threshold included."""
    return (F.col(prob) >= threshold).cast("int")


def ratio(a: Column, b: Column) -> Column:
    """Quotient that is 0 when the divisor is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(scored: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """``tn, fp, fn, tp`` per group."""
    def n(truth: int, pred: int) -> Column:
        return F.count(F.when((F.col("y_true") == truth) & (predicted(threshold) == pred), 1))

    return scored.groupBy(*by).agg(
        n(0, 0).alias("tn"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(1, 1).alias("tp"))


def _precision() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def _f1() -> Column:
    return ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def score_curve(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: counts at the score and at or above it.

    ``threshold, pos, neg, tp, fp, n_pos, n_neg``. Rows are folded to distinct scores first;
    running counts come from range totals, not from a window over all rows. Rows without a
    score take no part, neither in the points nor in the totals (``unscored_rows`` counts them).
    """
    by = list(by)
    keys = by or ["_all"]
    rows = scored.filter(F.col("y_prob").isNotNull() & ~F.isnan("y_prob"))
    grouped = rows if by else rows.withColumn("_all", F.lit(1))
    # stored before the range totals are taken, so that the scored table is computed once
    points = materialize(
        grouped.groupBy(*keys, F.col("y_prob").alias("threshold")).agg(
            F.count(F.when(F.col("y_true") == 1, 1)).alias("pos"),
            F.count(F.when(F.col("y_true") == 0, 1)).alias("neg"),
        ), "score-points")
    totals = points.groupBy(*keys).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    running = cumulative_from_top(points, keys, "threshold", {"pos": "tp", "neg": "fp"})
    return join_null_safe(running, totals, keys).select(*by, "threshold", "pos", "neg", "tp", "fp", "n_pos", "n_neg")


def unscored_rows(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``n_unscored`` per group: rows whose score is null or not a number."""
    missing = F.col("y_prob").isNull() | F.isnan("y_prob")
    return scored.groupBy(*by).agg(F.count(F.when(missing, 1)).alias("n_unscored"))


def _areas() -> list[Column]:
    below = F.col("n_neg") - F.col("fp")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    pairs = F.max("n_pos").cast("double") * F.max("n_neg")
    gained = F.sum(F.col("pos") * F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")))
    both = (F.max("n_pos") > 0) & (F.max("n_neg") > 0)
    return [
        F.when(both, F.try_divide(wins, pairs)).alias("auc_roc"),
        F.when(both, F.try_divide(gained, F.max("n_pos").cast("double"))).alias("avg_precision"),
    ]


def curve_areas(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``auc_roc, avg_precision`` per group; null where a class is missing."""
    return curve.groupBy(*by).agg(*_areas())


def evaluate_classifier(scored: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """``n, precision, recall, f1, auc_roc, avg_precision`` per group, rounded to 4 digits.

    Groups without rows do not appear. The confusion counts and the areas both follow from
    the distinct-score counts, so the scored table is read once.
    """
    by = list(by)
    curve = score_curve(scored, by)
    above = F.col("threshold") >= threshold
    measured = curve.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(above, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(above, F.col("neg"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~above, F.col("pos"))), F.lit(0)).alias("fn"),
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
        *_areas(),
    )
    return measured.select(
        *by, "n",
        F.round(_precision(), 4).alias("precision"), F.round(_recall(), 4).alias("recall"),
        F.round(_f1(), 4).alias("f1"), F.round("auc_roc", 4).alias("auc_roc"),
        F.round("avg_precision", 4).alias("avg_precision"),
    )


def class_report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``class_name, precision, recall, f1, support`` for both classes and their averages."""
    c = confusion_counts(scored, threshold)
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp

    def line(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(F.lit(name).alias("class_name"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.cast("long").alias("support"))

    one = (ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(2 * tp, 2 * tp + fp + fn))
    zero = (ratio(tn, tn + fn), ratio(tn, tn + fp), ratio(2 * tn, 2 * tn + fp + fn))
    n1, n0 = tp + fn, tn + fp
    macro = [(a + b) / 2.0 for a, b in zip(zero, one)]
    weighted = [ratio(a * n0 + b * n1, total) for a, b in zip(zero, one)]
    accuracy = ratio(tn + tp, total)
    rows = c.select(F.inline(F.array(
        line("0", *zero, n0), line("1", *one, n1), line("accuracy", accuracy, accuracy, accuracy, total),
        line("macro avg", *macro, total), line("weighted avg", *weighted, total),
    )))
    return rows.select("class_name", *[F.round(m, 4).alias(m) for m in ("precision", "recall", "f1")], "support")


def roc_pr_points(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC and PR coordinates at every distinct score."""
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    return curve.select(
        *by, "threshold",
        ratio(fp, F.col("n_neg")).alias("fpr"), ratio(tp, F.col("n_pos")).alias("tpr"),
        ratio(tp, tp + fp).alias("precision"), ratio(tp, F.col("n_pos")).alias("recall"),
    )


def best_threshold(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``threshold, f1`` with the largest F1 per group; the lowest threshold wins ties.

    F1 is smoothed as ``2PR / (P + R + 1e-8)``.
    """
    by = list(by)
    points = roc_pr_points(curve, by)
    p, r = F.col("precision"), F.col("recall")
    scored = points.withColumn("f1", F.round(2 * p * r / (p + r + 1e-8), 9))
    best = scored.groupBy(*by).agg(
        F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("low"))).alias("b"))
    return best.select(*by, (-F.col("b.low")).alias("threshold"), F.round("b.f1", 4).alias("f1"))


def top_errors(scored: DataFrame, threshold: float = 0.5, n: int = 10, key: str = "id") -> DataFrame:
    """Most confident errors: ``error_type, rank`` and all columns of ``scored``.

    False positives by descending and false negatives by ascending probability; ties by key.
    """
    pred = predicted(threshold)
    kind = (F.when((F.col("y_true") == 0) & (pred == 1), "false_positive")
            .when((F.col("y_true") == 1) & (pred == 0), "false_negative"))
    wrong = scored.withColumn("error_type", kind).filter(F.col("error_type").isNotNull())
    confidence = F.when(F.col("error_type") == "false_positive", F.col("y_prob")).otherwise(-F.col("y_prob"))
    ranked = top_k(wrong.withColumn("_confidence", confidence), ["error_type"], "_confidence", n, [key])
    return ranked.select("error_type", "rank", *scored.columns)


def class_weights(df: DataFrame, label: str = "is_duplicate") -> DataFrame:
    """One row: class counts, ``neg/pos`` and the balanced weight ``n / (2·n_class)`` of both classes."""
    pos = F.count(F.when(F.col(label) == 1, 1))
    neg = F.count(F.when(F.col(label) == 0, 1))
    total = F.count("*").cast("double")
    return df.agg(
        neg.alias("n_neg"), pos.alias("n_pos"),
        F.try_divide(neg.cast("double"), pos).alias("positive_weight"),
        F.try_divide(total, 2.0 * neg).alias("balanced_neg"), F.try_divide(total, 2.0 * pos).alias("balanced_pos"),
    )


def golden_accuracy(scored: DataFrame, threshold: float = 0.5, category: str = "category") -> DataFrame:
    """Share of rows whose ``similarity >= threshold`` agrees with ``label``, per category and overall."""
    right = (((F.col("similarity") >= threshold).cast("int")) == F.col("label")).cast("int")
    per = scored.groupBy(category).agg(F.count("*").alias("n"), F.sum(right).alias("n_right"))
    overall = per.agg(F.lit("overall").alias(category), F.sum("n").alias("n"), F.sum("n_right").alias("n_right"))
    return per.unionByName(overall).select(
        category, "n", F.round(ratio(F.col("n_right"), F.col("n")), 4).alias("accuracy"))
