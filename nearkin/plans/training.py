"""Pair classifiers on the feature table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.operators import boosting
from nearkin.operators.classification import class_weights, evaluate_classifier
from nearkin.operators.features import build_features
from nearkin.operators.tfidf import MAX_TERMS, TfidfModel, fit_tfidf
from nearkin.session import materialize, scratch_path


@dataclass(frozen=True)
class PairModel:
    name: str
    model: PipelineModel
    features: list[str]

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, name: str, path: str) -> "PairModel":
        model = PipelineModel.load(path)
        return cls(name, model, model.stages[0].getInputCols())

    def score(self, features: DataFrame, label: str = "is_duplicate") -> DataFrame:
        """Feature rows with ``y_true`` and ``y_prob``."""
        scored = self.model.transform(features)
        return scored.select(
            *features.columns, F.col(label).cast("int").alias("y_true"),
            F.get(vector_to_array("probability"), F.lit(1)).alias("y_prob"))


def split_features(splits: DataFrame, key: str, max_terms: int = MAX_TERMS,
                   word_vectors: DataFrame | None = None) -> tuple[DataFrame, TfidfModel]:
    """Features of all splits with a vocabulary fitted on the training rows only.

    The table is written once: training passes over it many times.
    """
    train = splits.filter(F.col("split") == "train")
    tfidf = fit_tfidf(train, "q1_classical", "q2_classical", max_terms)
    features = build_features(splits, key, tfidf=tfidf, word_vectors=word_vectors, keep=("split", "is_duplicate"))
    return materialize(features, "features"), tfidf


def train_logistic_regression(features: DataFrame, names: list[str], label: str = "is_duplicate",
                              c: float = 1.0, max_iter: int = 1000) -> PairModel:
    """Standardized features, balanced class weights, L2 penalty of strength ``1/c``.

    Spark divides the loss by the sum of weights, which for balanced weights is the row count;
    the penalty is scaled to match.
    """
    w = class_weights(features, label).first()
    n = w["n_neg"] + w["n_pos"]
    weighted = features.withColumn(
        "_weight", F.when(F.col(label) == 1, F.lit(w["balanced_pos"])).otherwise(F.lit(w["balanced_neg"])))
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=names, outputCol="_assembled"),
        StandardScaler(inputCol="_assembled", outputCol="_scaled", withMean=True, withStd=True),
        LogisticRegression(featuresCol="_scaled", labelCol=label, weightCol="_weight", regParam=1.0 / (c * n),
                           elasticNetParam=0.0, standardization=False, maxIter=max_iter),
    ])
    # a fitted model holds its training summary and with it the session; a stored one ships cleanly
    path = scratch_path(features.sparkSession, "logistic-regression")
    pipeline.fit(weighted).write().save(path)
    return PairModel.load("logistic_regression", path)


def train_boosted_trees(features: DataFrame, names: list[str], validation: str | None = None, label: str = "is_duplicate",
                        **settings: float) -> boosting.BoostedTrees:
    """Gradient-boosted trees with positives weighted by ``neg/pos`` of the training rows.

    ``validation`` names a boolean column; its rows stop the boosting when their AUC has not grown for
    ``patience`` rounds. ``settings`` are those of ``boosting.Settings``.
    """
    fit_rows = features if validation is None else features.filter(~F.coalesce(F.col(validation), F.lit(False)))
    w = class_weights(fit_rows, label).first()
    chosen = boosting.Settings(**{"positive_weight": w["positive_weight"] or 1.0, **settings})
    return boosting.train(features, list(names), label, validation, chosen)


def feature_importance(model: boosting.BoostedTrees, spark: SparkSession, n: int = 10) -> DataFrame:
    """``feature, importance`` of the ``n`` features with the highest mean gain of a split."""
    rows = list(model.importance().items())
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(n)


def evaluate_models(models: list[PairModel | boosting.BoostedTrees], features: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``model, split, metric, value`` of every model on every split, in one evaluation."""
    scored = None
    for m in models:
        rows = m.score(features).select(F.lit(m.name).alias("model"), "split", "y_true", "y_prob")
        scored = rows if scored is None else scored.unionByName(rows)
    metrics = evaluate_classifier(scored, threshold, by=["model", "split"])
    names = ["precision", "recall", "f1", "auc_roc", "avg_precision"]
    return metrics.unpivot(["model", "split"], names, "metric", "value")
