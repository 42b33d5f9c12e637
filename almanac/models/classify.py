"""Classification of inspections."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.models import cells
from almanac.models.categories import FEATURES, EncodedModel, category_index, encode, fit_encoded
from almanac.models.pipelines import SEED
from almanac.operators.accuracy import accuracy, best_threshold, threshold_counts, threshold_sweep
from almanac.operators.classes import CATEGORICAL, NUMERIC


def estimator(kind: str, **params):
    """Boosted trees ("gbt"), random forest ("forest") or logistic regression ("logistic")."""
    if kind == "gbt":
        return GBTClassifier(labelCol="label", seed=SEED, **params)
    if kind == "forest":
        return RandomForestClassifier(labelCol="label", seed=SEED, **params)
    if kind == "logistic":
        return LogisticRegression(labelCol="label", **params)
    raise ValueError(f"unknown classifier {kind!r}")


def complete_rows(rows: DataFrame) -> DataFrame:
    """Drop the rows in which a number is missing; missing categories are kept."""
    return rows.na.drop("any", subset=list(NUMERIC))


def _train(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("part") == "train")


def encoded(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their feature vectors, written, and the index of the categories of their training part."""
    index = category_index(_train(rows), list(CATEGORICAL))
    return encode(rows, index, list(NUMERIC), list(CATEGORICAL)), index


def fit(rows: DataFrame, kind: str, index: DataFrame | None = None, **params) -> EncodedModel:
    """Fit on the training part of complete rows; with ``index`` they are ``encoded`` already.

    Boosted trees of many rows are grown on merged ones, which the model then wants encoded as it says.
    """
    estimating = estimator(kind, **params)
    if kind == "gbt" and cells.merges(estimating, n := _train(rows).count()):
        raw = rows.drop(FEATURES)
        index = category_index(_train(raw), list(CATEGORICAL)) if index is None else index
        return cells.fit_merged(estimating, raw, index, list(NUMERIC), list(CATEGORICAL), n)[0]
    if index is None:
        rows, index = encoded(rows)
    # Boosted trees and forests draw the candidates of their splits from a sample of the rows, and forests the rows too.
    return fit_encoded(estimating, _train(rows), index, list(NUMERIC), list(CATEGORICAL), sampled=kind != "logistic")


def fitted(rows: DataFrame, kind: str, **params) -> tuple[EncodedModel, DataFrame]:
    """A model of written rows, and the rows as it reads them, merged if it was fitted on merged ones."""
    estimating = estimator(kind, **params)
    if kind == "gbt" and cells.merges(estimating, n := _train(rows).count()):
        index = category_index(_train(rows), list(CATEGORICAL))
        return cells.fit_merged(estimating, rows, index, list(NUMERIC), list(CATEGORICAL), n)
    rows, index = encoded(rows)
    return fit(rows, kind, index, **params), rows


def part_accuracy(model: EncodedModel, rows: DataFrame) -> DataFrame:
    """Accuracy on the training and the test part, from one pass: part, n, accuracy."""
    weight = cells.WEIGHT if cells.WEIGHT in rows.columns else None
    return accuracy(model.transform(rows), "prediction", "label", ["part"], weight)


def threshold_accuracy(model: EncodedModel, rows: DataFrame) -> DataFrame:
    """Accuracy per part at the threshold that serves the training part best: part, n, accuracy, threshold."""
    scored = with_score(model, rows)
    train = scored.filter(F.col("part") == "train")
    best = best_threshold(threshold_sweep(threshold_counts(train, "score", "label")))
    decided = scored.withColumn("threshold", best.select("threshold").scalar())
    called = decided.withColumn("prediction", (F.col("score") >= F.col("threshold")).cast("int"))
    return accuracy(called, "prediction", "label", ["part", "threshold"]).select("part", "n", "accuracy", "threshold")


def with_score(model, rows: DataFrame) -> DataFrame:
    """Add the probability of class 1 as score."""
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1])
