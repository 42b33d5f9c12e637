"""Pipelines, and what can be read out of a fitted one."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.models.categories import EncodedModel
from almanac.operators.running import numbered

SEED = 42


def pipeline(estimator: Estimator, numeric: list[str]) -> Pipeline:
    """Assemble the features and fit. Nulls must have been dropped; for categories see ``categories``."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(numeric), outputCol="features"), estimator])


def feature_names(transformed: DataFrame) -> list[str]:
    """Names of the slots of the assembled vector, from its column metadata."""
    groups = transformed.schema["features"].metadata["ml_attr"]["attrs"].values()
    attributes = sorted((a for group in groups for a in group), key=lambda a: a["idx"])
    return [a["name"] for a in attributes]


def feature_importances(model: EncodedModel, k: int) -> DataFrame:
    """The k most important features of a fitted tree ensemble: feature, score. Ties by name."""
    scores = model.named(model.fitted.featureImportances.toArray(), "score").select("feature", "score")
    return scores.orderBy(F.desc("score"), "feature").limit(k)


def coefficients(model: EncodedModel | PipelineModel, rows: DataFrame) -> DataFrame:
    """Coefficients and intercept of a fitted linear or logistic model: term, coefficient."""
    spark = rows.sparkSession
    if isinstance(model, EncodedModel):
        fitted = model.fitted
        terms = model.named(fitted.coefficients.toArray(), "coefficient").withColumnRenamed("feature", "term")
    else:
        fitted = model.stages[-1]
        pairs = list(zip(feature_names(model.transform(rows)), map(float, fitted.coefficients.toArray())))
        terms = spark.createDataFrame(pairs, "term string, coefficient double")
    intercept = spark.createDataFrame([("intercept", float(fitted.intercept))], "term string, coefficient double")
    return terms.select("term", "coefficient").unionByName(intercept)


def string_index(rows: DataFrame, column: str) -> DataFrame:
    """Index of every category, most frequent first, ties by value, null last: value, n, index.

    The categories are counted and numbered without passing through the driver, however many there are.
    """
    categories = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    order = [F.col("value").isNull().asc(), F.desc("n"), F.asc("value")]
    return numbered(categories, "index", (), order).withColumn("index", (F.col("index") - 1).cast("int"))
