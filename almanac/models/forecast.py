"""Forecasts of next week's count from the counts of the weeks before."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.models.categories import EncodedModel, category_index, encode, fit_encoded
from almanac.models.pipelines import SEED, pipeline
from almanac.operators.accuracy import mape, mape_by_slice
from almanac.sources.staging import fit_layout

LABEL = "next_week"


def train_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("part") == "train")


def test_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("part") == "test")


def fit_linear(rows: DataFrame) -> PipelineModel:
    """Least squares on the last two weeks, by the normal equations: one pass over the training rows."""
    return pipeline(LinearRegression(labelCol=LABEL, solver="normal"), ["lag2", "lag1"]).fit(train_rows(rows))


def fit_forest(rows: DataFrame, **params) -> EncodedModel:
    """Random forest on the last four weeks, the beat and its area."""
    forest = RandomForestRegressor(labelCol=LABEL, seed=SEED, **params)
    train, numeric = train_rows(rows), ["lag4", "lag3", "lag2", "lag1", "area"]
    index = category_index(train, ["beat"])
    return fit_encoded(forest, encode(train, index, numeric, ["beat"]), index, numeric, ["beat"])


def fit_tree(rows: DataFrame, depth: int) -> PipelineModel:
    """One tree on the last four weeks and the area."""
    tree = RandomForestRegressor(
        labelCol=LABEL, seed=SEED, numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=depth, maxBins=256
    )
    return pipeline(tree, ["lag4", "lag3", "lag2", "lag1", "area"]).fit(fit_layout(train_rows(rows)))


def linear_errors(model: PipelineModel, rows: DataFrame, by_arrest: DataFrame) -> DataFrame:
    """Error on the test rows, and on the whole series with and without arrest: slice, n, mape."""
    overall = mape(model.transform(test_rows(rows)).withColumn("slice", F.lit("all")), "prediction", LABEL, ["slice"])
    series = model.transform(by_arrest).withColumn("slice", F.col("arrest").cast("string"))
    return overall.unionByName(mape(series, "prediction", LABEL, ["slice"]))


def forest_errors(model: EncodedModel | PipelineModel, rows: DataFrame) -> DataFrame:
    """Error on the test rows, all of them and by the majority flag: slice, n, mape."""
    return mape_by_slice(model.transform(test_rows(rows)), "prediction", LABEL, "violent")
