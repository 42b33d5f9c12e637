"""Walk-forward evaluation: a forest per fold, tested on the month after its half-year."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions.numeric import percentage_error
from almanac.models.pipelines import SEED, pipeline
from almanac.operators.folds import Fold, test_filter, train_filter
from almanac.sources.staging import materialise


def stage_months(rows: DataFrame, features: list[str], label: str) -> DataFrame:
    """Write the complete rows once, in a folder per month, so that each fold reads only its own months."""
    complete = rows.select(*features, label, "year", "month").na.drop("any")
    return materialise(complete, "months", partition_by=("year", "month"))


def forest_errors(
    months: DataFrame, features: list[str], label: str, folds: list[Fold], parallelism: int = 4, **params
) -> DataFrame:
    """Mean absolute percentage error per fold: fold_year, half, mape.

    The folds are independent; up to ``parallelism`` of them are fitted at the same time, so that the small
    stages of one fit do not leave the cluster idle. Only the fitted trees come to the driver.
    """

    @inheritable_thread_target(months.sparkSession)
    def fit_fold(fold: Fold) -> PipelineModel:
        forest = RandomForestRegressor(labelCol=label, seed=SEED, **params)
        return pipeline(forest, features).fit(months.filter(train_filter(fold)))

    with ThreadPool(min(parallelism, len(folds))) as pool:
        models = pool.map(fit_fold, folds)
    return reduce(DataFrame.unionByName, [_fold_error(m, months, f, label) for m, f in zip(models, folds)])


def _fold_error(model: PipelineModel, months: DataFrame, fold: Fold, label: str) -> DataFrame:
    predicted = model.transform(months.filter(test_filter(fold)))
    error = percentage_error(F.col("prediction"), F.col(label))
    year, half = fold
    return predicted.agg(F.avg(error).alias("mape")).select(
        F.lit(year).alias("fold_year"), F.lit(half).alias("half"), "mape"
    )
