"""Measures of prediction quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.numeric import ratio
from almanac.operators.running import running_totals


def mape(predictions: DataFrame, prediction: str, actual: str, keys: list[str]) -> DataFrame:
    """Mean absolute percentage error per key: keys, n, mape.

    A row with a zero actual value adds no error but still counts in the divisor.
    """
    return _with_mape(_error_sums(predictions, prediction, actual, keys), keys)


def mape_by_slice(predictions: DataFrame, prediction: str, actual: str, slice_by: str) -> DataFrame:
    """The error of all rows and of every slice, from one pass: slice, n, mape.

    The sums per slice are rolled up to the total, so no input row is counted twice.
    """
    sums = _error_sums(predictions, prediction, actual, [slice_by])
    rolled = (
        sums.rollup(slice_by)
        .agg(F.sum("error").alias("error"), F.sum("n").alias("n"), F.grouping(slice_by).alias("total"))
        .withColumn("slice", F.when(F.col("total") == 1, "all").otherwise(F.col(slice_by).cast("string")))
    )
    return _with_mape(rolled, ["slice"])


def _error_sums(predictions: DataFrame, prediction: str, actual: str, keys: list[str]) -> DataFrame:
    error = ratio(F.abs(F.col(prediction) - F.col(actual)), F.col(actual))
    return predictions.groupBy(*keys).agg(F.sum(error).alias("error"), F.count("*").alias("n"))


def _with_mape(sums: DataFrame, keys: list[str]) -> DataFrame:
    return sums.select(*keys, "n", (F.lit(100.0) * ratio(F.col("error"), F.col("n"))).alias("mape"))


def accuracy(
    predictions: DataFrame, prediction: str, label: str, keys: list[str], weight: str | None = None
) -> DataFrame:
    """Share of rows whose prediction equals the label: keys, n, accuracy. With ``weight`` a row counts as many."""
    correct = (F.col(prediction) == F.col(label)).cast("double")
    if weight is not None:
        sums = predictions.groupBy(*keys).agg(F.sum(weight).alias("n"), F.sum(correct * F.col(weight)).alias("right"))
        return sums.select(*keys, "n", ratio(F.col("right"), F.col("n")).alias("accuracy"))
    return predictions.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(correct).alias("accuracy"))


def propensity(
    predictions: DataFrame, key: str, prediction: str, label: str, weight: Column | None = None
) -> DataFrame:
    """Predicted and actual share of positives per key: key, n, expected, actual, highest expected first.

    With ``weight`` the rows are counts of equal rows and prediction and label are sums over them.
    """
    n = F.sum(weight) if weight is not None else F.count("*")
    return (
        predictions.groupBy(key)
        .agg(n.alias("n"), F.sum(prediction).alias("p"), F.sum(label).alias("y"))
        .select(
            key,
            "n",
            ratio(F.col("p"), F.col("n")).alias("expected"),
            ratio(F.col("y"), F.col("n")).alias("actual"),
        )
        .orderBy(F.desc("expected"), key)
    )


def threshold_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives at or above every distinct score: threshold, tp, fp, positives, negatives, pos, neg.

    Rows are counted per score first. The counts are then accumulated slice by slice, so neither a frequent score
    nor a long list of distinct ones ends up in one task. Rows without a score are not ranked.
    """
    per_score = (
        scored.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    running = running_totals(per_score, {"tp": F.col("pos"), "fp": F.col("neg")}, [F.desc("threshold")])
    return running.select(
        "threshold", "pos", "neg", "tp", "fp",
        running.agg(F.sum("pos").alias("total")).scalar().alias("positives"),
        running.agg(F.sum("neg").alias("total")).scalar().alias("negatives"),
    )


def threshold_sweep(counts: DataFrame) -> DataFrame:
    """Precision, recall and F-measure of calling every score from the threshold on positive."""
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("positives"))
    f_measure = ratio(F.lit(2.0) * F.col("tp"), F.col("tp") + F.col("fp") + F.col("positives"))
    return counts.select(
        "threshold", "tp", "fp", precision.alias("precision"), recall.alias("recall"), f_measure.alias("f_measure")
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold with the highest F-measure, the highest such threshold on a tie."""
    return (
        sweep.select("threshold", "f_measure")
        .orderBy(F.desc("f_measure"), F.desc("threshold"))
        .limit(1)
    )


def roc_curve(counts: DataFrame) -> DataFrame:
    """False and true positive rate per threshold, after the origin: fpr, tpr.

    The lowest threshold is the point (1, 1).
    """
    points = counts.select(
        ratio(F.col("fp"), F.col("negatives")).alias("fpr"), ratio(F.col("tp"), F.col("positives")).alias("tpr")
    )
    origin = counts.sparkSession.range(1).select(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(points).orderBy("fpr", "tpr")


def area_under_roc(counts: DataFrame) -> DataFrame:
    """Area under the curve: every score adds a trapezoid, which needs only its own running totals."""
    strip = F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2)
    return counts.agg(
        F.sum(strip).alias("area"), F.max("positives").alias("p"), F.max("negatives").alias("n")
    ).select(ratio(F.col("area"), F.col("p").cast("double") * F.col("n")).alias("auc"))
