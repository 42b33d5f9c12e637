"""Walk-forward folds: a half-year to train on and the month after it to test on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.numeric import percentage_error, ratio

Fold = tuple[int, int]


def half_years(first: int, last: int) -> list[Fold]:
    """Both halves of the years from ``first`` up to ``last``, and the first half of ``last``."""
    return [(year, half) for year in range(first, last) for half in (1, 2)] + [(last, 1)]


def present_folds(rows: DataFrame, first: int | None = None, last: int | None = None) -> list[Fold]:
    """Folds that have rows to train on and rows to test on, of the years from ``first`` to ``last`` if given.

    Only the distinct months come to the driver.
    """
    months = rows.select("year", "month").filter("year IS NOT NULL AND month IS NOT NULL").distinct().collect()
    train = {(r.year, 1 if r.month <= 6 else 2) for r in months}
    test = {(r.year, 1) for r in months if r.month == 7} | {(r.year - 1, 2) for r in months if r.month == 1}
    return [
        f for f in sorted(train & test) if (first is None or f[0] >= first) and (last is None or f[0] <= last)
    ]


def train_filter(fold: Fold) -> Column:
    year, half = fold
    months = F.col("month") <= 6 if half == 1 else F.col("month") > 6
    return (F.col("year") == year) & months


def test_filter(fold: Fold) -> Column:
    year, half = fold
    if half == 1:
        return (F.col("year") == year) & (F.col("month") == 7)
    return (F.col("year") == year + 1) & (F.col("month") == 1)


def _position(role: str) -> tuple[Column, Column]:
    """The fold_year and half that a row's month trains or tests, null where it does neither."""
    year, month = F.col("year"), F.col("month")
    if role == "train":
        return year, F.when(month <= 6, 1).when(month > 6, 2)
    return (
        F.when(month == 7, year).when(month == 1, year - 1),
        F.when(month == 7, 1).when(month == 1, 2),
    )


def _is_one_of(folds: list[Fold]) -> Column:
    return (F.col("fold_year") * 2 + F.col("half")).isin([2 * year + half for year, half in folds])


def in_folds(rows: DataFrame, role: str, folds: list[Fold]) -> DataFrame:
    """Keep the rows that train, or test, one of the folds and add that fold_year and half.

    A month trains one fold and tests at most one, so both follow from the row itself, without a join.
    """
    fold_year, half = _position(role)
    return rows.withColumns({"fold_year": fold_year, "half": half}).filter(_is_one_of(folds))


def fold_sizes(rows: DataFrame, folds: list[Fold]) -> DataFrame:
    """Rows per fold and role: fold_year, half, role, n.

    The rows are counted by month in one scan; only the monthly counts are copied, once per role.
    """
    monthly = rows.groupBy("year", "month").agg(F.count("*").alias("n"))
    roles = monthly.withColumn("role", F.explode(F.array(F.lit("train"), F.lit("test"))))
    train, test = _position("train"), _position("test")
    is_train = F.col("role") == "train"
    return (
        roles.withColumns(
            {
                "fold_year": F.when(is_train, train[0]).otherwise(test[0]),
                "half": F.when(is_train, train[1]).otherwise(test[1]),
            }
        )
        .filter(_is_one_of(folds))
        .groupBy("fold_year", "half", "role")
        .agg(F.sum("n").alias("n"))
    )


def baseline_errors(rows: DataFrame, folds: list[Fold], label: str) -> DataFrame:
    """Mean absolute percentage error per fold of predicting the training mean: fold_year, half, mape."""
    monthly = rows.groupBy("year", "month").agg(F.sum(label).alias("total"), F.count(label).alias("n"))
    means = (
        in_folds(monthly, "train", folds)
        .groupBy("fold_year", "half")
        .agg(ratio(F.sum("total"), F.sum("n")).alias("mean"))
    )
    # One row per fold: the list of folds bounds what is broadcast, and no fold is gathered in one task.
    return (
        in_folds(rows, "test", folds)
        .join(F.broadcast(means), ["fold_year", "half"])
        .groupBy("fold_year", "half")
        .agg(F.avg(percentage_error(F.col("mean"), F.col(label))).alias("mape"))
    )


def fold_summary(errors: DataFrame) -> DataFrame:
    """Average, minimum and maximum over the folds, each fold counting once."""
    return errors.agg(
        F.avg("mape").alias("average"), F.min("mape").alias("minimum"), F.max("mape").alias("maximum")
    )
