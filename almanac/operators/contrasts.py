"""Tests of difference between two groups of yearly counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.numeric import ratio


def yearly_counts(rows: DataFrame, year: Column, split: int) -> DataFrame:
    """Rows per known year, labelled 1 from the ``split`` year on, else 0: year, n, label."""
    counts = rows.select(year.alias("year")).filter(F.col("year").isNotNull())
    return (
        counts.groupBy("year")
        .agg(F.count("*").alias("n"))
        .withColumn("label", F.when(F.col("year") >= split, 1).otherwise(0))
    )


def welch_t(samples: DataFrame, value: str, label: str) -> DataFrame:
    """Two-sample t statistic with unequal variances, group 1 minus group 0: one row with t.

    Both groups are aggregated in the same pass. With fewer than two values in a group t is null.
    """
    measures = []
    for group in (0, 1):
        chosen = F.when(F.col(label) == group, F.col(value))
        measures += [
            F.avg(chosen).alias(f"mean{group}"),
            F.var_samp(chosen).alias(f"variance{group}"),
            F.count(chosen).alias(f"n{group}"),
        ]
    spread = ratio(F.col("variance0"), F.col("n0")) + ratio(F.col("variance1"), F.col("n1"))
    return samples.agg(*measures).select(
        "n0", "mean0", "n1", "mean1", ratio(F.col("mean1") - F.col("mean0"), F.sqrt(spread)).alias("t")
    )


def chi_square(samples: DataFrame, value: str, label: str) -> DataFrame:
    """Independence of label and value, each distinct value being a category: statistic, dof.

    The statistic is N * (sum of o^2 / (row * column) - 1), which needs only the cells that occur; the full
    contingency grid is never formed.
    """
    cells = samples.groupBy(label, value).agg(F.count("*").alias("o"))
    columns = cells.groupBy(value).agg(F.sum("o").alias("column_total"))
    rows = cells.groupBy(label).agg(F.sum("o").alias("row_total"))
    share = ratio(F.col("o") * F.col("o").cast("double"), F.col("row_total") * F.col("column_total").cast("double"))
    return (
        cells.join(columns, value)
        .join(rows, label)
        .agg(
            F.sum("o").alias("n"),
            F.sum(share).alias("share"),
            F.countDistinct(label).alias("r"),
            F.countDistinct(value).alias("c"),
        )
        .select(
            (F.col("n") * (F.col("share") - F.lit(1.0))).alias("statistic"),
            ((F.col("r") - 1) * (F.col("c") - 1)).alias("dof"),
        )
    )


def chi_square_test(samples: DataFrame, value: str, label: str) -> DataFrame:
    """The same test with its p-value, for any number of distinct values: statistic, dof, p_value."""
    return chi_square(samples, value, label).withColumn("p_value", chi_square_p_value(F.col("statistic"), F.col("dof")))


def chi_square_p_value(statistic: Column, dof: Column) -> Column:
    """Chance of a larger statistic under independence; 1 without degrees of freedom.

    One less the series of the lower incomplete gamma function, whose terms are summed by their logarithms. The terms
    peak near half the statistic and have died out well before the last one taken.
    """
    a, x = dof.cast("double") / 2, F.greatest(statistic, F.lit(1e-300)) / 2
    terms = F.ceil(x + 15 * F.sqrt(x) + 200).cast("int")
    start = F.struct((a * F.log(x) - x - _log_gamma(a + 1)).alias("log"), F.lit(0.0).alias("total"))
    series = F.aggregate(
        F.sequence(F.lit(1), terms), start,
        lambda s, i: F.struct(
            (s["log"] + F.log(x / (a + i))).alias("log"), (s["total"] + F.exp(s["log"])).alias("total")
        ),
        lambda s: s["total"],
    )
    return F.when(dof <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - series))


def _log_gamma(z: Column) -> Column:
    """Stirling's series, ten places further on, where it is exact to the last digits."""
    shifted = z + 10
    series = 1 / (12 * shifted) - 1 / (360 * shifted**3) + 1 / (1260 * shifted**5)
    full = (shifted - 0.5) * F.log(shifted) - shifted + 0.5 * math.log(2 * math.pi) + series
    return full - sum((F.log(z + i) for i in range(1, 10)), F.log(z))
