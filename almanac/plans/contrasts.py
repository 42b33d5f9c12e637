"""Yearly order counts before and after a change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import calendar_part, year_start
from almanac.operators import contrasts
from almanac.plans.registry import query
from almanac.sources import table

SPLIT, END = 1998, 2001

YEARLY_SQL = """
    WITH yearly AS (
        SELECT year(o_orderdate) AS year, count(*) AS n,
               CASE WHEN year(o_orderdate) >= 1998 THEN 1 ELSE 0 END AS label
        FROM orders WHERE year(o_orderdate) < 2001 GROUP BY 1)
"""

CHI_SQUARE_SQL = (
    YEARLY_SQL
    + """,
    cells AS (
        SELECT l.label, v.n, count(y.n) AS o
        FROM (SELECT DISTINCT label FROM yearly) l CROSS JOIN (SELECT DISTINCT n FROM yearly) v
        LEFT JOIN yearly y ON y.label = l.label AND y.n = v.n
        GROUP BY 1, 2),
    expected AS (
        SELECT o, sum(o) OVER (PARTITION BY label) * sum(o) OVER (PARTITION BY n)
                  / CAST(sum(o) OVER () AS DOUBLE) AS e
        FROM cells),
    result AS (
        SELECT sum((o - e) * (o - e) / e) AS statistic,
               (SELECT (count(DISTINCT label) - 1) * (count(DISTINCT n) - 1) FROM yearly) AS dof
        FROM expected)
"""
)


def _yearly(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderdate")
    before = orders.filter(F.col("o_orderdate") < year_start(END, orders.schema["o_orderdate"].dataType))
    return contrasts.yearly_counts(before, calendar_part("year", "o_orderdate"), SPLIT)


@query(
    "welch_t",
    YEARLY_SQL
    + """,
    s AS (
        SELECT count(*) FILTER (label = 0) AS n0, avg(n) FILTER (label = 0) AS mean0,
               var_samp(n) FILTER (label = 0) AS v0,
               count(*) FILTER (label = 1) AS n1, avg(n) FILTER (label = 1) AS mean1,
               var_samp(n) FILTER (label = 1) AS v1
        FROM yearly)
    SELECT n0, round(mean0, 6) AS mean0, n1, round(mean1, 6) AS mean1,
           round((mean1 - mean0) / sqrt(v0 / n0 + v1 / n1), 6) AS t
    FROM s
    """,
)
def welch_t(spark: SparkSession, folder: str) -> DataFrame:
    result = contrasts.welch_t(_yearly(spark, folder), "n", "label")
    return result.withColumns({c: F.round(c, 6) for c in ("mean0", "mean1", "t")})


@query("chi_square", CHI_SQUARE_SQL + "SELECT round(statistic, 6) AS statistic, dof FROM result")
def chi_square(spark: SparkSession, folder: str) -> DataFrame:
    result = contrasts.chi_square(_yearly(spark, folder), "n", "label")
    return result.withColumn("statistic", F.round("statistic", 6))


@query(
    "chi_square_test",
    CHI_SQUARE_SQL
    + """
    SELECT round(statistic, 6) AS statistic, dof,
           round(1 - (SELECT sum(exp((dof / 2 + i) * ln(statistic / 2) - statistic / 2
                                     - lgamma(dof / 2 + i + 1)))
                      FROM range(500) AS r(i)), 6) AS p_value
    FROM result
    """,
)
def chi_square_test(spark: SparkSession, folder: str) -> DataFrame:
    result = contrasts.chi_square_test(_yearly(spark, folder), "n", "label")
    return result.withColumns({c: F.round(c, 6) for c in ("statistic", "p_value")})
