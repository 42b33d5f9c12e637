"""Weekly order counts per nation: lag features, forecasts and their errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.models import forecast
from almanac.models.pipelines import coefficients
from almanac.operators import accuracy, counts
from almanac.operators.classes import with_part, with_part_by
from almanac.operators.lines import slice_line
from almanac.plans.registry import query
from almanac.plans.tree_sql import grown
from almanac.sources import materialise, staging_path, table, write_lines

LAGS_SQL = """
    WITH weekly AS (
        SELECT c_nationkey AS beat, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(week(o_orderdate) AS INTEGER) AS week, CAST(n_regionkey AS DOUBLE) AS area,
               count(o_orderkey) AS crimes, count(*) FILTER (o_orderstatus = 'F') AS arrests
        FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1, 2, 3, 4),
    lagged AS (
        SELECT *, CASE WHEN arrests > 0.5 * crimes THEN 'true' ELSE 'false' END AS violent,
               lag(crimes, 1) OVER w AS lag1, lag(crimes, 2) OVER w AS lag2,
               lag(crimes, 3) OVER w AS lag3, lag(crimes, 4) OVER w AS lag4,
               lead(crimes, 1) OVER w AS next_week
        FROM weekly WINDOW w AS (PARTITION BY beat ORDER BY year, week, area)),
    features AS (
        SELECT * FROM lagged WHERE beat IS NOT NULL AND year IS NOT NULL AND week IS NOT NULL
          AND area IS NOT NULL AND lag4 IS NOT NULL AND next_week IS NOT NULL)
"""

SPLIT_SQL = """
    WITH weekly_split AS (
        SELECT c_nationkey AS beat, o_orderstatus = 'F' AS arrest,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(week(o_orderdate) AS INTEGER) AS week,
               count(o_orderkey) AS crimes
        FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY 1, 2, 3, 4),
    lagged_split AS (
        SELECT *, lag(crimes, 1) OVER w AS lag1, lag(crimes, 2) OVER w AS lag2,
               lead(crimes, 1) OVER w AS next_week
        FROM weekly_split WINDOW w AS (PARTITION BY beat, arrest ORDER BY year, week)),
    features_split AS (
        SELECT * FROM lagged_split WHERE beat IS NOT NULL AND arrest IS NOT NULL AND year IS NOT NULL
          AND lag2 IS NOT NULL AND next_week IS NOT NULL)
"""

# Least squares on two lags, from centred moments.
LINEAR_SQL = (
    SPLIT_SQL
    + """,
    totals AS (
        SELECT beat, year, week, sum(crimes) AS crimes FROM weekly_split GROUP BY 1, 2, 3),
    lagged AS (
        SELECT *, lag(crimes, 1) OVER w AS lag1, lag(crimes, 2) OVER w AS lag2,
               lead(crimes, 1) OVER w AS next_week
        FROM totals WINDOW w AS (PARTITION BY beat ORDER BY year, week)),
    features AS (
        SELECT *, (beat + 53 * year + week) % 5 = 0 AS is_test FROM lagged
        WHERE beat IS NOT NULL AND year IS NOT NULL AND lag2 IS NOT NULL AND next_week IS NOT NULL),
    moments AS (
        SELECT avg(lag1) AS m1, avg(lag2) AS m2, avg(next_week) AS my,
               var_pop(lag1) AS s11, var_pop(lag2) AS s22, covar_pop(lag1, lag2) AS s12,
               covar_pop(lag1, next_week) AS s1y, covar_pop(lag2, next_week) AS s2y
        FROM features WHERE NOT is_test),
    slopes AS (
        SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
               (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2
        FROM moments),
    fit AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM slopes)
"""
)


def _weekly(spark: SparkSession, folder: str, keys: list[str], arrests: bool) -> DataFrame:
    """Orders per week and ``keys``, counted per customer before the customers are joined."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    customers = table(spark, folder, "customer", "c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation", "n_nationkey", "n_regionkey")
    places = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", F.col("c_nationkey").alias("beat"), F.col("n_regionkey").cast("double").alias("area")
    )
    own = [k for k in keys if k == "arrest"]
    per_customer = counts.weekly_counts(
        orders.withColumn("arrest", F.col("o_orderstatus") == "F"), ["o_custkey", *own], "o_orderkey", "o_orderdate",
        F.col("arrest") if arrests else None,
    )
    joined = per_customer.join(places, F.col("o_custkey") == F.col("c_custkey"))
    measures = ["crimes", "arrests"] if arrests else ["crimes"]
    return counts.sum_counts(joined, [*keys, "year", "week"], measures)


def _lags(spark: SparkSession, folder: str) -> DataFrame:
    weekly = counts.with_majority_flag(_weekly(spark, folder, ["beat", "area"], True))
    return counts.with_lags(weekly, ["beat"], ["year", "week", "area"], "crimes", 4, "next_week")


def _lags_by_arrest(spark: SparkSession, folder: str) -> DataFrame:
    weekly = _weekly(spark, folder, ["beat", "arrest"], False)
    return counts.with_lags(weekly, ["beat", "arrest"], ["year", "week"], "crimes", 2, "next_week")


def _linear_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Two lags of all orders; every fifth week of a nation is held out."""
    weekly = _weekly(spark, folder, ["beat"], False)
    rows = counts.with_lags(weekly, ["beat"], ["year", "week"], "crimes", 2, "next_week")
    week_number = F.col("beat") + 53 * F.col("year") + F.col("week")
    return materialise(with_part_by(rows, week_number % 5 == 0), "linear")


@query(
    "weekly_lags",
    LAGS_SQL
    + """
    SELECT beat, year, week, area, crimes, arrests, violent, lag1, lag2, lag3, lag4, next_week FROM features
    """,
)
def weekly_lags(spark: SparkSession, folder: str) -> DataFrame:
    return _lags(spark, folder)


@query(
    "weekly_lags_split",
    SPLIT_SQL + "SELECT beat, arrest, year, week, crimes, lag1, lag2, next_week FROM features_split",
)
def weekly_lags_split(spark: SparkSession, folder: str) -> DataFrame:
    return _lags_by_arrest(spark, folder)


@query(
    "mape_by_slice",
    LAGS_SQL
    + """
    SELECT CASE WHEN grouping(violent) = 1 THEN 'all' ELSE violent END AS slice, count(*) AS n,
           round(100 * sum(abs(crimes - next_week) / next_week) / count(*), 6) AS mape
    FROM features GROUP BY ROLLUP (violent)
    """,
)
def mape_by_slice(spark: SparkSession, folder: str) -> DataFrame:
    """Error of predicting that next week is like this one."""
    errors = accuracy.mape_by_slice(_lags(spark, folder), "crimes", "next_week", "violent")
    return errors.withColumn("mape", F.round("mape", 6))


@query(
    "report_mape",
    LAGS_SQL
    + """,
    slices AS (
        SELECT CASE WHEN grouping(violent) = 1 THEN 'all' ELSE violent END AS slice,
               round(100 * sum(abs(crimes - next_week) / next_week) / count(*), 6) AS mape
        FROM features GROUP BY ROLLUP (violent))
    SELECT CASE slice WHEN 'all' THEN 'Overall MAPE' WHEN 'true' THEN 'MAPE for Violent Crimes'
                      ELSE 'MAPE for non-Violent Crimes' END || ': ' || CAST(mape AS VARCHAR) AS line
    FROM slices
    """,
)
def report_mape(spark: SparkSession, folder: str) -> DataFrame:
    """The errors by slice as text lines, written and read back."""
    path = staging_path(spark, "report")
    write_lines(mape_by_slice(spark, folder), slice_line(), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "forecast_linear",
    LINEAR_SQL
    + """,
    predicted AS (
        SELECT 'all' AS slice, next_week, b0 + b1 * lag1 + b2 * lag2 AS prediction
        FROM features, fit WHERE is_test
        UNION ALL
        SELECT CAST(arrest AS VARCHAR), next_week, b0 + b1 * lag1 + b2 * lag2 FROM features_split, fit)
    SELECT slice, count(*) AS n, round(100 * sum(abs(prediction - next_week) / next_week) / count(*), 6) AS mape
    FROM predicted GROUP BY slice
    """,
)
def forecast_linear(spark: SparkSession, folder: str) -> DataFrame:
    rows = _linear_rows(spark, folder)
    errors = forecast.linear_errors(forecast.fit_linear(rows), rows, _lags_by_arrest(spark, folder))
    return errors.withColumn("mape", F.round("mape", 6))


@query(
    "forecast_linear_coefficients",
    LINEAR_SQL
    + """
    SELECT 'lag2' AS term, round(b2, 6) AS coefficient FROM fit
    UNION ALL SELECT 'lag1', round(b1, 6) FROM fit
    UNION ALL SELECT 'intercept', round(b0, 6) FROM fit
    """,
)
def forecast_linear_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    rows = _linear_rows(spark, folder)
    terms = coefficients(forecast.fit_linear(rows), rows)
    return terms.withColumn("coefficient", F.round("coefficient", 6))


TREE_LAGS = ["lag4", "lag3", "lag2", "lag1", "area"]
TREE_ROWS = f"""
    {LAGS_SQL}
    SELECT 0 AS g, (beat + 53 * year + week) % 5 <> 0 AS train, CAST(next_week AS DOUBLE) AS y, violent, {", ".join(TREE_LAGS)}
    FROM features
"""


@query(
    "forecast_tree",
    grown(TREE_ROWS, TREE_LAGS, 2, ("violent",)) + """
    SELECT CASE WHEN grouping(violent) = 1 THEN 'all' ELSE violent END AS slice, count(*) AS n,
           round(100 * sum(abs(mean - y) / y) / count(*), 6) AS mape
    FROM rows_2 r JOIN leaves l ON r.node = l.node WHERE NOT train GROUP BY ROLLUP (violent)
    """,
)
def forecast_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The forecast by one tree of two levels, which SQL can grow too; every fifth week of a nation is held out."""
    week_number = F.col("beat") + 53 * F.col("year") + F.col("week")
    rows = materialise(with_part_by(_lags(spark, folder), week_number % 5 == 0), "tree")
    return forecast.forest_errors(forecast.fit_tree(rows, 2), rows).withColumn("mape", F.round("mape", 6))


@query("forecast_forest")
def forecast_forest(spark: SparkSession, folder: str) -> DataFrame:
    rows = materialise(with_part(_lags(spark, folder), ["beat", "year", "week", "area"]), "forest")
    return forecast.forest_errors(forecast.fit_forest(rows), rows)
