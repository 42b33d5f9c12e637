"""Line items as trading bars: a supplier is a trade, its line items in shipping order are its bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import with_calendar
from almanac.models import walkforward
from almanac.operators import folds
from almanac.operators.bars import SUMMARIES, with_previous_group
from almanac.operators.lines import fold_lines
from almanac.operators.running import numbered
from almanac.plans.registry import query
from almanac.plans.tree_sql import grown
from almanac.sources import table

VARIABLES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
ORDER = [
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]


def _profit() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def _bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars numbered within their supplier."""
    rows = table(spark, folder, "lineitem", "l_suppkey", *ORDER).withColumnRenamed("l_suppkey", "trade_id")
    order = [F.col(c) for c in ORDER]
    return numbered(rows, "bar_num", ("trade_id",), order).withColumn("profit", _profit())


def _months(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem", "l_shipdate", "l_extendedprice", "l_discount")
    return with_calendar(rows, "l_shipdate", "year", "month").select("year", "month", _profit().alias("profit"))


@query(
    "bar_group_features",
    """
    WITH bars AS (
        SELECT l_suppkey AS trade_id, l_extendedprice * (1 - l_discount) AS profit,
               row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber,
                    l_partkey, l_quantity, l_extendedprice, l_discount, l_tax) AS bar_num
        FROM lineitem),
    grouped AS (SELECT *, (bar_num - 1) // 10 AS bar_group FROM bars),
    summaries AS (
        SELECT trade_id, bar_group + 1 AS bar_group, first(profit ORDER BY bar_num) AS profit_first,
               last(profit ORDER BY bar_num) AS profit_last, avg(profit) AS profit_mean,
               stddev_samp(profit) AS profit_std
        FROM grouped GROUP BY 1, 2 HAVING count(*) FILTER (bar_num % 10 = 0) > 0)
    SELECT trade_id, bar_num, bar_group, profit, profit_first, profit_last,
           round(profit_mean, 6) AS profit_mean, round(profit_std, 6) AS profit_std
    FROM grouped LEFT JOIN summaries USING (trade_id, bar_group)
    """,
)
def bar_group_features(spark: SparkSession, folder: str) -> DataFrame:
    bars = _bars(spark, folder).select("trade_id", "bar_num", "profit")
    return with_previous_group(bars).withColumns(
        {"profit_mean": F.round("profit_mean", 6), "profit_std": F.round("profit_std", 6)}
    )


# January is the test month of a second half; a fold needs rows to train on and rows to test on.
FOLDS_SQL = """
    WITH months AS (
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year, month(l_shipdate) AS month,
               l_extendedprice * (1 - l_discount) AS profit
        FROM lineitem),
    roles AS (
        SELECT year AS fold_year, CASE WHEN month <= 6 THEN 1 ELSE 2 END AS half, 'train' AS role, profit
        FROM months
        UNION ALL SELECT year, 1, 'test', profit FROM months WHERE month = 7
        UNION ALL SELECT year - 1, 2, 'test', profit FROM months WHERE month = 1),
    chosen AS (
        SELECT * FROM roles WHERE (fold_year, half) IN (
            SELECT (fold_year, half) FROM roles GROUP BY fold_year, half HAVING count(DISTINCT role) = 2)),
    means AS (
        SELECT fold_year, half, avg(profit) AS mean FROM chosen WHERE role = 'train' GROUP BY 1, 2),
    errors AS (
        SELECT fold_year, half, avg(100 * abs((mean - profit) / nullif(profit, 0))) AS mape
        FROM chosen JOIN means USING (fold_year, half) WHERE role = 'test' GROUP BY 1, 2)
"""


@query("walk_forward_folds", FOLDS_SQL + "SELECT fold_year, half, role, count(*) AS n FROM chosen GROUP BY 1, 2, 3")
def walk_forward_folds(spark: SparkSession, folder: str) -> DataFrame:
    months = _months(spark, folder)
    return folds.fold_sizes(months, folds.present_folds(months))


def _baseline(spark: SparkSession, folder: str) -> DataFrame:
    months = _months(spark, folder)
    return folds.baseline_errors(months, folds.present_folds(months), "profit")


@query("walk_forward_baseline", FOLDS_SQL + "SELECT fold_year, half, round(mape, 6) AS mape FROM errors")
def walk_forward_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return _baseline(spark, folder).withColumn("mape", F.round("mape", 6))


@query(
    "walk_forward_summary",
    FOLDS_SQL
    + """
    SELECT round(avg(mape), 6) AS average, round(min(mape), 6) AS minimum, round(max(mape), 6) AS maximum
    FROM errors
    """,
)
def walk_forward_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = folds.fold_summary(_baseline(spark, folder))
    return summary.select(*[F.round(c, 6).alias(c) for c in summary.columns])


@query("walk_forward_forest")
def walk_forward_forest(spark: SparkSession, folder: str) -> DataFrame:
    bars = with_calendar(with_previous_group(_bars(spark, folder)), "l_shipdate", "year", "month")
    features = [*VARIABLES, *SUMMARIES]
    months = walkforward.stage_months(bars, features, "profit")
    return walkforward.forest_errors(months, features, "profit", folds.present_folds(months))


TREE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
FOLD_ROWS = f"""
    WITH months AS (
        SELECT *, year(l_shipdate) AS year, month(l_shipdate) AS month, l_extendedprice * (1 - l_discount) AS profit
        FROM lineitem)
    SELECT 2 * year + CASE WHEN month > 6 THEN 2 ELSE 1 END AS g, true AS train, profit AS y, {", ".join(TREE_FEATURES)}
    FROM months
    UNION ALL
    SELECT CASE month WHEN 7 THEN 2 * year + 1 ELSE 2 * year END, false, profit, {", ".join(TREE_FEATURES)}
    FROM months WHERE month IN (1, 7)
"""


@query(
    "walk_forward_tree",
    grown(FOLD_ROWS, TREE_FEATURES, 2) + """
    SELECT CAST((r.g - 1) // 2 AS INTEGER) AS fold_year, CAST((r.g - 1) % 2 + 1 AS INTEGER) AS half,
           round(avg(100 * abs((mean - y) / y)), 6) AS mape
    FROM rows_2 r JOIN leaves l ON r.g = l.g AND r.node = l.node WHERE NOT train GROUP BY r.g
    """,
)
def walk_forward_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The walk-forward evaluation with one tree of two levels for each fold, which SQL can grow too."""
    items = table(spark, folder, "lineitem", *TREE_FEATURES, "l_extendedprice", "l_shipdate")
    profit = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    bars = with_calendar(items.withColumn("profit", profit), "l_shipdate", "year", "month")
    months = walkforward.stage_months(bars, TREE_FEATURES, "profit")
    errors = walkforward.forest_errors(
        months, TREE_FEATURES, "profit", folds.present_folds(months), numTrees=1, bootstrap=False, maxDepth=2, maxBins=64,
        featureSubsetStrategy="all",
    )
    return errors.withColumn("mape", F.round("mape", 6))


@query(
    "report_folds",
    FOLDS_SQL
    + """
    SELECT printf('%s Half of Year %d, MAPE: %.2f', CASE half WHEN 1 THEN 'First' ELSE 'Second' END, fold_year, mape) AS line
    FROM errors
    UNION ALL SELECT printf('Average MAPE: %.2f', avg(mape)) FROM errors
    UNION ALL SELECT printf('Minimum MAPE: %.2f', min(mape)) FROM errors
    UNION ALL SELECT printf('Maximum MAPE: %.2f', max(mape)) FROM errors
    """,
)
def report_folds(spark: SparkSession, folder: str) -> DataFrame:
    """The error of every fold and their summary as lines of text."""
    return fold_lines(_baseline(spark, folder))
