"""Seasons, recent keys, calendar profiles and text files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import INCIDENT_TIME, calendar_part
from almanac.operators import counts, recency
from almanac.operators.running import placed
from almanac.plans.registry import query
from almanac.sources import (
    Run,
    Stage,
    damage_report,
    incident_columns,
    publish,
    published,
    read_checked,
    read_incidents,
    staging_path,
    table,
    with_reason,
    write_delimited,
    write_lines,
)


@query(
    "seasonal_average",
    """
    SELECT month, avg(n) AS avg_count
    FROM (SELECT year(o_orderdate) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                 count(DISTINCT o_orderkey) AS n
          FROM orders GROUP BY 1, 2)
    GROUP BY month ORDER BY month
    """,
)
def seasonal_average(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderdate")
    return counts.seasonal_average(
        orders, "o_orderkey", calendar_part("year", "o_orderdate"), calendar_part("month", "o_orderdate")
    )


@query(
    "seasonal_average_staged",
    """
    SELECT month, avg(n) AS avg_count
    FROM (SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(DISTINCT o_orderkey) AS n
          FROM orders GROUP BY year(o_orderdate), month(o_orderdate))
    GROUP BY month
    """,
)
def seasonal_average_staged(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a run of stages that could be resumed; the table between them is gone when the last is there."""
    monthly = Stage(
        "monthly",
        lambda orders: orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
            F.count_distinct("o_orderkey").alias("n")
        ),
        ("orders",),
    )
    average = Stage("average", lambda rows: rows.groupBy("month").agg(F.avg("n").alias("avg_count")), ("monthly",))
    run = Run(spark, staging_path(spark, "run"), [monthly, average], {"orders": f"{folder.rstrip('/')}/orders.parquet"})
    return run.result()


@query(
    "seasonal_average_sql",
    """
    SELECT month, avg(n) AS avg_count
    FROM (SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(DISTINCT o_orderkey) AS n
          FROM orders GROUP BY year(o_orderdate), month(o_orderdate))
    GROUP BY month
    """,
)
def seasonal_average_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The same through temporary views and SQL text. The views go once the text is analysed."""
    orders, monthly = (f"almanac_{name}_{uuid.uuid4().hex}" for name in ("orders", "monthly"))
    table(spark, folder, "orders").createTempView(orders)
    spark.sql(
        f"""
        SELECT month(o_orderdate) AS month, count(DISTINCT o_orderkey) AS n
        FROM {orders} GROUP BY year(o_orderdate), month(o_orderdate)
        """
    ).createTempView(monthly)
    result = spark.sql(f"SELECT month, avg(n) AS avg_count FROM {monthly} GROUP BY month ORDER BY month")
    for view in (monthly, orders):
        spark.catalog.dropTempView(view)
    return result


TOP_KEYS_SQL = """
    SELECT o_custkey, count(*) AS n
    FROM orders
    WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) FROM orders) - 2
    GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10
"""


@query("recent_topk", TOP_KEYS_SQL)
def recent_topk(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_custkey", "o_orderdate")
    return recency.top_keys(recency.recent_years(orders, "o_orderdate", 3), "o_custkey", 10)


@query("report_topk", f"SELECT o_custkey || ',' || n AS line FROM ({TOP_KEYS_SQL})")
def report_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The same result written as text lines and read back."""
    path = staging_path(spark, "report")
    write_lines(recent_topk(spark, folder), F.concat_ws(",", "o_custkey", "n"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def _profile_sql(part: str, expression: str) -> str:
    return f"""
    SELECT CAST({expression} AS INTEGER) AS {part}, count(event_id) AS n
    FROM events WHERE event_type = 'purchase' GROUP BY 1 ORDER BY 1
    """


def _purchases(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events", "event_id", "ts", "event_type")
    return events.filter(F.col("event_type") == "purchase")


def _filled(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that are filled; they lie in all months, while the events are of one."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderdate", "o_orderstatus")
    return orders.filter(F.col("o_orderstatus") == "F")


def _filled_sql(part: str, expression: str) -> str:
    return f"""
    SELECT CAST({expression} AS INTEGER) AS {part}, count(o_orderkey) AS n
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY 1
    """


@query("arrest_profile_month", _filled_sql("month", "month(o_orderdate)"))
def arrest_profile_month(spark: SparkSession, folder: str) -> DataFrame:
    return counts.calendar_profile(_filled(spark, folder), "o_orderkey", "o_orderdate", "month")


@query("arrest_profile_dow", _filled_sql("weekday", "dayofweek(o_orderdate) + 1"))
def arrest_profile_dow(spark: SparkSession, folder: str) -> DataFrame:
    return counts.calendar_profile(_filled(spark, folder), "o_orderkey", "o_orderdate", "weekday")


@query("arrest_profile_hour", _profile_sql("hour", "hour(ts)"))
def arrest_profile_hour(spark: SparkSession, folder: str) -> DataFrame:
    return counts.calendar_profile(_purchases(spark, folder), "event_id", "ts", "hour")


@query(
    "arrest_profiles",
    """
    SELECT part, CAST(value AS INTEGER) AS value, count(event_id) AS n
    FROM (SELECT event_id, unnest(['month', 'weekday', 'hour']) AS part,
                 unnest([month(ts), dayofweek(ts) + 1, hour(ts)]) AS value
          FROM events WHERE event_type = 'purchase')
    GROUP BY 1, 2
    """,
)
def arrest_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return counts.calendar_profiles(_purchases(spark, folder), "event_id", "ts", ("month", "weekday", "hour"))


ROUNDTRIP_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS time,
           o_custkey || ' "' || o_orderpriority || '", ST' AS block,
           o_orderstatus = 'F' AS arrest, CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders
"""


def _incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the layout of the incident file, with quotes and commas inside."""
    orders = table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("ID"),
        F.date_format("o_orderdate", INCIDENT_TIME).alias("Date"),
        F.concat("o_custkey", F.lit(' "'), "o_orderpriority", F.lit('", ST')).alias("Block"),
        F.lit("0714").alias("Beat"),
        F.lit("44").alias("Community Area"),
        (F.col("o_orderstatus") == "F").cast("string").alias("Arrest"),
        F.year("o_orderdate").cast("string").alias("Year"),
    )


def _with_stray_header(rows: DataFrame) -> DataFrame:
    return rows.unionByName(rows.sparkSession.range(1).select(*[F.lit(c).alias(c) for c in rows.columns]))


def _read_back(spark: SparkSession, path: str) -> DataFrame:
    back = read_incidents(spark, path)
    return back.select("id", F.col("time").cast("timestamp_ntz").alias("time"), "block", "arrest", "year")


@query("csv_roundtrip", ROUNDTRIP_SQL)
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as the incident file and read back."""
    path = staging_path(spark, "incidents")
    write_delimited(_with_stray_header(_incidents(spark, folder)), path)
    return _read_back(spark, path)


@query("csv_published", ROUNDTRIP_SQL)
def csv_published(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a file that is replaced at once: half of the orders are published first, then all."""
    path = staging_path(spark, "published")
    rows = _incidents(spark, folder)
    publish(rows.filter(F.col("ID").cast("bigint") % 2 == 0), path, write_delimited)
    publish(_with_stray_header(rows), path, write_delimited)
    return _read_back(spark, published(spark, path))


@query(
    "damaged_lines",
    """
    SELECT CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 1 THEN 'fields'
                WHEN o_orderkey % 83 = 2 OR o_orderkey % 79 = 3 THEN 'values' ELSE 'sound' END AS reason, count(*) AS n
    FROM orders GROUP BY 1
    """,
)
def damaged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as lines of the incident file, some with a field too few or too many, a false date or year; how many are found."""
    path = staging_path(spark, "damaged")
    key = F.col("ID").cast("bigint")
    quoted = F.concat(F.lit('"'), F.replace("Block", F.lit('"'), F.lit('""')), F.lit('"'))
    rows = _incidents(spark, folder)
    fields = [
        F.col("ID"), F.when(key % 83 == 2, "no date").otherwise(F.col("Date")), quoted, F.col("Beat"), F.col("Community Area"),
        F.col("Arrest"), F.when(key % 79 == 3, "MCMXCV").otherwise(F.col("Year")),
    ]
    short, long = F.concat_ws(",", *fields[:5]), F.concat_ws(",", *fields, F.lit("more"))
    line = F.when(key % 97 == 0, short).when(key % 89 == 1, long).otherwise(F.concat_ws(",", *fields))
    write_lines(rows, line, path)
    checked = read_checked(spark, path, probe=("ID",), names=tuple(rows.columns))
    return damage_report(with_reason(checked, incident_columns()))


@query(
    "arrest_profile_month_placed",
    """
    SELECT month, n, row_number() OVER (ORDER BY month) AS place FROM (
        SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(o_orderkey) AS n
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    """,
)
def arrest_profile_month_placed(spark: SparkSession, folder: str) -> DataFrame:
    """Filled orders by month with the place of each row in the order of the months."""
    profile = counts.calendar_profile(_filled(spark, folder), "o_orderkey", "o_orderdate", "month")
    return placed(profile, F.col("month")).select("month", "n", F.col("place").cast("bigint").alias("place"))
