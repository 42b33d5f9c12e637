"""Counts by key and by calendar part.

All counts are additive, so rows may be counted by a finer key first and summed afterwards. Counting below a
join on the join's own key keeps a key that holds a third of the rows from travelling through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions.calendar import calendar_part


def seasonal_average(rows: DataFrame, identity: str, year: Column, month: Column) -> DataFrame:
    """Average over the years of the distinct ids per month: month, avg_count.

    The divisor is the number of years in which the month occurs; a missing month is not a zero. The distinct
    count shuffles on (year, month, id), so a month with many ids is spread over all tasks.
    """
    monthly = (
        rows.select(year.alias("year"), month.alias("month"), F.col(identity).alias("id"))
        .groupBy("year", "month")
        .agg(F.countDistinct("id").alias("n"))
    )
    return monthly.groupBy("month").agg(F.avg("n").alias("avg_count")).orderBy("month")


def calendar_profile(rows: DataFrame, identity: str, time: str, part: str) -> DataFrame:
    """Rows with an id per calendar part, sorted by it: <part>, n."""
    return (
        rows.groupBy(calendar_part(part, time).alias(part))
        .agg(F.count(identity).alias("n"))
        .orderBy(part)
    )


def calendar_profiles(rows: DataFrame, identity: str, time: str, parts: tuple[str, ...]) -> DataFrame:
    """Several profiles from one scan: part, value, n.

    The rows are counted once by the combination of all parts, a few thousand cells whatever the input, and
    every profile is a sum over those cells.
    """
    cells = rows.groupBy(*[calendar_part(p, time).alias(p) for p in parts]).agg(F.count(identity).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("value")) for p in parts]))
    return (
        cells.select(each.alias("cell"), "n")
        .groupBy("cell.part", "cell.value")
        .agg(F.sum("n").alias("n"))
        .orderBy("part", "value")
    )


def weekly_counts(
    rows: DataFrame, keys: list[str], identity: str, time: str, arrest: Column | None = None
) -> DataFrame:
    """Rows with an id per key, year and week: keys, year, week, crimes and, if asked for, arrests."""
    measures = [F.count(identity).alias("crimes")]
    if arrest is not None:
        measures.append(F.count_if(arrest).alias("arrests"))
    return rows.groupBy(
        *keys, calendar_part("year", time).alias("year"), calendar_part("week", time).alias("week")
    ).agg(*measures)


def sum_counts(counts: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Roll counts up to coarser keys."""
    return counts.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def with_majority_flag(counts: DataFrame) -> DataFrame:
    """Add violent: "true" where more than half of the crimes led to an arrest, else "false"."""
    majority = F.col("arrests") > F.lit(0.5) * F.col("crimes")
    return counts.withColumn("violent", F.when(majority, "true").otherwise("false"))


def with_lags(
    counts: DataFrame, partition: list[str], order: list[str], value: str, lags: int, lead: str
) -> DataFrame:
    """Add lag1..lagN and the following value, by row rather than by calendar week.

    Rows with a null anywhere go afterwards: the first ``lags`` and the last of each partition, and those
    whose keys are unknown. The input is one row per key and week, so a partition stays as short as the
    calendar is, however many rows were counted into it.
    """
    window = Window.partitionBy(*partition).orderBy(*order)
    shifted = {f"lag{i}": F.lag(value, i).over(window) for i in range(1, lags + 1)}
    shifted[lead] = F.lead(value, 1).over(window)
    return counts.withColumns(shifted).na.drop("any")
