"""Summaries of groups of ten consecutive bars, given to the bars of the next group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP_SIZE = 10
# fixed values: output columns
SUMMARIES = ("profit_first", "profit_last", "profit_mean", "profit_std")


def bar_group(bar_num: Column) -> Column:
    """Bars 1 to 10 are group 0, 11 to 20 group 1, and so on; the division truncates."""
    return ((bar_num - 1) / F.lit(GROUP_SIZE)).cast("bigint")


def group_summaries(bars: DataFrame) -> DataFrame:
    """First, last, mean and standard deviation of the profit of every closed group, keyed by the next group.

    Only a group whose closing bar is present counts. At that bar a running window has seen the whole group,
    so the summaries are plain hash aggregates: they combine before the shuffle, and the shifted key lets the
    join that follows reuse the aggregate's partitioning. A bar number is expected once per trade; were it
    repeated, the group would still give one summary: its first profit is the least of the copies' and its last the
    greatest.
    """
    return (
        bars.groupBy("trade_id", (F.col("bar_group") + 1).alias("bar_group"))
        .agg(
            F.min_by("profit", F.struct("bar_num", "profit")).alias("profit_first"),
            F.max_by("profit", F.struct("bar_num", "profit")).alias("profit_last"),
            F.avg("profit").alias("profit_mean"),
            F.stddev_samp("profit").alias("profit_std"),
            F.max(F.col("bar_num") % GROUP_SIZE == 0).alias("closed"),
        )
        .filter("closed")
        .drop("closed")
    )


def with_previous_group(bars: DataFrame) -> DataFrame:
    """Left-join the summaries of the previous group onto every bar of a known trade.

    Both sides of the join read the bars under the same filter, so a shuffle below them happens once.
    """
    bars = bars.filter(F.col("trade_id").isNotNull())
    grouped = bars.withColumn("bar_group", bar_group(F.col("bar_num")))
    return grouped.join(group_summaries(grouped), ["trade_id", "bar_group"], "left")
