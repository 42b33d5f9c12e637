"""Rows prepared for classification, and deterministic train/test parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.operators.hot_joins import spread_join

# fixed values: input columns
NUMERIC = ("time_weight", "purchase_price", "model_year")
CATEGORICAL = ("state", "manufacturer")


def label_features(
    inspections: DataFrame, fleet: DataFrame, inspection_key: str, fleet_key: str, carry: tuple[str, ...] = (),
    spread: bool = False,
) -> DataFrame:
    """Join inspections to their trucks; the label is 1 where ``basic`` is present.

    No hint: the engine broadcasts the fleet only below its own size limit, and otherwise splits a truck that
    holds too many of the rows at run time, which nothing after the join stands in the way of. With ``spread`` the trucks
    with many rows are found beforehand and split whatever the engine's limits are.
    """
    fleet = fleet.withColumnRenamed(fleet_key, "_fleet_key")
    if spread:
        joined = spread_join(inspections, fleet, [inspection_key], ["_fleet_key"])
    else:
        joined = inspections.join(fleet, inspections[inspection_key] == F.col("_fleet_key"))
    return joined.select(
        *carry,
        *[F.col(c).try_cast("double").alias(c) for c in NUMERIC],
        *CATEGORICAL,
        F.when(F.col("basic").isNull(), 0).otherwise(1).alias("label"),
    )


def with_part(rows: DataFrame, keys: list[str], train_share: float = 0.8) -> DataFrame:
    """Add part, "train" or "test", drawn from a hash of the keys.

    Unlike a random split it does not depend on how the rows are partitioned or read.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(10_000))
    return with_part_by(rows, bucket >= round(train_share * 10_000))


def with_part_by(rows: DataFrame, is_test: Column) -> DataFrame:
    """Add part from a condition for the test rows."""
    return rows.withColumn("part", F.when(is_test, "test").otherwise("train"))
