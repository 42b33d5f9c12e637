"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Read one table, restricted to the named columns if there are any."""
    rows = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return rows.select(*columns) if columns else rows
