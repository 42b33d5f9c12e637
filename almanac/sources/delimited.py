"""Delimited text with a header row.

Columns arrive as strings and are cast explicitly, so a file costs no inference pass. Quoted fields may hold
commas and doubled quotes. A header line repeated further down, as left behind by concatenating files, is
dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from almanac.functions.calendar import BAR_TIME, INCIDENT_TIME, parse_time

# The column names of the input files.
AREA_COLUMNS = ("CommunityNo", "Area_km2")
BAR_VARIABLES = tuple(f"var{i}{j}" for i in range(1, 9) for j in range(i + 1, 9))


def without_repeated_headers(rows: DataFrame, probe: tuple[str, ...] = ()) -> DataFrame:
    """Drop the rows in which every value, or every value of ``probe``, equals its column's name.

    A probe of key columns keeps the others prunable.
    """
    named = [F.col(f"`{c}`").eqNullSafe(F.lit(c)) for c in probe or rows.columns]
    return rows.filter(~reduce(Column.__and__, named))


def read_delimited(
    spark: SparkSession, path: str | list[str], *columns: str, probe: tuple[str, ...] = ()
) -> DataFrame:
    """Read all-string rows; only the named columns are parsed out of each line.

    The path may be of any file system that Spark can reach. The columns of the first file hold for all; a file with
    another order of columns fails the read.
    """
    rows = spark.read.csv(path, header=True, quote='"', escape='"', enforceSchema=False)
    if columns:
        rows = rows.select(*[F.col(f"`{c}`") for c in columns])
    return without_repeated_headers(rows, probe)


def read_checked(
    spark: SparkSession, path: str | list[str], *columns: str, probe: tuple[str, ...] = (), damaged: str = "damaged",
    names: tuple[str, ...] = (),
) -> DataFrame:
    """As ``read_delimited``, with the whole line in ``damaged`` where it has not as many fields as the header, else null.

    Damaged lines keep what could be read. Every line is parsed in full to see it, also where few columns are named.
    ``names`` are the columns of files without a header.
    """
    header = names or spark.read.csv(path, header=True, quote='"', escape='"', enforceSchema=False).columns
    schema = StructType([StructField(c, StringType()) for c in (*header, damaged)])
    rows = spark.read.option("columnPruning", False).csv(
        path, schema=schema, header=not names, quote='"', escape='"', enforceSchema=bool(names), mode="PERMISSIVE",
        columnNameOfCorruptRecord=damaged,
    )
    rows = without_repeated_headers(rows, probe or tuple(header))
    return rows.select(*[F.col(f"`{c}`") for c in columns or header], damaged)


def with_reason(rows: DataFrame, typed: dict[str, Column], damaged: str = "damaged") -> DataFrame:
    """Add the typed columns, and reason: "fields" for a damaged line, "values" where a value that is there has no type.

    ``typed`` are expressions over the raw columns of the same names. Sound lines have no reason, nor have empty values.
    """
    lost = reduce(Column.__or__, [F.col(f"`{name}`").isNotNull() & value.isNull() for name, value in typed.items()])
    reason = F.when(F.col(damaged).isNotNull(), "fields").when(lost, "values")
    return rows.select(*[value.alias(name) for name, value in typed.items()], reason.alias("reason"), damaged)


def damage_report(rows: DataFrame) -> DataFrame:
    """Number of lines by reason: reason ("sound" for those without one), n."""
    return rows.groupBy(F.coalesce("reason", F.lit("sound")).alias("reason")).agg(F.count("*").alias("n"))


def incident_columns() -> dict[str, Column]:
    """Typed columns of the incident file that may fail to be."""
    return {
        "ID": F.col("ID"), "Date": parse_time("Date", INCIDENT_TIME),
        "Arrest": F.when(F.col("Arrest") == "true", True).when(F.col("Arrest") == "false", False),
        "Year": F.col("Year").try_cast("int"),
    }


def read_incidents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Incident file, typed: id, time, block, beat, community, arrest, year.

    Columns that the caller does not use are pruned from the scan.
    """
    columns = ("ID", "Date", "Block", "Beat", "Community Area", "Arrest", "Year")
    rows = read_delimited(spark, path, *columns, probe=("ID",))
    return rows.select(
        F.col("ID").alias("id"),
        parse_time("Date", INCIDENT_TIME).alias("time"),
        F.col("Block").alias("block"),
        F.col("Beat").alias("beat"),
        F.col("Community Area").alias("community"),
        F.when(F.col("Arrest") == "true", True).when(F.col("Arrest") == "false", False).alias("arrest"),
        F.col("Year").try_cast("int").alias("year"),
    )


def read_areas(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Community areas: community, area."""
    rows = read_delimited(spark, path, *AREA_COLUMNS)
    return rows.select(
        F.col("CommunityNo").alias("community"),
        F.col("Area_km2").try_cast("double").alias("area"),
    )


def read_inspections(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Inspection file, all strings; which of its columns matter depends on the fleet file."""
    return read_delimited(spark, path)


def read_fleet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Fleet file, all strings."""
    return read_delimited(spark, path)


def read_bars(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trading bars, typed: trade_id, time, bar_num, profit and the 28 integer variables."""
    columns = ("trade_id", "time_stamp", "bar_num", "profit", *BAR_VARIABLES)
    rows = read_delimited(spark, path, *columns, probe=("trade_id",))
    return rows.select(
        F.col("trade_id").try_cast("int").alias("trade_id"),
        parse_time("time_stamp", BAR_TIME).alias("time"),
        F.col("bar_num").try_cast("int").alias("bar_num"),
        F.col("profit").try_cast("double").alias("profit"),
        *[F.col(c).try_cast("int").alias(c) for c in BAR_VARIABLES],
    )
