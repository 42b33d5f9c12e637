"""Calendar expressions. All of them run inside the JVM and none of them raises on a bad date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# The time formats of the input files.
INCIDENT_TIME = "MM/dd/yyyy hh:mm:ss a"
BAR_TIME = "yyyy-MM-dd HH:mm:ss"

PARTS = {
    "year": F.year,
    "month": F.month,
    # ISO week next to the calendar year: 1 January 2016 is (2016, 53).
    "week": F.weekofyear,
    # 1 is Sunday.
    "weekday": F.dayofweek,
    "hour": F.hour,
}


def parse_time(column: Column | str, pattern: str) -> Column:
    """Parse a time; an unreadable one becomes null instead of failing the job."""
    return F.try_to_timestamp(F.col(column) if isinstance(column, str) else column, F.lit(pattern))


def calendar_part(part: str, column: Column | str) -> Column:
    return PARTS[part](column)


def with_calendar(rows: DataFrame, time: str, *parts: str) -> DataFrame:
    """Add one integer column per calendar part, named after the part."""
    return rows.withColumns({part: calendar_part(part, time) for part in parts})


def year_start(year: int, data_type: DataType) -> Column:
    """First instant of a year as a literal of the column's own type, so that comparisons reach the scan."""
    return F.lit(f"{year:04d}-01-01 00:00:00").cast(data_type)
