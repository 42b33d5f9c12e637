"""Column expressions shared by the operators."""

from almanac.functions.calendar import (
    BAR_TIME,
    INCIDENT_TIME,
    PARTS,
    calendar_part,
    parse_time,
    with_calendar,
    year_start,
)
from almanac.functions.numeric import percentage_error, ratio

__all__ = [
    "BAR_TIME",
    "INCIDENT_TIME",
    "PARTS",
    "calendar_part",
    "parse_time",
    "percentage_error",
    "ratio",
    "with_calendar",
    "year_start",
]
