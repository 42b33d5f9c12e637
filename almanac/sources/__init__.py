"""Readers and writers."""

from almanac.sources.delimited import (
    damage_report,
    incident_columns,
    read_areas,
    read_bars,
    read_checked,
    read_delimited,
    read_fleet,
    read_incidents,
    read_inspections,
    with_reason,
    without_repeated_headers,
)
from almanac.sources.published import publish, published
from almanac.sources.reports import write_delimited, write_lines
from almanac.sources.runs import Run, Stage
from almanac.sources.staging import discard, fit_layout, materialise, owned_staging, staging_path
from almanac.sources.tables import table

__all__ = [
    "Run",
    "Stage",
    "damage_report",
    "discard",
    "fit_layout",
    "incident_columns",
    "materialise",
    "owned_staging",
    "publish",
    "published",
    "read_areas",
    "read_bars",
    "read_checked",
    "read_delimited",
    "read_fleet",
    "read_incidents",
    "read_inspections",
    "staging_path",
    "table",
    "with_reason",
    "without_repeated_headers",
    "write_delimited",
    "write_lines",
]
