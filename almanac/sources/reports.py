"""Sinks. Every one is a distributed write; sorted rows keep their order across the numbered part files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def write_delimited(rows: DataFrame, path: str, header: bool = True) -> None:
    rows.write.mode("overwrite").csv(path, header=header, quote='"', escape='"')


def write_lines(rows: DataFrame, line: Column, path: str) -> None:
    """Write one text line per row."""
    rows.select(line.alias("value")).write.mode("overwrite").text(path)
