"""Tables that are replaced at once, on file systems and object stores alike.

Renaming a folder is no single act on an object store, and overwriting one shows readers neither the old nor the new
table for a while. Here every write goes to a folder of its own, and a small file beside names the one that counts. It is
replaced after the write has ended, so a write that fails, or a driver that is lost, changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from almanac.sources import files

CURRENT = "current"


def published(spark: SparkSession, path: str) -> str:
    """The folder of the table that was published last; pass it to any reader."""
    base = path.rstrip("/")
    name = files.get(spark, f"{base}/{CURRENT}")
    if not name:
        raise FileNotFoundError(f"nothing is published at {path}")
    return f"{base}/{name}"


def publish(rows: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> str:
    """Write the rows by ``write`` to a new folder below the path and make it the one that counts.

    The version before stays for those who still read it; older ones, and what failed writes left, are deleted. One
    writer at a time.
    """
    spark, base = rows.sparkSession, path.rstrip("/")
    before = files.get(spark, f"{base}/{CURRENT}")
    name = f"version-{uuid.uuid4().hex}"
    write(rows, f"{base}/{name}")
    files.put(spark, f"{base}/{CURRENT}", name)
    for other in files.names(spark, base):
        if other.startswith("version-") and other not in (name, before):
            files.delete(spark, f"{base}/{other}")
    return f"{base}/{name}"
