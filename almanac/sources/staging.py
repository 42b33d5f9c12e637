"""Written tables between two stages of a job.

Iterative work reads its input many times. A written table serves those passes without recomputing the joins
and aggregates before it, and unlike a cache it outlives the executors that wrote it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from almanac.sources import files

_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)
# Rows of a part that a model is fitted on, about, and least number of parts. The cluster has no say in them.
FIT_ROWS = 1 << 18
FIT_PARTS = 8


def staging_base(spark: SparkSession) -> str:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that ``spark.checkpoint.dir`` names, else below the warehouse.

    Both are shared by all executors, whatever the master is. Inside ``owned_staging`` the folder is deleted at
    its end, elsewhere when the application ends.
    """
    path = f"{staging_base(spark).rstrip('/')}/almanac/{name}-{uuid.uuid4().hex}"
    owned = _OWNED.get()
    if owned is None:
        files.delete_on_exit(spark, path)
    else:
        owned.append(path)
    return path


@contextmanager
def owned_staging(spark: SparkSession) -> Iterator[None]:
    """Delete every folder that was staged in the block at its end, also after a failure."""
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    files.delete(spark, path)


def materialise(
    rows: DataFrame, name: str, partition_by: tuple[str, ...] = (), schema: StructType | None = None
) -> DataFrame:
    """Write the rows as Parquet and read them back, as ``schema`` if given.

    With ``partition_by`` the rows are rebalanced first: each folder gets files of the advisory size, a small
    one a single file, and a hot one is split over several tasks.
    """
    spark = rows.sparkSession
    path = staging_path(spark, name)
    if partition_by:
        rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        rows.write.parquet(path)
    return spark.read.schema(schema or rows.schema).parquet(path)


def fit_layout(
    rows: DataFrame, *key: str | Column, parts: int | None = None, keep: list[Column] | None = None
) -> DataFrame:
    """The rows in a layout that depends on nothing but their values and ``parts``, by default as their number needs.

    They are dealt out by a hash of the whole row, so no hot value of a column meets in one task, and sorted inside
    by the key and the hash. A forest samples rows by their place, so this fixes its trees on any cluster. With ``keep``
    only these columns are dealt out, in the places of the whole rows.
    """
    if parts is None:
        parts = max(FIT_PARTS, -(-rows.count() // FIT_ROWS))
    dealt = rows.withColumn("_hash", F.xxhash64(*rows.columns))
    if keep:
        dealt = dealt.select(*keep, "_hash")
    return dealt.repartition(parts, "_hash").sortWithinPartitions(*key, "_hash").drop("_hash")
