"""Apply a Python function to the texts of a table, a bounded slice of an Arrow batch at a time.

Such a step needs no shuffle, keeps nothing between rows but bounded caches, and is simply run again if its
executor is lost. A batch has ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows; lower it where single texts
reach hundreds of megabytes.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 8 << 20


ROOT = str(Path(__file__).resolve().parents[2])


def workers_import_this(spark: SparkSession) -> None:
    """Make this library importable in Python workers that see its folder.

    On a cluster that does not share the folder, install the library or ship it with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def fresh(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores behind it until no taken one is equal but for case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def with_plain_names(rows: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows with other names for columns that begin with an underscore, and a function that gives the names back.

    Operators that join the whole rows use such names for their own columns.
    """
    prefix = "own"
    while any(c.lower().startswith(prefix) for c in rows.columns):
        prefix += "x"
    plain = {c: f"{prefix}{i}" for i, c in enumerate(rows.columns) if c.startswith("_")}
    given = {new: old for old, new in plain.items()}

    def back(found: DataFrame) -> DataFrame:
        return found.select(*[F.col(f"`{c}`").alias(given.get(c, c)) for c in found.columns])

    return rows.select(*[F.col(f"`{c}`").alias(plain.get(c, c)) for c in rows.columns]), back


def map_batches(
    rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    workers_import_this(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each of about ``most`` bytes of the column, or of one row if that is longer."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    place = np.cumsum(lengths, dtype=np.int64) // most
    starts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
    for start, end in zip(starts, starts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def map_texts(
    rows: DataFrame,
    text: str,
    keep: tuple[str, ...],
    added: str,
    prepare: Callable[[], Callable[[list[str]], list]],
    most: int = SLICE_BYTES,
) -> DataFrame:
    """Columns ``keep`` and ``added`` (as DDL), the latter computed from the texts; a null text counts as empty.

    ``prepare`` runs once per task and returns the function, which takes a list of texts and returns a list of
    values for each added column. No other column of the rows is read, so extra ones cannot clash.
    """
    # The text travels under a name of its own: it may be one of the columns to keep.
    own = fresh("_text", keep)
    source = rows.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias(own))
    schema = T.StructType(source.schema.fields[:-1] + T._parse_datatype_string(added).fields)
    names = schema.names
    kinds = [_arrow_type(field.dataType) for field in schema.fields[len(keep):]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = prepare()
        for batch in batches:
            for part in slices(batch, own, most):
                values = function(part.column(own).to_pylist())
                new = [pa.array(v, kind) for v, kind in zip(values, kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], names)

    return map_batches(source, run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    return {
        T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.StringType: pa.string(),
        T.BooleanType: pa.bool_(),
    }[type(kind)]
