"""Running totals and row numbers that never sort a very large key in one task.

A window over a key sorts the key in one task, and a window without a key sorts everything in one. Here the rows are
dealt by range of the keys and the whole order into slices of even size, whatever the keys are. The totals of the
slices, a short list per key, are accumulated by a window of their own, and each slice is then accumulated by itself
on top of what came before it. There is one path for every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.sources.staging import materialise


def running_totals(
    rows: DataFrame, measures: dict[str, Column], order: list[Column], keys: tuple[str, ...] = ()
) -> DataFrame:
    """Add the total of each measure up to and including the row, per key, in ``order``, which must be total.

    The range bounds are sampled, so the sliced rows are written before they are read twice: a slice must be the same
    to its total and to its rows. There are at most ``spark.sql.shuffle.partitions`` slices, which bounds the windows
    over slice totals.
    """
    values = {f"_{m}": c for m, c in measures.items()}
    dealt = rows.withColumns(values).repartitionByRange(*[F.col(k) for k in keys], *order)
    fixed = materialise(dealt.withColumn("_slice", F.spark_partition_id()), "slices")
    grouping = [*keys, "_slice"]
    slices = fixed.groupBy(*grouping).agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        *[F.col(g).alias(f"_of_{g}") for g in grouping], *[F.sum(v).over(earlier).alias(f"{v}_before") for v in values]
    )
    # The shuffle of this join is also the one that the window over the slices needs.
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in keys] + [F.col("_slice") == F.col("_of__slice")]
    inside = Window.partitionBy(*grouping).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return fixed.join(offsets, same, "left").withColumns(
        {m: F.coalesce(f"_{m}_before", F.lit(0)) + F.sum(f"_{m}").over(inside) for m in measures}
    ).drop("_slice", *values, *[f"{v}_before" for v in values], *[f"_of_{g}" for g in grouping])


def numbered(rows: DataFrame, number: str, keys: tuple[str, ...], order: list[Column]) -> DataFrame:
    """Number the rows of each key from 1 in ``order``, which must be total."""
    return running_totals(rows, {number: F.lit(1)}, order, keys)


def placed(rows: DataFrame, *order: Column) -> DataFrame:
    """Add place, the number of the row in the order, which must be total: an order that a table can carry."""
    return numbered(rows, "place", (), list(order))
