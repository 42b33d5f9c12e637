"""Categories of any number in a fit.

The categories of the training rows are counted and numbered in a table; the rows are joined to it, and the sparse feature
vectors are built in expressions. No list of categories passes through the driver. The encoded rows are written, as the
many passes of a fit read them, and are read back with their vectors.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.ml import Model
from pyspark.ml.base import Estimator
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.operators.running import numbered
from almanac.sources.staging import fit_layout, materialise

if TYPE_CHECKING:
    from almanac.models.cells import Cells

FEATURES = "features"
BINS = "bins"
OTHER = "__unknown"


def category_index(train: DataFrame, columns: list[str]) -> DataFrame:
    """Index of every category by column, most frequent first, ties by value: column, value, index.

    Nulls have no index of their own. All columns are counted in one aggregation, which combines before its shuffle.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    counted = (
        train.select(F.explode(F.array(*pairs)).alias("p")).select("p.column", "p.value").filter("value IS NOT NULL")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    ranked = numbered(counted, "index", ("column",), [F.desc("n"), F.asc("value")])
    return materialise(ranked.select("column", "value", (F.col("index") - 1).cast("int").alias("index")), "categories")


def _sizes(index: DataFrame, columns: list[str]) -> list[Column]:
    """Number of categories of each column, known when the query runs."""
    return [index.filter(F.col("column") == c).agg(F.count("*").cast("int").alias("n")).scalar() for c in columns]


def slotted(
    rows: DataFrame, index: DataFrame, numeric: list[str], categorical: list[str]
) -> tuple[DataFrame, list[Column], Column]:
    """The rows joined to their categories, the slot of each column, and the number of all slots.

    Each column is joined to its categories; a table of few is broadcast by the engine, and a category with too many of
    the rows is split by adaptive execution.
    """
    joined, slots, offset = rows, [], F.lit(len(numeric))
    for number, (column, size) in enumerate(zip(categorical, _sizes(index, categorical))):
        value, slot = f"_value_{number}", f"_slot_{number}"
        own = index.filter(F.col("column") == column).select(F.col("value").alias(value), F.col("index").alias(slot))
        joined = joined.join(own, F.col(column).cast("string") == F.col(value), "left").drop(value)
        slots.append(offset + F.coalesce(slot, size))
        offset = offset + size + 1
    return joined, slots, offset


def sparse(numbers: list[Column], slots: list[Column], size: Column, some: bool = False) -> Column:
    """The columns of a sparse vector, as it is stored: the numbers, then a one in each slot, with ``some`` in those not null."""
    ones = [F.when(slot.isNotNull(), 1.0) if some else F.lit(1.0) for slot in slots]
    places = [F.lit(i) for i in range(len(numbers))]
    if some:
        indices = F.concat(F.array(*places), F.array_compact(F.array(*slots)))
        values = F.concat(F.array(*numbers), F.array_compact(F.array(*ones)))
    else:
        indices, values = F.array(*places, *slots), F.array(*numbers, *ones)
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"), size.cast("int").alias("size"),
        indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"),
    )


def vectors(rows: DataFrame, index: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Add the stored columns of the feature vectors: the numbers, then a slot for each category and one for null and
    unseen ones, by column. Null numbers must have been dropped.
    """
    joined, slots, size = slotted(rows, index, numeric, categorical)
    vector = sparse([F.col(c).cast("double") for c in numeric], slots, size)
    return joined.select(*rows.columns, vector.alias(FEATURES))


def encode(rows: DataFrame, index: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Add the feature vectors and write the rows."""
    return with_vectors(vectors(rows, index, numeric, categorical))


def with_vectors(rows: DataFrame) -> DataFrame:
    """Write the rows and read them back with the stored columns of the vectors as vectors."""
    fields = [T.StructField(f.name, VectorUDT()) if f.name in (FEATURES, BINS) else f for f in rows.schema.fields]
    return materialise(rows, "encoded", schema=T.StructType(fields))


def feature_names(index: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Name of every slot of the vectors: slot, feature. A category is named after its column and value."""
    spark = index.sparkSession
    names = spark.createDataFrame(list(enumerate(numeric)), "slot int, feature string")
    offset = F.lit(len(numeric))
    for column, size in zip(categorical, _sizes(index, categorical)):
        own = index.filter(F.col("column") == column).select(
            (offset + F.col("index")).alias("slot"), F.concat(F.lit(f"{column}_vector_"), "value").alias("feature")
        )
        other = spark.range(1).select((offset + size).alias("slot"), F.lit(f"{column}_vector_{OTHER}").alias("feature"))
        names = names.unionByName(own).unionByName(other)
        offset = offset + size + 1
    return names


@dataclass(frozen=True)
class EncodedModel:
    """A fitted model and the categories that its features stand for; with ``cells`` it reads bins of the numbers."""

    fitted: Model
    index: DataFrame
    numeric: list[str]
    categorical: list[str]
    cells: Cells | None = None

    def encode(self, rows: DataFrame) -> DataFrame:
        if self.cells:
            return rows if BINS in rows.columns else self.cells.encode(rows, self.index, self.numeric, self.categorical)
        return rows if FEATURES in rows.columns else encode(rows, self.index, self.numeric, self.categorical)

    def transform(self, rows: DataFrame) -> DataFrame:
        """Predictions for the rows. Rows that are encoded already are neither joined nor shuffled."""
        return self.fitted.transform(self.encode(rows))

    def named(self, values: list[float], value: str) -> DataFrame:
        """feature and value of the slots, joined by their place."""
        frame = self.index.sparkSession.createDataFrame([(i, float(v)) for i, v in enumerate(values)], f"slot int, {value} double")
        return frame.join(feature_names(self.index, self.numeric, self.categorical), "slot").drop("slot")


def fit_encoded(
    estimator: Estimator, train: DataFrame, index: DataFrame, numeric: list[str], categorical: list[str],
    sampled: bool = True,
) -> EncodedModel:
    """Fit on encoded rows. An estimator that samples rows by their place gets a layout that depends on their values only."""
    return EncodedModel(estimator.fit(fit_layout(train) if sampled else train), index, numeric, categorical)
