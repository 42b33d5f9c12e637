"""Rows that boosted trees cannot tell apart, merged before they are fitted.

An estimator of trees asks a number only for its bin, of which it has 32, and a category only if its own draw of about
10,000 rows has it. Rows with equal bins, categories and labels have equal residuals in every round, so they are merged to one
row, a cell, with their number as its weight. The cells are bounded by bins and categories, not by the rows, and the trees
are those of the rows, but where two splits gain the same to the last digits, which the order of sums decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.base import Estimator
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from almanac.models.categories import BINS, EncodedModel, slotted, sparse, vectors, with_vectors
from almanac.sources.staging import FIT_PARTS, FIT_ROWS, fit_layout, materialise

WEIGHT = "weight"
# Least number of rows that are merged; a pass over fewer is cheaper than the cells.
MERGE_FROM = 1 << 20
# Rows that the estimator draws for the bounds of its bins, or the square of its bins if that is more.
DRAWN = 10_000
# The draw grows with the square of the bins, up to all cells. The square must fit a 32-bit number.
MOST_BINS = 46_340


def merges(estimator: Estimator, rows: int) -> bool:
    """Whether the trees of merged rows are those of the rows, and there are enough of them."""
    return rows >= MERGE_FROM and estimator.getSubsamplingRate() == 1.0 and estimator.getMinInstancesPerNode() == 1


@dataclass(frozen=True)
class Cells:
    """Bounds of the bins by number, and the slots of categories that a tree may ask for: slot."""

    bounds: dict[str, list[float]]
    slots: DataFrame

    def _binned(
        self, rows: DataFrame, index: DataFrame, numeric: list[str], categorical: list[str]
    ) -> tuple[DataFrame, list[str], Column]:
        """The rows with a bin for each number and a slot for each category, null if no tree asks for it."""
        joined, slots, size = slotted(rows, index, numeric, categorical)
        bins = [f"_bin_{i}" for i in range(len(numeric))]
        placed = joined.select(*rows.columns, *[slot.cast("int").alias(f"_all_{i}") for i, slot in enumerate(slots)])
        found = _with_bins(placed, {b: (c, self.bounds[c]) for b, c in zip(bins, numeric)})
        for i in range(len(slots)):
            own = self.slots.select(F.col("slot").alias(f"_own_{i}"))
            found = found.join(own, F.col(f"_all_{i}") == F.col(f"_own_{i}"), "left").drop(f"_all_{i}")
        return found, [*bins, *[f"_own_{i}" for i in range(len(slots))]], size

    def _vector(self, names: list[str], numeric: list[str], size: Column) -> Column:
        columns = [F.col(n) for n in names]
        return sparse(columns[:len(numeric)], columns[len(numeric):], size, some=True).alias(BINS)

    def encode(self, rows: DataFrame, index: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
        """Add the vectors of bins and write the rows."""
        found, names, size = self._binned(rows, index, numeric, categorical)
        return with_vectors(found.select(*rows.columns, self._vector(names, numeric, size)))

    def merge(
        self, rows: DataFrame, index: DataFrame, numeric: list[str], categorical: list[str], keys: list[str]
    ) -> DataFrame:
        """Equal rows as one, written: keys, weight, bins."""
        found, names, size = self._binned(rows.select(*keys, *numeric, *categorical), index, numeric, categorical)
        most = [len(self.bounds[c]) + 1 for c in numeric] + [len(numeric) + index.count() + len(categorical)] * len(categorical)
        packed = _pack(found, keys, dict(zip(names, most)))
        counted = packed.groupBy(*packed.columns).agg(F.count("*").alias(WEIGHT))
        places = _unpack(counted, [*keys, WEIGHT], dict(zip(names, most)), found.schema)
        return with_vectors(places.select(*keys, WEIGHT, self._vector(names, numeric, size)))


def _places(most: dict[str, int]) -> dict[str, tuple[str, int, int]]:
    """The long that holds each column, the bit that it starts at, and its mask; one more than a value is held, zero for null."""
    places, number, bit = {}, 0, 0
    for name, value in most.items():
        width = (value + 1).bit_length()
        if bit + width > 63:
            number, bit = number + 1, 0
        places[name] = (f"_packed_{number}", bit, (1 << width) - 1)
        bit += width
    return places


def _pack(rows: DataFrame, keep: list[str], most: dict[str, int]) -> DataFrame:
    """The kept columns, and those with whole numbers from 0 to the most given, or null, side by side in as few longs as hold them.

    Groups with such a key are smaller than with a column for each, so a task that meets many of them spills later.
    """
    packed = {}
    for name, (number, bit, _) in _places(most).items():
        held = F.shiftleft(F.coalesce(F.col(name).cast("long") + 1, F.lit(0)), bit)
        packed[number] = packed[number].bitwiseOR(held) if number in packed else held
    return rows.select(*keep, *[held.alias(number) for number, held in packed.items()])


def _unpack(packed: DataFrame, keep: list[str], most: dict[str, int], schema: StructType) -> DataFrame:
    """The kept columns, and those that were packed, of the types that they had."""
    columns = []
    for name, (number, bit, mask) in _places(most).items():
        held = F.shiftright(number, bit).bitwiseAND(F.lit(mask))
        columns.append(F.when(held > 0, held - 1).cast(schema[name].dataType).alias(name))
    return packed.select(*keep, *columns)


def _with_bins(rows: DataFrame, bins: dict[str, tuple[str, list[float]]]) -> DataFrame:
    """Add the number of the bin, from 1, of each column by its name. A bound belongs to the bin below it.

    The buckets of the library start at their bound, so they are those of the negative numbers.
    """
    cut = {name: (column, bounds) for name, (column, bounds) in bins.items() if bounds}
    rows = rows.withColumns({name: -F.col(column).cast("double") for name, (column, _) in cut.items()})
    if cut:
        sides = [[-math.inf, *[-b for b in reversed(bounds)], math.inf] for _, bounds in cut.values()]
        rows = Bucketizer(splitsArray=sides, inputCols=[*cut], outputCols=[f"{name}_" for name in cut]).transform(rows)
    found = {name: len(bounds) + 1 - F.col(f"{name}_") if bounds else F.lit(1.0) for name, (_, bounds) in bins.items()}
    return rows.withColumns(found).drop(*[f"{name}_" for name in cut])


def _bounds(counts: dict[float, int], expected: float, bins: int) -> list[float]:
    """Bounds of the bins of one number, halfway between drawn values, where the estimator puts them.

    ``counts`` has the drawn values other than zero, and ``expected`` is how many rows were to be drawn. The estimator takes
    what is missing for zeros.
    """
    drawn = sum(counts.values())
    if not drawn:
        return []
    if expected - drawn > 2.220446049250313e-16 * drawn * 100:
        counts = counts | {0.0: expected - drawn}
    values = sorted(counts)
    halves = [(a + b) / 2.0 for a, b in zip(values, values[1:])]
    if len(halves) < bins:
        return halves
    stride = expected / bins
    bounds, reached, target = [], counts[values[0]], stride
    for half, value in zip(halves, values[1:]):
        before, reached = reached, reached + counts[value]
        if abs(before - target) < abs(reached - target):
            bounds.append(half)
            target += stride
    return bounds


def _draw(dealt: DataFrame, share: float, seed: int) -> DataFrame:
    """The rows that an estimator with this seed draws from those that it is given."""
    if share >= 1.0:
        return dealt
    spark = dealt.sparkSession
    number = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    drawn = dealt._jdf.toJavaRDD().sample(False, share, number)
    return DataFrame(spark._jsparkSession.createDataFrame(drawn, dealt._jdf.schema()), spark)


def find_cells(
    estimator: Estimator, train: DataFrame, index: DataFrame, numeric: list[str], categorical: list[str], rows: int
) -> Cells:
    """The bins and categories that the estimator would find in the rows, whose number is given.

    Only the numbers and slots are dealt out for the draw, in the places that the encoded rows have in a fit.
    """
    bins = estimator.getMaxBins()
    share = min(1.0, max(bins * bins, DRAWN) / rows)
    vector = F.col("features")
    keep = [F.col(c).cast("double").alias(c) for c in numeric]
    slots = [f"_slot_{i}" for i in range(len(categorical))]
    keep += [F.get(vector["indices"], F.lit(len(numeric) + i)).alias(s) for i, s in enumerate(slots)]
    parts = max(FIT_PARTS, -(-rows // FIT_ROWS))
    dealt = fit_layout(vectors(train, index, numeric, categorical), parts=parts, keep=keep)
    drawn = materialise(_draw(dealt, share, estimator.getSeed()), "drawn")
    pairs = [F.struct(F.lit(c).alias("number"), F.col(c).alias("value")) for c in numeric]
    counted = (
        drawn.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter("value <> 0")
        .groupBy("number", "value").agg(F.count("*").alias("n"))
    )
    values = {c: {} for c in numeric}
    for r in counted.collect():
        values[r.number][r.value] = r.n
    return Cells(
        {c: _bounds(found, share * rows, min(bins, rows)) for c, found in values.items()},
        materialise(drawn.select(F.explode(F.array(*slots)).alias("slot")).distinct(), "slots"),
    )


def fit_merged(
    estimator: Estimator, rows: DataFrame, index: DataFrame, numeric: list[str], categorical: list[str], n: int
) -> tuple[EncodedModel, DataFrame]:
    """A model of the ``n`` training rows, and all rows, merged: part, label, weight, bins.

    The estimator gets as many bins as it takes to draw all cells, so that it finds the few that there are.
    """
    train = rows.filter(F.col("part") == "train")
    cells = find_cells(estimator, train, index, numeric, categorical, n)
    merged = cells.merge(rows, index, numeric, categorical, ["part", "label"])
    fitted = merged.filter(F.col("part") == "train")
    bins = math.isqrt(fitted.count()) + 1
    whole = estimator.copy({
        estimator.featuresCol: BINS, estimator.weightCol: WEIGHT,
        estimator.maxBins: max(estimator.getMaxBins(), min(bins, MOST_BINS)),
    })
    return EncodedModel(whole.fit(fit_layout(fitted)), index, numeric, categorical, cells), merged
