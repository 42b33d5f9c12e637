"""Arithmetic that yields null, not an error, on a zero divisor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percentage_error(predicted: Column, actual: Column) -> Column:
    """Absolute percentage error, null where the actual value is zero."""
    return F.lit(100.0) * F.abs(ratio(predicted - actual, actual))
