"""Logistic regression by Newton steps over grouped cross-product sums.

A step is one aggregation of the rows: the gradient and the matrix of second derivatives, (k + 1)^2 sums for k features,
which combine before their shuffle. Only these come to the driver. Apart from the estimate it gives standard errors,
which the library's own estimator does not, and it is an independent check of that one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_STEPS = 30
TOLERANCE = 1e-12


def _sums(rows: DataFrame, design: list[Column], y: Column, weight: Column, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and negative second derivatives of the log-likelihood."""
    k = len(design)
    score = sum((F.lit(float(w)) * x for w, x in zip(weights, design)), F.lit(0.0))
    p = 1 / (1 + F.exp(-score))
    step = rows.select(*[x.alias(f"x{i}") for i, x in enumerate(design)], (weight * (y - p)).alias("r"), (weight * p * (1 - p)).alias("v"))
    first = [F.sum(F.col("r") * F.col(f"x{i}")) for i in range(k)]
    second = [F.sum(F.col("v") * F.col(f"x{i}") * F.col(f"x{j}")) for i in range(k) for j in range(i, k)]
    found = [v or 0.0 for v in step.agg(*first, *second).head()]
    matrix = np.zeros((k, k))
    matrix[np.triu_indices(k)] = found[k:]
    return np.array(found[:k]), matrix + np.triu(matrix, 1).T


def logistic_newton(
    rows: DataFrame, features: list[str], label: str, weight: str | None = None, steps: int = MOST_STEPS
) -> DataFrame:
    """Coefficients without a penalty: term, coefficient, std_error, the intercept last.

    ``label`` is 0 or 1; ``weight`` counts equal rows. Rows with a null count for nothing. Features are centred and scaled for
    the steps, from sums of their own, so their units do not matter. A constant feature, or a label that the features tell
    exactly, has no estimate: the coefficient is the last one reached and its error is null where it is not finite.
    """
    spark = rows.sparkSession
    terms = [*features, "intercept"]
    count = F.col(weight).cast("double") if weight else F.lit(1.0)
    known = rows.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_y"), count.alias("_n")).na.drop("any")
    moments = [m for f in features for m in (F.sum(F.col("_n") * F.col(f)), F.sum(F.col("_n") * F.col(f) * F.col(f)))]
    total, *found = known.agg(F.sum("_n"), *moments).head()
    if not total:
        return spark.createDataFrame([], "term string, coefficient double, std_error double")
    mean = np.array(found[::2]) / total
    scale = np.sqrt(np.maximum(np.array(found[1::2]) / total - mean**2, 0))
    scale[scale == 0] = 1.0
    design = [(F.col(f) - float(m)) / float(s) for f, m, s in zip(features, mean, scale)] + [F.lit(1.0)]
    weights = np.zeros(len(design))
    for _ in range(steps):
        gradient, matrix = _sums(known, design, F.col("_y"), F.col("_n"), weights)
        move = np.linalg.lstsq(matrix, gradient, rcond=None)[0]
        weights = weights + move
        if np.abs(move).max() < TOLERANCE:
            break
    _, matrix = _sums(known, design, F.col("_y"), F.col("_n"), weights)
    # Back to the units of the features: the intercept takes up what was taken off as means.
    back = np.diag([*(1 / scale), 1.0])
    back[-1, :-1] = -mean / scale
    with np.errstate(all="ignore"):
        spread = np.sqrt(np.diag(back @ np.linalg.pinv(matrix) @ back.T))
    listed = [(t, float(c), float(s) if np.isfinite(s) and s > 0 else None) for t, c, s in zip(terms, back @ weights, spread)]
    return spark.createDataFrame(listed, "term string, coefficient double, std_error double")
