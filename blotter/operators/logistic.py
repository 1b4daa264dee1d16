"""Certificate of a fitted logistic regression.

A regularised logistic loss has one optimum, where its gradient is zero. The
gradient (and the Hessian) at any coefficients is one aggregate over the training
rows, which are first counted per distinct vector. From a model's coefficients,
Newton's steps lead to the optimum itself, so that a model is judged by its own
distance from it.

The loss is MLlib's: the mean log loss plus half ``reg`` times the sum of squared
coefficients of the standardised features (sample deviation); the intercept is
free.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTERCEPT = "(intercept)"


@dataclass
class Optimum:
    """``coefficients`` (intercept last) of the optimum over ``rows`` rows,
    the standardised features' deviations, the largest entry of the gradient at
    the start and there, and the steps it took."""

    rows: int
    coefficients: np.ndarray
    deviations: np.ndarray
    gradient_at_start: float
    gradient: float
    steps: int


def vector_cells(rows: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """(features, n, ones): rows and positives per distinct vector (array)."""
    return rows.groupBy(features).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col(label).cast("double")).alias("ones"))


def _terms(width: int, features: str) -> list[Column]:
    return [F.get(F.col(features), F.lit(j)) for j in range(width)] + [F.lit(1.0)]


def deviations(cells: DataFrame, width: int, features: str = "features") -> tuple[float, np.ndarray]:
    """(rows, sample deviation of each feature)."""
    x, n = _terms(width, features)[:-1], F.col("n")
    r = cells.agg(F.sum(n), *[F.sum(n * v) for v in x]).first()
    total = r[0] or 0.0
    if total < 2:
        return total, np.zeros(width)
    means = [v / total for v in r[1:]]
    s = cells.agg(*[F.sum(n * (v - F.lit(m)) ** 2) for v, m in zip(x, means, strict=True)]).first()
    return total, np.sqrt(np.array(s, float) / (total - 1))


def gradient_and_hessian(cells: DataFrame, at: Sequence[float], width: int, features: str = "features") -> tuple[np.ndarray, np.ndarray]:
    """Sums over rows, without the penalty; the intercept's entry is last."""
    x = _terms(width, features)
    margin = F.lit(0.0)
    for v, c in zip(x, at, strict=True):
        margin = margin + v * F.lit(float(c))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    named = cells.withColumn("__p", p)
    off, spread = F.col("n") * F.col("__p") - F.col("ones"), F.col("n") * F.col("__p") * (F.lit(1.0) - F.col("__p"))
    pairs = [(i, j) for i in range(width + 1) for j in range(i, width + 1)]
    r = named.agg(*[F.sum(off * v) for v in x], *[F.sum(spread * x[i] * x[j]) for i, j in pairs]).first()
    hessian = np.zeros((width + 1, width + 1))
    for (i, j), v in zip(pairs, r[width + 1 :], strict=True):
        hessian[i, j] = hessian[j, i] = v
    return np.array(r[: width + 1], float), hessian


def optimum(rows: DataFrame, start: Sequence[float], reg: float, features: str = "features", label: str = "label", tolerance: float = 1e-12, most: int = 25) -> Optimum:
    """The optimum over ``rows`` (features as an array), from ``start`` (the
    coefficients, intercept last). Gradients are per row and standardised
    feature. A feature without variance keeps coefficient 0."""
    cells = vector_cells(rows, features, label)
    width = len(start) - 1
    n, spread = deviations(cells, width, features)
    if n < 2:
        raise ValueError("an optimum needs two rows or more")
    unit = np.append(np.where(spread > 0, spread, 1.0), 1.0)
    used = np.append(spread > 0, True)
    penalty = np.append(reg * spread**2, 0.0)
    at = np.where(used, np.array(start, float), 0.0)
    first = last = 0.0
    for step in range(most + 1):
        sums, hessian = gradient_and_hessian(cells, at, width, features)
        gradient = sums / n + penalty * at
        last = float(np.abs(gradient / unit)[used].max())
        first = last if step == 0 else first
        if last <= tolerance or step == most:
            return Optimum(int(n), at, spread, first, last, step)
        full = hessian / n + np.diag(penalty)
        move = np.zeros(width + 1)
        move[used] = np.linalg.solve(full[np.ix_(used, used)], gradient[used])
        at = at - move
    raise AssertionError("unreachable")
