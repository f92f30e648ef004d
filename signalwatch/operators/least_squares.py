"""Linear models from second moments: one aggregation, whatever the number of rows or models.

Means and covariances of a few columns tell the coefficients of every model over some of them, and
its squared error on any rows whose moments are known.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """Number of rows, and means and population covariances of the columns."""

    columns: tuple[str, ...]
    n_rows: int
    mean: np.ndarray
    cov: np.ndarray

    def pick(self, names: Sequence[str]) -> list[int]:
        return [self.columns.index(name) for name in names]


@dataclass(frozen=True)
class Linear:
    """``base`` plus each feature times its weight."""

    names: tuple[str, ...]
    base: float
    weights: tuple[float, ...]

    def predict(self, *values: Column) -> Column:
        out = F.lit(self.base)
        for weight, value in zip(self.weights, values or map(F.col, self.names)):
            out = out + F.lit(weight) * value
        return out


def moments(rows: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> dict[tuple, Moments]:
    """Moments for each group of ``by`` (one, named by an empty tuple, without). Rows with a null in
    any of the columns do not count."""
    k = len(columns)
    whole = rows.na.drop(subset=list(columns)).select(
        *by, *[F.col(c).cast("double").alias(c) for c in columns])
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    found = whole.groupBy(*by).agg(
        F.count("*").alias("_n"), F.array(*[F.avg(c) for c in columns]).alias("_mean"),
        F.array(*[F.covar_pop(columns[i], columns[j]) for i, j in pairs]).alias("_cov"))
    out = {}
    for row in found.collect():  # one row for each group
        if not row["_n"]:
            continue
        cov = np.zeros((k, k))
        for (i, j), value in zip(pairs, row["_cov"]):
            cov[i, j] = cov[j, i] = value
        out[tuple(row[c] for c in by)] = Moments(tuple(columns), row["_n"], np.array(row["_mean"]), cov)
    return out


def ridge(about: Moments, names: Sequence[str], label: str, strength: float = 0.0) -> Linear:
    """The weights that minimise the mean squared error plus ``strength`` times their squares.

    Features that others tell exactly share their weight if ``strength`` is 0.
    """
    x, y = about.pick(names), about.columns.index(label)
    system = about.cov[np.ix_(x, x)] + strength * np.eye(len(x))
    weights = np.linalg.lstsq(system, about.cov[x, y], rcond=1e-12)[0]
    return Linear(tuple(names), float(about.mean[y] - weights @ about.mean[x]),
                  tuple(map(float, weights)))


def r2(model: Linear, about: Moments, label: str) -> float:
    """1 - residual / total sum of squares on the rows that ``about`` describes."""
    x, y = about.pick(model.names), about.columns.index(label)
    w = np.array(model.weights)
    bias = about.mean[y] - model.base - w @ about.mean[x]
    residual = about.cov[y, y] - 2 * w @ about.cov[x, y] + w @ about.cov[np.ix_(x, x)] @ w + bias ** 2
    total = about.cov[y, y]
    if total > 0:
        return float(1 - residual / total)
    return 1.0 if residual <= 0 else 0.0
