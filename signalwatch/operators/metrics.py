"""Regression quality as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def r2(label: str, prediction: str) -> Column:
    """1 - residual / total sum of squares, in one pass.

    The total is n times the population variance, which Spark merges without the
    cancellation of a plain sum of squares. With no spread in the labels the score
    is 1 for a perfect prediction and 0 otherwise.
    """
    error = F.col(label) - F.col(prediction)
    residual = F.sum(error * error)
    total = F.var_pop(label) * F.count(label)
    return (
        F.when(F.count(label) < 2, F.lit(None).cast("double"))
        .when(total > 0, F.lit(1.0) - residual / total)
        .when(residual == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )


def mae(label: str, prediction: str) -> Column:
    return F.avg(F.abs(F.col(label) - F.col(prediction)))


def regression_metrics(scored: DataFrame, label: str, prediction: str,
                       by: list[str] | None = None) -> DataFrame:
    return scored.groupBy(*(by or [])).agg(
        F.count("*").alias("n_rows"),
        r2(label, prediction).alias("r2"),
        mae(label, prediction).alias("mae"),
    )
