"""Numeric column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to ``[low, high]``; a missing value stays missing.

    ``greatest``/``least`` skip NULLs and would turn a missing value into a bound.
    """
    return (
        F.when(value.isNull(), None)
        .when(value < low, F.lit(float(low)))
        .when(value > high, F.lit(float(high)))
        .otherwise(value.cast("double"))
    )


def relative_change(value: Column, previous: Column) -> Column:
    """``value / previous - 1``; 0 where there is no previous value or it is 0."""
    return F.coalesce(F.try_divide(value, previous) - F.lit(1.0), F.lit(0.0))


def rescale(value: Column, low: Column, high: Column, span: float, start: float,
            flat: float) -> Column:
    """Map ``[low, high]`` onto ``[start, start + span]``; ``flat`` if low = high."""
    return F.when(
        high > low, (value - low) / (high - low) * F.lit(span) + F.lit(start)
    ).otherwise(F.lit(flat))


def sentiment(rating: Column) -> Column:
    """A 1-5 rating as 0-100."""
    return (rating - F.lit(1.0)) / F.lit(4.0) * F.lit(100.0)


def rounded(value: Column, digits: int) -> Column:
    """Round half away from zero, never giving a negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def weighted_sum(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    """Sum of each named part times its weight, added in the weights' order."""
    total = None
    for name, weight in weights.items():
        term = F.lit(float(weight)) * parts[name]
        total = term if total is None else total + term
    return total


def season(month: Column) -> tuple[Column, Column]:
    """Sine and cosine of the month's place in the year."""
    angle = F.lit(2 * math.pi) * month / F.lit(12)
    return F.sin(angle), F.cos(angle)
