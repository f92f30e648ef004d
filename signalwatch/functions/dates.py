"""Calendar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar(day: Column) -> dict[str, Column]:
    """Attributes of a date: the month name is padded to 9, Sunday is day 0."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "quarter": F.quarter(day),
        "month_name": F.rpad(F.date_format(day, "MMMM"), 9, " "),
        "day_of_week": F.dayofweek(day) - F.lit(1),
    }


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def period_month(time_sk: Column) -> Column:
    """A month number guessed from a running day number (1..12, repeating)."""
    return ((time_sk - 1) % 12 + 1).cast("int")


def period_quarter(month: Column) -> Column:
    return (F.floor((month - 1) / 3) + 1).cast("int")
