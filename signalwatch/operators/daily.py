"""From item-level facts to one row per category and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.constants import SIGNAL_DEFAULTS
from signalwatch.schemas import CATEGORY

DAY = [CATEGORY, "time_sk"]


def daily_sales(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Items sold and revenue per category and day.

    The only step over item rows: one lookup join and one aggregation whose partial
    sums shrink every task's rows to at most one per category and day before the
    shuffle.
    """
    return (
        fact.select("time_sk", "product_sk", "price")
        .join(dim_product.select("product_sk", CATEGORY), "product_sk")
        .groupBy(*DAY)
        .agg(
            F.count("price").alias("sales_volume"),
            F.coalesce(F.sum("price").cast("double"), F.lit(0.0)).alias("revenue"),
        )
    )


def day_parts(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Items sold and their exact price per category and day, as sums that can be added up further:
    those of inserted rows to those of the rows before."""
    return (
        fact.select("time_sk", "product_sk", "price")
        .join(dim_product.select("product_sk", CATEGORY), "product_sk")
        .groupBy(*DAY).agg(F.count("price").alias("items"), F.sum("price").alias("amount"))
    )


def daily_from_parts(parts: DataFrame) -> DataFrame:
    """What :func:`daily_sales` gives, from any number of :func:`day_parts`; no item is read again."""
    return parts.groupBy(*DAY).agg(
        F.sum("items").alias("sales_volume"),
        F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("revenue"),
    )


def _per_day(signal: DataFrame, columns: list[str], copies: str) -> DataFrame:
    """Mean of each signal per category and day, and how many rows there were.

    Missing values count as their defaults before the mean is taken.
    """
    return signal.groupBy(*DAY).agg(
        F.count("*").alias(copies),
        *[
            F.avg(F.coalesce(F.col(c).cast("double"), F.lit(SIGNAL_DEFAULTS[c]))).alias(c)
            for c in columns
        ],
    )


def with_signals(daily: DataFrame, dim_trend: DataFrame, dim_review: DataFrame) -> DataFrame:
    """Join both signals to the daily sales.

    Equal to joining every sold item to the signals and aggregating afterwards, but
    the joins see day rows only. Where a category and day has several signal rows,
    each item would meet all of them, so counts and sums are multiplied; means over
    the repeated rows equal the means over the signal rows.
    """
    trend_columns = ["search_volume", "search_lead_1", "search_lead_2"]
    review_columns = ["sentiment_score", "review_momentum"]
    trends = _per_day(dim_trend, trend_columns, "trend_rows")
    reviews = _per_day(dim_review, review_columns, "review_rows")
    times = F.coalesce("trend_rows", F.lit(1)) * F.coalesce("review_rows", F.lit(1))
    return (
        daily.join(trends, DAY, "left")
        .join(reviews, DAY, "left")
        .select(
            *DAY,
            (F.col("sales_volume") * times).alias("sales_volume"),
            (F.col("revenue") * times).alias("revenue"),
            *[
                F.coalesce(c, F.lit(SIGNAL_DEFAULTS[c])).alias(c)
                for c in trend_columns + review_columns
            ],
        )
    )


def items_analysed(fact: DataFrame, dim_product: DataFrame, *signals: DataFrame) -> DataFrame:
    """One row: how many items there are once each has met the signal rows of its day.

    Counted from day rows, so that no item passes a signal join for the sake of a count.
    """
    days = (
        fact.select("time_sk", "product_sk")
        .join(dim_product.select("product_sk", CATEGORY), "product_sk")
        .groupBy(*DAY)
        .agg(F.count("*").alias("n"))
    )
    for signal in signals:
        listed = signal.groupBy(*DAY).agg(F.count("*").alias("listed"))
        times = F.coalesce("listed", F.lit(1))
        days = days.join(listed, DAY, "left").select(*DAY, (F.col("n") * times).alias("n"))
    return days.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_analysed"))
