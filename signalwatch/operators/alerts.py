"""Ranking categories by how likely they are to take off."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch import constants as C
from signalwatch.functions.numeric import rescale, weighted_sum
from signalwatch.functions.scoring import alert_level
from signalwatch.schemas import CATEGORY


def category_summary(features: DataFrame) -> DataFrame:
    return features.groupBy(CATEGORY).agg(
        F.avg("search_momentum").alias("search_momentum_avg"),
        F.avg("emergence_score").alias("emergence_score_avg"),
        F.avg("acceleration").alias("acceleration_avg"),
        F.avg("sales_volume").alias("sales_volume_avg"),
    )


def category_alerts(features: DataFrame,
                    weights: Mapping[str, float] = C.ALERT_WEIGHTS) -> DataFrame:
    """A 0-100 alert per category from the weighted, rescaled category means.

    The least and greatest means come from a one-row scalar subquery; a mean that is
    the same for all categories adds nothing.
    """
    summary = category_summary(features)
    bounds = summary.agg(
        F.struct(
            *[F.min(c).alias(f"{c}_low") for c in weights],
            *[F.max(c).alias(f"{c}_high") for c in weights],
        ).alias("bounds")
    ).scalar()
    rated = summary.withColumn("bounds", bounds)
    parts = {
        c: rescale(
            F.col(c), F.col(f"bounds.{c}_low"), F.col(f"bounds.{c}_high"),
            span=100.0, start=0.0, flat=0.0,
        )
        for c in weights
    }
    return rated.withColumn("alert", weighted_sum(parts, dict(weights))).drop("bounds")


def with_level(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("level", alert_level(F.col("alert"))).withColumn(
        "above_reference", F.col("alert") > F.lit(C.ALERT_REFERENCE_LINE)
    )


def top_alerts(alerts: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` highest alerts, ties in category order."""
    return (
        alerts.where(F.col("alert").isNotNull())
        .orderBy(F.col("alert").desc(), F.col(CATEGORY))
        .limit(n)
    )


def top_mean(features: DataFrame, measure: str, n: int = 5) -> DataFrame:
    """The ``n`` categories with the highest mean of a feature."""
    return (
        features.groupBy(CATEGORY)
        .agg(F.avg(measure).alias(f"{measure}_avg"))
        .orderBy(F.col(f"{measure}_avg").desc_nulls_last(), F.col(CATEGORY))
        .limit(n)
    )
