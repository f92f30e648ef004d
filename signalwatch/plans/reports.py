"""Result tables of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch import constants as C
from signalwatch.plans.models import Evaluation
from signalwatch.schemas import CATEGORY


def run_summary(analysed: DataFrame, features: DataFrame, found: Evaluation) -> DataFrame:
    """One row: data volumes and the quality of the winning model."""
    winner = found.comparison.where(F.col("winner"))
    n_items = analysed.select("rows_analysed").scalar()
    n_categories = features.agg(F.count_distinct(CATEGORY).alias("n")).scalar()
    return winner.select(
        n_items.alias("rows_analysed"), n_categories.alias("categories"),
        "model", "r2", "cv_mean", "cv_std", "mae", "gap", "healthy",
    )


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)


def category_series(features: DataFrame, category: str = C.SPOTLIGHT_CATEGORY) -> DataFrame:
    """Sales and search momentum of one category, day by day."""
    return (
        features.where(F.col(CATEGORY) == category)
        .select("time_sk", "sales_volume", "search_momentum")
        .orderBy("time_sk")
    )
