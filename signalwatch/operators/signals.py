"""Preparing and describing the external daily signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch import constants as C
from signalwatch.functions.numeric import clip, rounded, sentiment
from signalwatch.functions.scoring import profile_of
from signalwatch.operators.series import by_time, shifted_early, spread_5_95, step
from signalwatch.schemas import CATEGORY


def category_spine(fact: DataFrame, dim_product: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Every day on which a category sold something."""
    sold = (
        fact.select("time_sk", "product_sk")
        .join(dim_product.select("product_sk", CATEGORY), "product_sk")
        .where(F.col(CATEGORY).isNotNull())
        .select("time_sk", CATEGORY)
        .distinct()
    )
    return sold.join(dim_time.select("time_sk", "full_date"), "time_sk").select(
        "full_date", "time_sk", CATEGORY
    )


def search_signal(activity: DataFrame, measure: str) -> DataFrame:
    """A daily measure per category as a 5-95 search volume."""
    return activity.select(
        "full_date", CATEGORY,
        rounded(spread_5_95(F.col(measure).cast("double")), 2)
        .cast("decimal(6,2)").alias("search_volume"),
    )


def review_signal(ratings: DataFrame, rating: str, comments: str) -> DataFrame:
    """A daily rating per category as score, comments, sentiment and momentum."""
    score = clip(F.col(rating), 1.0, 5.0)
    window = by_time("full_date")
    return (
        ratings.withColumn("score", score)
        .select(
            CATEGORY, "full_date",
            rounded(F.col("score"), 2).cast("decimal(3,2)").alias("average_score"),
            clip(F.col(comments), 1, 2000).cast("int").alias("total_comments"),
            rounded(sentiment(F.col("score")), 2).cast("decimal(6,2)").alias("sentiment_score"),
            rounded(step(F.col("score"), window), 4)
            .cast("decimal(8,4)").alias("review_momentum"),
        )
    )


def run_ahead(signal: DataFrame, value: str, profiles: Mapping[str, Sequence[str]],
              early: Sequence[str] = C.EARLY_PROFILES, rows: int = C.EARLY_ROWS) -> DataFrame:
    """Move the signal earlier for categories whose searches lead their sales."""
    profile = profile_of(F.col(CATEGORY), profiles)
    moved = shifted_early(F.col(value), by_time("full_date"), rows)
    return signal.withColumn(
        f"{value}_early", F.when(profile.isin(list(early)), moved).otherwise(F.col(value))
    )


def search_profile(signal: DataFrame, profiles: Mapping[str, Sequence[str]] = C.SEARCH_PROFILES
                   ) -> DataFrame:
    """Mean, sample deviation, least and most search volume per category."""
    volume = F.col("search_volume").cast("double")
    return (
        signal.groupBy(CATEGORY)
        .agg(
            F.avg(volume).alias("search_mean"),
            F.stddev_samp(volume).alias("search_std"),
            F.min(volume).alias("search_min"),
            F.max(volume).alias("search_max"),
        )
        .withColumn("profile", profile_of(F.col(CATEGORY), profiles))
    )


def review_profile(signal: DataFrame, profiles: Mapping[str, Sequence[str]] = C.REVIEW_PROFILES
                   ) -> DataFrame:
    """Mean score, comments and momentum per category."""
    return (
        signal.groupBy(CATEGORY)
        .agg(
            F.avg(F.col("average_score").cast("double")).alias("score_mean"),
            F.avg("total_comments").alias("comments_mean"),
            F.avg(F.col("review_momentum").cast("double")).alias("momentum_mean"),
        )
        .withColumn("profile", profile_of(F.col(CATEGORY), profiles))
    )


def for_categories(df: DataFrame, categories: Sequence[str] = C.SAMPLE_CATEGORIES) -> DataFrame:
    return df.where(F.col(CATEGORY).isin(list(categories)))


def signal_summary(signal: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, categories and the period a signal covers.

    ``approximate`` estimates the number of categories without shuffling their names.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return signal.agg(
        F.count("*").alias("n_rows"),
        distinct(CATEGORY).alias("n_categories"),
        F.min("full_date").alias("first_date"),
        F.max("full_date").alias("last_date"),
    )
