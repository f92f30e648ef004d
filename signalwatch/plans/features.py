"""Day-level features per category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch import constants as C
from signalwatch.functions.dates import period_month, period_quarter
from signalwatch.functions.numeric import season
from signalwatch.functions.scoring import emergence_score, trend_phase
from signalwatch.operators import series
from signalwatch.operators.copies import COPIES, COPY, all_copies, few_copies
from signalwatch.operators.daily import DAY, daily_sales, with_signals
from signalwatch.operators.keys import dense_key
from signalwatch.schemas import CATEGORY


def category_codes(daily: DataFrame) -> DataFrame:
    """Number the categories from 0 in name order."""
    names = daily.select(CATEGORY).distinct()
    coded = dense_key(names, "category_code", [CATEGORY])
    return coded.select(CATEGORY, (F.col("category_code") - 1).cast("int").alias("category_code"))


def with_trend(daily: DataFrame) -> DataFrame:
    """Moving average, growth and acceleration of each series.

    Growth is 0 on a first row before acceleration takes differences of it.
    """
    window = series.by_time()
    averaged = daily.withColumn(
        "moving_avg_3", series.moving_average(F.col("sales_volume"), window, 3)
    )
    grown = averaged.withColumn("growth_rate", series.growth(F.col("moving_avg_3"), window))
    return grown.withColumn("acceleration", series.step(F.col("growth_rate"), window))


def _finished(df: DataFrame, weights: dict[str, float], codes: DataFrame) -> DataFrame:
    sine, cosine = season(F.col("month"))
    return df.withColumns({
        "season_sin": sine,
        "season_cos": cosine,
        "emergence_score": emergence_score(weights),
        "trend_phase": trend_phase(F.col("growth_rate"), F.col("acceleration")),
    }).join(codes, CATEGORY)


def daily_features(fact: DataFrame, product: DataFrame, time: DataFrame, trend: DataFrame,
                   review: DataFrame, codes: DataFrame) -> DataFrame:
    """All features, with search and review signals."""
    return features_of_days(daily_sales(fact, product), time, trend, review, codes)


def features_of_days(sales: DataFrame, time: DataFrame, trend: DataFrame, review: DataFrame,
                     codes: DataFrame) -> DataFrame:
    """The same from sales that are added up by category and day already."""
    daily = with_signals(sales, trend, review)
    dated = daily.join(time.select("time_sk", "month", "quarter"), "time_sk")
    window = series.by_time()
    moved = with_trend(dated).withColumns({
        "lag_1": series.previous_or_zero(F.col("sales_volume"), window),
        "search_momentum": series.growth(F.col("search_volume"), window),
    })
    return _finished(moved, C.EMERGENCE_WEIGHTS, codes)


def join_search(daily: DataFrame, trends: DataFrame) -> DataFrame:
    """Add the search volume: by period if the signal names periods, else by category.

    A period without a value takes the category's mean over its sales days. A period
    listed more than once gives as many rows, carried as ``copies``.
    """
    volume = F.col("search_volume").cast("double").alias("search_volume")
    if "time_sk" in trends.columns:
        joined = daily.join(few_copies(trends.select(*DAY, volume)), DAY, "left")
        weight = F.coalesce(COPIES, F.lit(1).cast("long"))
        search = F.col("search_volume")
        return joined.withColumns({
            "search_volume": F.coalesce(search, series.group_mean(search, weight)),
            COPY: F.coalesce(COPY, F.lit(1)), COPIES: weight,
        })
    means = trends.select(CATEGORY, volume).groupBy(CATEGORY).agg(
        F.avg("search_volume").alias("search_volume")
    )
    once = F.lit(1).cast("long")
    return daily.join(means, CATEGORY, "left").withColumns({COPY: F.lit(1), COPIES: once})


def daily_features_standalone(fact: DataFrame, product: DataFrame, trends: DataFrame,
                              codes: DataFrame) -> DataFrame:
    """Features from sales and a search file alone.

    Differences: lagged searches count sales days and start from the current value,
    the month is guessed from the day number, there are no review signals. Trends are
    taken before the search file is joined, lags after: a period listed twice in the
    file gives two rows, but does not count as a day of its own in the averages.
    """
    return features_of_days_standalone(daily_sales(fact, product), trends, codes)


def features_of_days_standalone(sales: DataFrame, trends: DataFrame, codes: DataFrame) -> DataFrame:
    """The same from sales that are added up by category and day already."""
    window = series.by_time("time_sk", "search_volume", COPY)
    search = F.col("search_volume")
    month = period_month(F.col("time_sk"))
    joined = join_search(with_trend(sales), trends)
    moved = joined.withColumns({
        "search_lead_1": series.previous_or_current(search, window, 1),
        "search_lead_2": series.previous_or_current(search, window, 2),
        "search_momentum": series.growth(search, window),
        "lag_1": series.previous_or_zero(F.col("sales_volume"), window),
        "month": month,
        "quarter": period_quarter(month),
    })
    return _finished(all_copies(moved), C.EMERGENCE_WEIGHTS_STANDALONE, codes)


def model_rows(features: DataFrame, names: tuple[str, ...] = C.FEATURES,
               label: str = C.LABEL) -> DataFrame:
    """Rows with every feature and the label present."""
    return features.na.drop(subset=[*names, label])
