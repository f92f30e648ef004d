"""Demand of the next days, each day foretold from those before it, foretold or real."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.operators.least_squares import Linear, moments, ridge
from signalwatch.operators.series import by_time
from signalwatch.schemas import CATEGORY

#: Rows whose mean is an input, and rows that are foretold.
RECENT, STEPS = 3, 7
INPUTS = ("last", "recent_mean")


def with_inputs(daily: DataFrame) -> DataFrame:
    """Add what is known before each row: the sales of the row before, and the mean of the last three
    (of fewer at the start). A first row knows nothing: nulls."""
    before = by_time().rowsBetween(-RECENT, -1)
    return daily.withColumns({
        "last": F.lag("sales_volume", 1).over(by_time()).cast("double"),
        "recent_mean": F.avg("sales_volume").over(before),
    })


def fit(daily: DataFrame, strength: float = 0.0) -> Linear:
    """A linear model of a row's sales, for all categories."""
    about = moments(with_inputs(daily), [*INPUTS, "sales_volume"])
    if not about:
        raise ValueError("no category has two days with sales")
    return ridge(about[()], INPUTS, "sales_volume", strength)


def forecast(daily: DataFrame, model: Linear, steps: int = STEPS) -> DataFrame:
    """Return ``category, step, time_sk, forecast``: the next ``steps`` days of each category.

    A category's state is its last three values. Each step predicts from the state and goes into it;
    what is foretold is not below 0. The state of a category is one row, so that steps need no join
    and no job of their own. Categories without sales are not foretold.
    """
    newest = Window.partitionBy(CATEGORY).orderBy(F.desc("time_sk"))
    state = daily.select(CATEGORY, "time_sk", F.col("sales_volume").cast("double").alias("y")) \
        .withColumn("age", F.row_number().over(newest)).where(F.col("age") <= RECENT) \
        .groupBy(CATEGORY).agg(
            F.max("time_sk").alias("last_day"),
            F.transform(F.array_sort(F.collect_list(F.struct((-F.col("age")).alias("age"), "y"))),
                        lambda x: x["y"]).alias("recent"))

    def mean(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, b: a + b) / F.size(values)

    def ahead(s: Column, _: Column) -> Column:
        y = F.greatest(F.lit(0.0), model.predict(F.element_at(s["recent"], -1), mean(s["recent"])))
        known = F.concat(s["recent"], F.array(y))
        return F.struct(
            F.slice(known, F.greatest(F.size(known) - RECENT + 1, F.lit(1)), F.lit(RECENT))
            .alias("recent"),
            F.concat(s["foretold"], F.array(y)).alias("foretold"))

    start = F.struct(F.col("recent"), F.array().cast("array<double>").alias("foretold"))
    foretold = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, ahead, lambda s: s["foretold"])
    return state.select(CATEGORY, "last_day", F.posexplode(foretold).alias("k", "forecast")) \
        .select(CATEGORY, (F.col("k") + 1).alias("step"),
                (F.col("last_day") + F.col("k") + 1).alias("time_sk"), "forecast")
