import pytest
from pyspark.sql import functions as F

from signalwatch import constants as C
from signalwatch.functions.dates import calendar, iso_text, period_month, period_quarter
from signalwatch.functions.numeric import clip, relative_change, rounded, season, sentiment
from signalwatch.functions.scoring import alert_level, profile_of, trend_phase
from signalwatch.operators import series
from signalwatch.plans.features import join_search, with_trend
from signalwatch.schemas import CATEGORY


def series_of(spark, values, times=None):
    times = times or range(1, len(values) + 1)
    return spark.createDataFrame(
        [("a", t, None if v is None else float(v)) for t, v in zip(times, values)],
        f"{CATEGORY} string, time_sk long, v double",
    )


def run(spark, values, expression, times=None):
    x = expression(F.col("v"), series.by_time())
    rows = series_of(spark, values, times).select("time_sk", x.alias("x"))
    return [r.x for r in rows.orderBy("time_sk").collect()]


def test_trend_features_count_rows_not_days(spark):
    df = spark.createDataFrame(
        [("a", t, v) for t, v in zip([1, 2, 5, 9, 10, 14], [2, 4, 6, 3, 1, 5])],
        f"{CATEGORY} string, time_sk long, sales_volume long",
    )
    phase = trend_phase(F.col("growth_rate"), F.col("acceleration"), C.PHASES_ENGLISH)
    got = [
        (r.time_sk, round(r.moving_avg_3, 6), round(r.growth_rate, 6), round(r.acceleration, 6),
         r.lag_1, r.phase)
        for r in with_trend(df).withColumn("phase", phase).withColumn(
            "lag_1", series.previous_or_zero(F.col("sales_volume"), series.by_time())
        ).orderBy("time_sk").collect()
    ]
    assert got == [
        (1, 2.0, 0.0, 0.0, 0, "decline"),
        (2, 3.0, 0.5, 0.5, 2, "acceleration"),
        (5, 4.0, 0.333333, -0.166667, 4, "steady_growth"),
        (9, 4.333333, 0.083333, -0.25, 6, "steady_growth"),
        (10, 3.333333, -0.230769, -0.314103, 3, "decline"),
        (14, 3.0, -0.1, 0.130769, 1, "recovery"),
    ]


def test_series_of_categories_do_not_mix(spark):
    df = spark.createDataFrame(
        [("a", 1, 2), ("b", 2, 8), ("a", 3, 4), ("b", 4, 8)],
        f"{CATEGORY} string, time_sk long, sales_volume long",
    )
    got = {(r[CATEGORY], r.time_sk): r.moving_avg_3 for r in with_trend(df).collect()}
    assert got == {("a", 1): 2, ("b", 2): 8, ("a", 3): 3, ("b", 4): 8}


def test_lags(spark):
    assert run(spark, [10, 20, 30], lambda v, w: series.previous(v, w, 1)) == [None, 10, 20]
    assert run(spark, [10, 20, 30], lambda v, w: series.previous(v, w, 2)) == [None, None, 10]
    first = run(spark, [10, 20, 30], lambda v, w: series.previous_or_current(v, w, 1))
    second = run(spark, [10, 20, 30], lambda v, w: series.previous_or_current(v, w, 2))
    assert (first, second) == ([10, 10, 20], [10, 20, 10])


def test_shift_early_keeps_the_tail(spark):
    assert run(spark, [0, 1, 2, 3, 4, 5], series.shifted_early) == [3, 4, 5, 3, 4, 5]
    assert run(spark, [7, 8], series.shifted_early) == [7, 8]


def test_step(spark):
    assert run(spark, [3, 4, 2], series.step) == [0, 1, -2]


def test_spread(spark):
    assert run(spark, [10, 20, 30], lambda v, w: series.spread_5_95(v)) == [5, 50, 95]
    assert run(spark, [7, 7], lambda v, w: series.spread_5_95(v)) == [50, 50]


def test_smoothing_needs_a_full_window(spark):
    got = run(spark, range(6), lambda v, w: series.smoothed(v, w, 4))
    assert got == [None, None, None, 1.5, 2.5, 3.5]


def test_progress(spark):
    assert run(spark, [1], lambda v, w: series.progress(w)) == [0]
    assert run(spark, [1, 1, 1], lambda v, w: series.progress(w)) == [0, 0.5, 1]


def test_growth_from_zero_is_zero(spark):
    assert run(spark, [0, 5, 10], series.growth) == [0, 0, 1]


def test_group_mean_fills_missing_periods(spark):
    daily = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)],
                                  f"{CATEGORY} string, time_sk long")
    trends = spark.createDataFrame([("a", 1, 30.0)],
                                   f"{CATEGORY} string, time_sk long, search_volume double")
    got = {(r[CATEGORY], r.time_sk): r.search_volume for r in join_search(daily, trends).collect()}
    assert got == {("a", 1): 30.0, ("a", 2): 30.0, ("b", 1): None}

    undated = spark.createDataFrame([("a", 30.0), ("a", 10.0)],
                                    f"{CATEGORY} string, search_volume double")
    got = {(r[CATEGORY], r.time_sk): r.search_volume
           for r in join_search(daily, undated).collect()}
    assert got == {("a", 1): 20.0, ("a", 2): 20.0, ("b", 1): None}


def one(spark, expression, **columns):
    df = spark.range(1)
    for name, (value, kind) in columns.items():
        df = df.withColumn(name, F.lit(value).cast(kind))
    return df.select(expression.alias("x")).first().x


@pytest.mark.parametrize("value, expected", [(None, None), (-3.0, -1), (0.5, 0.5), (9.0, 1)])
def test_clip(spark, value, expected):
    assert one(spark, clip(F.col("v"), -1, 1), v=(value, "double")) == expected


def test_small_expressions(spark):
    assert one(spark, sentiment(F.col("v")), v=(5.0, "double")) == 100
    assert str(one(spark, rounded(F.col("v"), 2), v=(-0.001, "double"))) == "0.0"
    assert one(spark, rounded(F.col("v"), 2), v=(2.345, "double")) == 2.35
    assert one(spark, relative_change(F.lit(3.0), F.lit(0.0))) == 0
    sine, cosine = season(F.lit(3))
    assert one(spark, sine) == pytest.approx(1)
    assert one(spark, cosine) == pytest.approx(0)
    assert one(spark, period_month(F.lit(25))) == 1
    assert [one(spark, period_quarter(F.lit(m))) for m in (1, 3, 4, 12)] == [1, 1, 2, 4]
    assert one(spark, alert_level(F.lit(80.0))) == "standard"
    assert one(spark, alert_level(F.lit(80.1))) == "critical"


def test_calendar(spark):
    day = F.lit("2024-05-05").cast("date")
    got = spark.range(1).select(*[v.alias(k) for k, v in calendar(day).items()]).first()
    assert got.asDict() == {"year": 2024, "month": 5, "quarter": 2, "month_name": "May      ",
                            "day_of_week": 0}
    assert one(spark, iso_text(day)) == "2024-05-05"


def test_first_matching_profile_wins(spark):
    def search(category):
        return one(spark, profile_of(F.lit(category), C.SEARCH_PROFILES))

    assert search("informatica_acessorios") == "natal"
    assert search("papelaria") == "estavel"
    assert search("la_cuisine") == "emergente"
    assert search("no such category") == "padrao"
    assert one(spark, profile_of(F.lit("pcs"), C.REVIEW_PROFILES)) == "estavel_alto"
    assert one(spark, profile_of(F.lit("pcs"), {})) == "padrao"


@pytest.mark.parametrize("growth, acceleration, phase", [
    (1, 1, "Aceleracao"), (1, 0, "Crescimento Estavel"), (0, 1, "Recuperacao"),
    (-1, -1, "Declinio"), (0, 0, "Declinio"),
])
def test_phase(spark, growth, acceleration, phase):
    assert one(spark, trend_phase(F.lit(growth), F.lit(acceleration))) == phase
