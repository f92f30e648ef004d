import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from signalwatch.operators.daily import daily_sales, items_analysed, with_signals
from signalwatch.operators.signals import (
    category_spine, for_categories, review_signal, run_ahead, search_signal, signal_summary,
)
from signalwatch.plans import star
from signalwatch.plans.warehouse import build, reopen
from signalwatch.schemas import CATEGORY, STAGING

DAY = dt.date


def orders(spark, rows):
    full = [(o, c, s, t, None, None) for o, c, s, t in rows]
    return spark.createDataFrame(full, STAGING["orders"])


@pytest.fixture(scope="module")
def shop(spark):
    time = dt.datetime
    return {
        "orders": orders(spark, [
            ("o1", "c1", "delivered", time(2024, 5, 5, 10)),
            ("o2", "c2", "delivered", time(2024, 5, 7, 23, 59)),
            ("o3", "c1", "shipped", time(2024, 5, 9)),
            ("o4", "c1", "delivered", None),
            ("o5", "nobody", "delivered", time(2024, 5, 5)),
        ]),
        "order_items": spark.createDataFrame([
            ("o1", 1, "p1", "s1", Decimal("10.00"), Decimal("1.50")),
            ("o1", 2, "p2", "s1", Decimal("20.00"), Decimal("2.00")),
            ("o2", 1, "p1", "s2", None, Decimal("1.00")),
            ("o2", 2, "p1", "s2", Decimal("7.00"), Decimal("1.00")),
            ("o3", 1, "p1", "s1", Decimal("1.00"), Decimal("1.00")),
            ("o4", 1, "p1", "s1", Decimal("1.00"), Decimal("1.00")),
            ("o5", 1, "p1", "s1", Decimal("1.00"), Decimal("1.00")),
            ("o1", 3, "gone", "s1", Decimal("1.00"), Decimal("1.00")),
        ], STAGING["order_items"]),
        "products": spark.createDataFrame([("p2", None), ("p1", "toys")], STAGING["products"]),
        "customers": spark.createDataFrame(
            [("c2", "u2", "Porto", "PT"), ("c1", "u1", "Braga", "PT")], STAGING["customers"]),
        "sellers": spark.createDataFrame(
            [("s1", "Faro", "PT"), ("s2", "Lisboa", "PT")], STAGING["sellers"]),
        "trends": spark.createDataFrame([
            (DAY(2024, 5, 5), "toys", Decimal("10.00")),
            (DAY(2024, 5, 6), "toys", Decimal("99.00")),
            (DAY(2024, 5, 7), "toys", Decimal("20.00")),
            (DAY(2024, 5, 9), "toys", Decimal("30.00")),
        ], STAGING["trends"]),
        "reviews": spark.createDataFrame([
            ("toys", DAY(2024, 5, 5), Decimal("4.00"), 10, Decimal("75.00"), Decimal("0.1000")),
        ], STAGING["reviews"]),
    }


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    return str(tmp_path_factory.mktemp("star"))


@pytest.fixture(scope="module")
def built(spark, shop, place):
    return build(spark, shop, place)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_dim_time(built):
    got = rows(built["dim_time"], "time_sk", "full_date", "month_name", "day_of_week")
    assert got == [
        (1, DAY(2024, 5, 5), "May      ", 0),
        (2, DAY(2024, 5, 7), "May      ", 2),
        (3, DAY(2024, 5, 9), "May      ", 4),
    ]


def test_product_without_category(built):
    assert rows(built["dim_product"], "product_sk", "product_id", CATEGORY) == [
        (1, "p1", "toys"), (2, "p2", "desconhecido"),
    ]


def test_fact_holds_delivered_items_of_known_parties(built):
    got = built["fact_sales"]
    assert sorted(r.sales_sk for r in got.collect()) == [1, 2, 3, 4]
    assert sorted(
        (r.time_sk, r.product_sk, r.customer_sk, r.seller_sk, r.total_value) for r in
        got.where("price is not null").collect()
    ) == [
        (1, 1, 1, 1, Decimal("11.50")), (1, 2, 1, 1, Decimal("22.00")),
        (2, 1, 2, 2, Decimal("8.00")),
    ]
    assert got.where("price is null").first().total_value is None


def test_trend_lags_skip_days_without_orders(built):
    got = rows(built["dim_trend"], "trend_sk", "time_sk", "search_volume", "search_lead_1",
               "search_lead_2")
    d = Decimal
    assert got == [
        (1, 1, d("10.00"), None, None),
        (2, 2, d("20.00"), d("10.00"), None),
        (3, 3, d("30.00"), d("20.00"), d("10.00")),
    ]


def test_item_signals_default_where_missing(built):
    names = ("fact_sales", "dim_product", "dim_time", "dim_trend", "dim_review")
    got = star.item_signals(*[built[n] for n in names])
    by_item = {(r[CATEGORY], r.time_sk, r.price): r for r in got.collect()}
    first = by_item["toys", 1, 10.0]
    assert (first.search_volume, first.search_lead_1, first.sentiment_score) == (10, 50, 75)
    other = by_item["desconhecido", 1, 20.0]
    assert (other.search_volume, other.review_momentum, other.average_score) == (50, 0, 3.5)
    later = by_item["toys", 2, 7.0]
    assert (later.search_lead_1, later.search_lead_2, later.average_score) == (10, 50, 3.5)


def test_daily_sales_ignore_missing_prices(built):
    got = rows(daily_sales(built["fact_sales"], built["dim_product"]),
               CATEGORY, "time_sk", "sales_volume", "revenue")
    assert got == [("desconhecido", 1, 1, 20.0), ("toys", 1, 1, 10.0), ("toys", 2, 1, 7.0)]


def test_aggregating_before_the_signal_joins_changes_nothing(spark, built):
    """Repeated signal rows multiply items; the day-level join must agree with that."""
    names = ("fact_sales", "dim_product", "dim_time")
    trend = built["dim_trend"].unionByName(
        built["dim_trend"].withColumn("search_volume", F.col("search_volume") + 1)
    )
    review = built["dim_review"].unionByName(built["dim_review"]).unionByName(
        built["dim_review"].withColumn("sentiment_score", F.lit(None).cast("decimal(6,2)"))
    )
    items = star.item_signals(*[built[n] for n in names], trend, review)
    signals = ["search_volume", "search_lead_1", "search_lead_2", "sentiment_score",
               "review_momentum"]
    expected = items.groupBy(CATEGORY, "time_sk").agg(
        F.count("price").alias("sales_volume"), F.sum("price").alias("revenue"),
        *[F.avg(s).alias(s) for s in signals],
    )
    daily = with_signals(daily_sales(built["fact_sales"], built["dim_product"]), trend, review)
    columns = [CATEGORY, "time_sk", "sales_volume", "revenue", *signals]

    def near(df):
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                for r in rows(df, *columns)]

    assert near(daily) == near(expected)
    analysed = items_analysed(built["fact_sales"], built["dim_product"], trend, review)
    assert analysed.first().rows_analysed == items.count()
    assert {r.sales_volume for r in daily.collect()} == {1, 2, 6}


def test_primary_keys_and_counts(built):
    built.check_primary_keys()
    assert {n: built[n].count() for n in ("fact_sales", "dim_trend", "dim_review")} == {
        "fact_sales": 4, "dim_trend": 3, "dim_review": 1,
    }


def test_an_earlier_build_can_be_reopened(spark, built, place):
    again = reopen(spark, place)
    assert set(again) == set(built)
    for name, df in built.items():
        assert again[name].columns == df.columns
        assert rows(again[name].select(*[F.col(c).cast("string") for c in df.columns]),
                    *df.columns[:1]) == \
            rows(df.select(*[F.col(c).cast("string") for c in df.columns]), *df.columns[:1])
    again.check_primary_keys()


def test_repeated_source_rows_keep_separate_keys(spark):
    twice = spark.createDataFrame([("p", "a"), ("p", "a")], STAGING["products"])
    assert sorted(r.product_sk for r in star.dim_product(twice).collect()) == [1, 2]


def test_views_answer_sql(spark, built):
    built.register_views()
    assert spark.sql("SELECT count(*) AS n FROM fact_sales JOIN dim_time USING (time_sk)"
                     ).first().n == 4


def test_spine(built):
    spine = category_spine(built["fact_sales"], built["dim_product"], built["dim_time"])
    assert rows(spine, "time_sk", CATEGORY) == [
        (1, "desconhecido"), (1, "toys"), (2, "toys"),
    ]


def test_signal_summary(shop):
    trends = shop["trends"]
    for approximate in (False, True):
        row = signal_summary(trends, approximate).first()
        assert tuple(row) == (4, 1, DAY(2024, 5, 5), DAY(2024, 5, 9))
    assert for_categories(trends, ["toys"]).count() == 4
    assert for_categories(trends).count() == 0


def test_signals_from_activity(spark):
    days = [DAY(2024, 1, d) for d in (1, 2, 3)]
    activity = spark.createDataFrame(
        [("a", d, n, r) for d, n, r in zip(days, (10, 20, 30), (3.0, 4.0, 0.5))],
        f"{CATEGORY} string, full_date date, n long, rating double",
    )
    volumes = rows(search_signal(activity, "n"), "full_date", "search_volume")
    assert [float(v) for _, v in volumes] == [5, 50, 95]
    ratings = rows(review_signal(activity, "rating", "n"), "full_date", "average_score",
                   "sentiment_score", "review_momentum", "total_comments")
    assert [tuple(map(float, r[1:])) for r in ratings] == [
        (3, 50, 0, 10), (4, 75, 1, 20), (1, 0, -3, 30),
    ]
    early = run_ahead(search_signal(activity, "n"), "search_volume", {"natal": ["a"]}, rows=1)
    assert [float(v) for _, v in rows(early, "full_date", "search_volume_early")] == [50, 95, 95]
    same = run_ahead(search_signal(activity, "n"), "search_volume", {"estavel": ["a"]})
    assert [float(v) for _, v in rows(same, "full_date", "search_volume_early")] == [5, 50, 95]
