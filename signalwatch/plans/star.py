"""The star schema: six dimensions and the sales fact.

No join carries a broadcast hint. Spark broadcasts a dimension only when its stored
size is under ``spark.sql.autoBroadcastJoinThreshold``; beyond that the join shuffles
and adaptive execution splits the partitions of hot keys, a product or seller with a
third of all items included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.constants import DELIVERED, SIGNAL_DEFAULTS, UNKNOWN_CATEGORY
from signalwatch.functions.dates import calendar
from signalwatch.operators.copies import COPIES, COPY, all_copies, counted, few_copies
from signalwatch.operators.keys import dense_key
from signalwatch.operators.series import by_time, previous
from signalwatch.schemas import CATEGORY
from signalwatch.storage import settle


def dim_time(orders: DataFrame) -> DataFrame:
    """One row per day with an order.

    The ordered window runs in one task over distinct days, whose number is bounded by
    the calendar and does not grow with the orders.
    """
    days = (
        orders.where(F.col("order_purchase_timestamp").isNotNull())
        .select(F.to_date("order_purchase_timestamp").alias("full_date"))
        .distinct()
    )
    key = F.row_number().over(Window.orderBy("full_date")).cast("long")
    return days.select(
        key.alias("time_sk"), "full_date",
        *[value.alias(name) for name, value in calendar(F.col("full_date")).items()],
    )


# Rows of a keyed table, and the columns its key follows.
Rows = tuple[DataFrame, list[str]]


def product_rows(products: DataFrame) -> Rows:
    category = F.coalesce(CATEGORY, F.lit(UNKNOWN_CATEGORY)).alias(CATEGORY)
    return products.select("product_id", category), ["product_id"]


def customer_rows(customers: DataFrame) -> Rows:
    columns = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]
    return customers.select(*columns), ["customer_id"]


def seller_rows(sellers: DataFrame) -> Rows:
    return sellers.select("seller_id", "seller_city", "seller_state"), ["seller_id"]


def trend_rows(trends: DataFrame, time: DataFrame) -> Rows:
    """Search volume with the two values before it, on days with an order.

    Days without an order are dropped first, so "before" counts the days kept.
    """
    window = by_time("full_date", "search_volume", COPY)
    listed = few_copies(trends.select("full_date", CATEGORY, "search_volume"))
    dated = listed.join(time.select("full_date", "time_sk"), "full_date").select(
        "time_sk", CATEGORY, "search_volume",
        previous(F.col("search_volume"), window, 1).alias("search_lead_1"),
        previous(F.col("search_volume"), window, 2).alias("search_lead_2"),
        "full_date", COPIES,
    )
    return all_copies(dated), ["full_date", CATEGORY]


def review_rows(reviews: DataFrame, time: DataFrame) -> Rows:
    dated = reviews.join(time.select("full_date", "time_sk"), "full_date").select(
        "time_sk", CATEGORY, "average_score", "total_comments", "sentiment_score",
        "review_momentum", "full_date",
    )
    return dated, ["full_date", CATEGORY]


def dim_product(products: DataFrame) -> DataFrame:
    rows, order = product_rows(products)
    return dense_key(rows, "product_sk", order)


def dim_customer(customers: DataFrame) -> DataFrame:
    rows, order = customer_rows(customers)
    return dense_key(rows, "customer_sk", order)


def dim_seller(sellers: DataFrame) -> DataFrame:
    rows, order = seller_rows(sellers)
    return dense_key(rows, "seller_sk", order)


def dim_trend(trends: DataFrame, time: DataFrame) -> DataFrame:
    rows, order = trend_rows(trends, time)
    return dense_key(rows, "trend_sk", order)


def dim_review(reviews: DataFrame, time: DataFrame) -> DataFrame:
    rows, order = review_rows(reviews, time)
    return dense_key(rows, "review_sk", order)


def sales_rows(items: DataFrame, orders: DataFrame, time: DataFrame, product: DataFrame,
               customer: DataFrame, seller: DataFrame, delivered: str = DELIVERED) -> DataFrame:
    """Delivered items with their dimension keys, not numbered yet.

    Day and customer belong to the order, so they are looked up on the smaller orders
    side before the items join.
    """
    placed = (
        orders.where(F.col("order_status") == delivered)
        .select("order_id", "customer_id",
                F.to_date("order_purchase_timestamp").alias("full_date"))
        .join(time.select("full_date", "time_sk"), "full_date")
        .join(customer.select("customer_id", "customer_sk"), "customer_id")
        .select("order_id", "time_sk", "customer_sk")
    )
    return (
        items.select("order_id", "product_id", "seller_id", "price", "freight_value")
        .join(placed, "order_id")
        .join(product.select("product_id", "product_sk"), "product_id")
        .join(seller.select("seller_id", "seller_sk"), "seller_id")
        .select(
            "time_sk", "product_sk", "customer_sk", "seller_sk", "price", "freight_value",
            (F.col("price") + F.col("freight_value")).alias("total_value"),
        )
    )


SALES_ORDER = [
    "time_sk", "product_sk", "customer_sk", "seller_sk", "price", "freight_value", "total_value",
]


def item_signals(fact: DataFrame, product: DataFrame, time: DataFrame, trend: DataFrame,
                 review: DataFrame) -> DataFrame:
    """Every sold item with its category, month and the signals of its day.

    Signals a category and day lacks take their defaults. The two signals meet on their
    day rows first and are stored, so that the items pass a single join on category and
    day. From the stored size Spark knows whether the items need no shuffle at all; if
    they do, adaptive execution may split a category and day with a large share of them.
    An item of a day with several signal rows is repeated for each of them.
    """
    def signal(name: str):
        value = F.col(name).cast("double")
        return F.coalesce(value, F.lit(SIGNAL_DEFAULTS[name])).alias(name)

    on = ["time_sk", CATEGORY]
    searches = counted(trend.select(*on, "search_volume", "search_lead_1", "search_lead_2"))
    ratings = counted(review.select(*on, "sentiment_score", "review_momentum", "average_score"))
    times = F.coalesce(searches[COPIES], F.lit(1)) * F.coalesce(ratings[COPIES], F.lit(1))
    signals = settle(
        searches.join(ratings, on, "full").select(*on, *SIGNAL_DEFAULTS, times.alias(COPIES)),
        "day_signals",
    )
    items = (
        fact.select("time_sk", "product_sk", "price")
        .join(product.select("product_sk", CATEGORY), "product_sk")
        .join(time.select("time_sk", "month", "quarter"), "time_sk")
        .join(signals, on, "left")
        .select("time_sk", F.col("price").cast("double").alias("price"), CATEGORY, "month",
                "quarter", *[signal(name) for name in SIGNAL_DEFAULTS],
                F.coalesce(COPIES, F.lit(1).cast("long")).alias(COPIES))
    )
    if signals.where(F.col(COPIES) > 1).isEmpty():
        return items.drop(COPIES)
    return all_copies(items, spread=False)
