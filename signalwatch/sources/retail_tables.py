"""Staging tables from a normalised order schema (orders, line items, parts, ...).

The order schema has no search or review data; both signals are derived from the
line items shipped per category and day: their number, and their mean discount read
as a rating.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalwatch.constants import UNKNOWN_CATEGORY
from signalwatch.operators.signals import review_signal, search_signal
from signalwatch.schemas import CATEGORY
from signalwatch.storage import settle

_LONG, _INT = T.LongType(), T.IntegerType()
_DOUBLE, _TEXT, _TIME = T.DoubleType(), T.StringType(), T.TimestampNTZType()

# order status that stands for "delivered"
DELIVERED_STATUS = "F"
# the category that is taken out, to stand for products without one
NO_CATEGORY = "SMALL"

_SCHEMAS = {
    "region": {"r_regionkey": _INT, "r_name": _TEXT},
    "nation": {"n_nationkey": _INT, "n_name": _TEXT, "n_regionkey": _INT},
    "customer": {"c_custkey": _LONG, "c_name": _TEXT, "c_nationkey": _INT},
    "supplier": {"s_suppkey": _LONG, "s_nationkey": _INT},
    "part": {"p_partkey": _LONG, "p_type": _TEXT},
    "orders": {
        "o_orderkey": _LONG, "o_custkey": _LONG, "o_orderstatus": _TEXT, "o_orderdate": _TIME,
    },
    "lineitem": {
        "l_orderkey": _LONG, "l_partkey": _LONG, "l_suppkey": _LONG, "l_linenumber": _INT,
        "l_extendedprice": _DOUBLE, "l_discount": _DOUBLE, "l_tax": _DOUBLE,
        "l_shipdate": _TIME,
    },
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    fields = [T.StructField(n, t) for n, t in _SCHEMAS[name].items()]
    return spark.read.schema(T.StructType(fields)).parquet(f"{folder}/{name}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    no_time = F.lit(None).cast(_TIME)
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        no_time.alias("order_delivered_customer_date"),
        no_time.alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    # multiplied as decimals: doubles would round differently from engine to engine
    freight = (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(10,2)")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        freight.alias("freight_value"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.nullif("p_type", F.lit(NO_CATEGORY)).alias(CATEGORY),
    )


def _places(spark: SparkSession, folder: str) -> DataFrame:
    region = table(spark, folder, "region")
    nation = table(spark, folder, "nation")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    places = _places(spark, folder)
    customer = table(spark, folder, "customer")
    return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    places = _places(spark, folder)
    supplier = table(spark, folder, "supplier")
    return supplier.join(places, supplier.s_nationkey == places.n_nationkey).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """Items shipped per category and day, with their mean discount as a rating."""
    item = table(spark, folder, "lineitem").select("l_partkey", "l_shipdate", "l_discount")
    part = table(spark, folder, "part")
    category = F.coalesce(F.nullif("p_type", F.lit(NO_CATEGORY)), F.lit(UNKNOWN_CATEGORY))
    discount = F.sum(F.col("l_discount").cast("decimal(10,2)")).cast("double")
    return (
        item.join(part, item.l_partkey == part.p_partkey)
        .groupBy(category.alias(CATEGORY), F.to_date("l_shipdate").alias("full_date"))
        .agg(F.count("*").alias("n"), discount.alias("discount"))
        .select(
            CATEGORY, "full_date", "n",
            (F.lit(5.0) - F.lit(40.0) * F.col("discount") / F.col("n")).alias("rating"),
        )
    )


def trends(shipped: DataFrame) -> DataFrame:
    return search_signal(shipped, "n")


def reviews(shipped: DataFrame) -> DataFrame:
    return review_signal(shipped, "rating", "n")


def staging(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All seven staging tables. The line items are aggregated once for both signals."""
    shipped = settle(activity(spark, folder), "activity")
    return {
        "orders": orders(spark, folder),
        "order_items": order_items(spark, folder),
        "products": products(spark, folder),
        "customers": customers(spark, folder),
        "sellers": sellers(spark, folder),
        "trends": trends(shipped),
        "reviews": reviews(shipped),
    }
