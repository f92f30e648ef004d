"""Declared schemas of the staging, star and audit tables.

A string field may carry ``max_length`` in its metadata: the staging check
treats a longer text as a bad value.
"""

from __future__ import annotations

from pyspark.sql import types as T

CATEGORY = "product_category_name"


def _text(name: str, longest: int) -> T.StructField:
    return T.StructField(name, T.StringType(), True, {"max_length": longest})


def _field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


MONEY = T.DecimalType(10, 2)
SHARE = T.DecimalType(6, 2)

STAGING = {
    "orders": T.StructType([
        _text("order_id", 50),
        _text("customer_id", 50),
        _text("order_status", 30),
        _field("order_purchase_timestamp", T.TimestampNTZType()),
        _field("order_delivered_customer_date", T.TimestampNTZType()),
        _field("order_estimated_delivery_date", T.TimestampNTZType()),
    ]),
    "order_items": T.StructType([
        _text("order_id", 50),
        _field("order_item_id", T.IntegerType()),
        _text("product_id", 50),
        _text("seller_id", 50),
        _field("price", MONEY),
        _field("freight_value", MONEY),
    ]),
    "products": T.StructType([_text("product_id", 50), _text(CATEGORY, 100)]),
    "customers": T.StructType([
        _text("customer_id", 50),
        _text("customer_unique_id", 50),
        _text("customer_city", 100),
        _text("customer_state", 10),
    ]),
    "sellers": T.StructType([
        _text("seller_id", 50),
        _text("seller_city", 100),
        _text("seller_state", 10),
    ]),
    "trends": T.StructType([
        _field("full_date", T.DateType()),
        _text(CATEGORY, 100),
        _field("search_volume", SHARE),
    ]),
    "reviews": T.StructType([
        _text(CATEGORY, 100),
        _field("full_date", T.DateType()),
        _field("average_score", T.DecimalType(3, 2)),
        _field("total_comments", T.IntegerType()),
        _field("sentiment_score", SHARE),
        _field("review_momentum", T.DecimalType(8, 4)),
    ]),
}

FACT_SALES = T.StructType([
    _field("sales_sk", T.LongType()),
    _field("time_sk", T.LongType()),
    _field("product_sk", T.LongType()),
    _field("customer_sk", T.LongType()),
    _field("seller_sk", T.LongType()),
    _field("price", MONEY),
    _field("freight_value", MONEY),
    _field("total_value", T.DecimalType(11, 2)),
])

AUDIT_LOG = T.StructType([
    _field("table_name", T.StringType()),
    _field("operation", T.StringType()),
    _field("sales_sk", T.LongType()),
    _field("time_sk", T.LongType()),
    _field("product_sk", T.LongType()),
    _field("price", MONEY),
    _field("created_at", T.TimestampType()),
])
