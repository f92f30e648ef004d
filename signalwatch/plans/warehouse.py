"""Stored star schema tables: built once, read by every query."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.constants import DELIVERED
from signalwatch.operators.daily import day_parts
from signalwatch.operators.keys import (
    check_key,
    dense_key,
    read_keyed,
    require_dense_key,
    require_key,
    write_keyed,
)
from signalwatch.plans import star
from signalwatch.plans.features import category_codes
from signalwatch.schemas import FACT_SALES
from signalwatch.storage import drop, exists, save, together

PRIMARY_KEYS = {
    "dim_time": "time_sk",
    "dim_product": "product_sk",
    "dim_customer": "customer_sk",
    "dim_seller": "seller_sk",
    "dim_trend": "trend_sk",
    "dim_review": "review_sk",
    "fact_sales": "sales_sk",
}
# What a source row is known by; a repeated one repeats the facts that refer to it.
NATURAL_KEYS = {
    "dim_time": "full_date",
    "dim_product": "product_id",
    "dim_customer": "customer_id",
    "dim_seller": "seller_id",
}
#: Written last, so that half a build is not taken for a whole one.
_BUILT = "built"


class Warehouse(dict):
    """Table name -> DataFrame over stored files."""

    def register_views(self) -> None:
        """Make every table available to ``spark.sql`` under its name."""
        for name, df in self.items():
            df.createOrReplaceTempView(name)

    def key_report(self, keys: Mapping[str, str] = PRIMARY_KEYS) -> DataFrame:
        """One row per table: its rows, and how many keys are missing or repeated."""
        report = None
        for name, key in keys.items():
            row = check_key(self[name], key).withColumn("table_name", F.lit(name))
            report = row if report is None else report.unionByName(row)
        return report

    def check_primary_keys(self) -> None:
        for name, key in PRIMARY_KEYS.items():
            require_key(self[name], key)


def build(spark: SparkSession, staging: Mapping[str, DataFrame], path: str,
          delivered: str = DELIVERED) -> Warehouse:
    """Drop and recreate all star schema tables under ``path``.

    Each table is written once. Tables that do not need each other are built side by
    side, so a small dimension does not leave the cluster idle. Every primary key is checked;
    a build that does not end leaves no marker and cannot be reopened.
    """
    drop(spark, f"{path}/{_BUILT}")

    def stored(name: str, df: DataFrame) -> DataFrame:
        return save(df, f"{path}/{name}")

    def keyed(name: str, df: DataFrame, order_by: list[str] | None) -> DataFrame:
        write_keyed(df, f"{path}/{name}", order_by)
        return read_keyed(spark, f"{path}/{name}", PRIMARY_KEYS[name], df.schema)

    made = Warehouse(together(spark, {
        "dim_time": lambda: stored("dim_time", star.dim_time(staging["orders"])),
        "dim_product": lambda: keyed("dim_product", *star.product_rows(staging["products"])),
        "dim_customer": lambda: keyed("dim_customer", *star.customer_rows(staging["customers"])),
        "dim_seller": lambda: keyed("dim_seller", *star.seller_rows(staging["sellers"])),
        "staging_trends": lambda: stored("staging_trends", staging["trends"]),
        "staging_reviews": lambda: stored("staging_reviews", staging["reviews"]),
    }))
    time, product = made["dim_time"], made["dim_product"]
    made.update(together(spark, {
        "fact_sales": lambda: keyed("fact_sales", star.sales_rows(
            staging["order_items"], staging["orders"], time, product, made["dim_customer"],
            made["dim_seller"], delivered,
        ), None),
        "dim_trend": lambda: keyed("dim_trend", *star.trend_rows(made["staging_trends"], time)),
        "dim_review": lambda: keyed(
            "dim_review", *star.review_rows(made["staging_reviews"], time)
        ),
    }))
    made["day_parts"] = stored("day_parts", day_parts(made["fact_sales"], product))
    made["category_codes"] = stored("category_codes", category_codes(made["day_parts"]))
    together(spark, {
        name: lambda name=name, key=key: require_dense_key(made[name], key)
        for name, key in PRIMARY_KEYS.items()
    })
    save(spark.range(1), f"{path}/{_BUILT}")
    return made


def reopen(spark: SparkSession, path: str) -> Warehouse:
    """The tables an earlier run built under ``path``; fails if that build did not end."""
    if not exists(spark, f"{path}/{_BUILT}"):
        raise FileNotFoundError(f"no finished star schema under {path}")
    plain = ["dim_time", "staging_trends", "staging_reviews", "day_parts", "category_codes"]
    found = Warehouse({name: spark.read.parquet(f"{path}/{name}") for name in plain})
    for name, key in PRIMARY_KEYS.items():
        if name not in plain:
            found[name] = read_keyed(spark, f"{path}/{name}", key)
    return found


def append_sales(sales: DataFrame, path: str) -> None:
    """Append keyed fact rows to the folder the audit stream watches."""
    sales.select(*FACT_SALES.fieldNames()).write.mode("append").parquet(path)


def with_increments(spark: SparkSession, base: DataFrame, path: str) -> DataFrame:
    """The fact: what the load built, and all rows inserted since."""
    columns = FACT_SALES.fieldNames()
    return base.select(*columns).unionByName(spark.read.schema(FACT_SALES).parquet(path))


def with_inserts(spark: SparkSession, loaded: Warehouse, path: str) -> Warehouse:
    """The tables of a load with all rows inserted since.

    The sums by category and day are those of the load and of the inserted rows; the rows of the load
    are not added up again. Categories that were first sold by an insert have codes too, so codes may
    have moved since.
    """
    inserted = spark.read.schema(FACT_SALES).parquet(path)
    found = Warehouse(loaded)
    found["fact_sales"] = with_increments(spark, loaded["fact_sales"], path)
    found["day_parts"] = loaded["day_parts"].unionByName(day_parts(inserted, loaded["dim_product"]))
    if not inserted.isEmpty():
        found["category_codes"] = category_codes(found["day_parts"])
    return found


def require_insert_keys(spark: SparkSession, base: DataFrame, path: str) -> None:
    """Fail unless inserted rows have the keys above those of the load, each once.

    Two inserts at a time give the same keys; this finds it. Keys of the load are counted, not read.
    """
    key = PRIMARY_KEYS["fact_sales"]
    inserted = spark.read.schema(FACT_SALES).parquet(path)
    require_dense_key(inserted.withColumn(key, F.col(key) - F.lit(base.count())), key)


def insert_sales(fact: DataFrame, sales: DataFrame, path: str) -> None:
    """Insert fact rows without a key: they get the keys above the greatest of ``fact``.

    The rows are numbered where they lie, without a sort or a one-task step, and appended to the
    increments, which the fact and the audit stream both read. One insert at a time.
    """
    key = PRIMARY_KEYS["fact_sales"]
    most = fact.agg(F.max(key)).first()[0] or 0
    numbered = dense_key(sales.select(*[c for c in FACT_SALES.fieldNames() if c != key]), key)
    append_sales(numbered.withColumn(key, F.col(key) + F.lit(most)), path)
