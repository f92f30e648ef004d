"""Audit rows for inserts into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.operators.keys import dense_key


def inserted_rows(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key ``old`` does not have."""
    return new.join(old.select(key), key, "left_anti").select(*new.columns)


def audit_rows(inserted: DataFrame, table: str = "fact_sales",
               operation: str = "INSERT") -> DataFrame:
    """One audit row per inserted row, stamped with the time of the batch."""
    return inserted.select(
        F.lit(table).alias("table_name"),
        F.lit(operation).alias("operation"),
        "sales_sk", "time_sk", "product_sk", "price",
        F.current_timestamp().alias("created_at"),
    )


def numbered_log(log: DataFrame) -> DataFrame:
    """The log with its running number, oldest entry first."""
    return dense_key(log, "log_id", ["created_at", "sales_sk"])


def audit_monitor(log: DataFrame) -> DataFrame:
    """How many operations of each kind there were, and when the last one was."""
    return (
        log.groupBy("table_name", "operation")
        .agg(
            F.count("*").alias("total_operations"),
            F.max("created_at").alias("last_operation"),
        )
        .orderBy(F.col("last_operation").desc())
    )
