"""Staging tables from source files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from signalwatch.operators.quality import accepted, checked, conform, rejected
from signalwatch.schemas import STAGING
from signalwatch.sources.files import scan_csv, scan_json
from signalwatch.storage import save, settle, together

SOURCE_FILES = {
    "orders": "orders.csv",
    "order_items": "order_items.csv",
    "products": "products.csv",
    "customers": "customers.csv",
    "sellers": "sellers.csv",
    "trends": "trends.csv",
    "reviews": "reviews.json",
}


def raw_table(spark: SparkSession, folder: str, table: str,
              names: Mapping[str, str] = SOURCE_FILES, strict: bool = True,
              multiline: bool = False) -> DataFrame:
    """The columns a staging table needs, as text: conforming happens in one place."""
    path, columns = f"{folder}/{names[table]}", STAGING[table].fieldNames()
    if path.endswith((".json", ".jsonl")):
        text = T.StructType([T.StructField(name, T.StringType()) for name in columns])
        return scan_json(spark, path, text, array=path.endswith(".json"), strict=strict)
    return scan_csv(spark, path, columns, multiline, strict)


def stage(spark: SparkSession, folder: str, target: str,
          names: Mapping[str, str] = SOURCE_FILES,
          strict: bool = True, multiline: bool = False) -> dict[str, DataFrame]:
    """Drop and recreate every staging table under ``target`` from the files in ``folder``.

    ``strict`` fails on the first bad value or record; otherwise bad rows go to
    ``<target>/rejected/<table>`` with the names of their bad columns, and records that do not fit
    their file's header as they were. ``multiline`` allows line breaks in quoted CSV fields.
    """
    def load(table: str) -> DataFrame:
        schema, raw = STAGING[table], raw_table(spark, folder, table, names, strict,
                                                   multiline)
        if strict:
            return save(conform(raw, schema), f"{target}/{table}")
        # stored once, so that the files are read and parsed once for both parts
        rows = settle(checked(raw, schema), f"checked-{table}")
        save(rejected(rows), f"{target}/rejected/{table}")
        return save(accepted(rows), f"{target}/{table}")

    return together(spark, {table: partial(load, table) for table in STAGING})


def append(df: DataFrame, path: str, table: str) -> None:
    """Append conformed rows to a staging table."""
    conform(df, STAGING[table]).write.mode("append").parquet(path)
