"""Run a query and its SQL equivalent and compare rows, schema and values."""

from __future__ import annotations

import hashlib
import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _digest(frame: pd.DataFrame) -> str:
    frame = frame[sorted(frame.columns)]
    rows = sorted("|".join(map(repr, row)) for row in frame.astype(object).values.tolist())
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def _kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {c: frame[c].dtype.kind for c in sorted(frame.columns)}


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} vs {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    if _kinds(ours) != _kinds(theirs):
        return f"types {_kinds(ours)} vs {_kinds(theirs)}"
    if _digest(ours) != _digest(theirs):
        names = sorted(ours.columns)
        a = set("|".join(map(repr, r)) for r in ours[names].astype(object).values.tolist())
        b = set("|".join(map(repr, r)) for r in theirs[names].astype(object).values.tolist())
        return (f"values, {len(a - b)} and {len(b - a)} rows only on one side: "
                f"{sorted(a - b)[:2]} vs {sorted(b - a)[:2]}")
    return None


def main(folder: str, only: list[str]) -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="signalwatch-compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles, failed, connection = entry.oracle_sql(), 0, connect(folder)
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            ours = query(spark, folder).toPandas()
            spent = time.time() - start
            if name in oracles:
                found = difference(ours, connection.execute(oracles[name]).df())
            else:
                found = None if len(ours) else "no rows"
        except Exception as error:  # report and go on with the next query
            spent, found = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if found is None else 'FAIL'} {kind} {spent:6.2f}s {name} {found or ''}",
              flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
