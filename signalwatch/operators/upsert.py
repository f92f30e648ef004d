"""Rows merged into a stored table by key, the latest of each key staying.

The table lies in hash buckets of its keys, a folder each. A batch touches some buckets; only these are
read, merged and replaced. A merge is complete in a folder beside the table before anything is replaced,
so one that was broken off is finished by the next call.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalwatch.storage import drop, exists

BUCKET = "bucket"
#: Hash buckets of a new table; for large data, so many that one holds a few hundred MB.
BUCKETS = 32


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str],
           by: Sequence[str] = ()) -> DataFrame:
    """One row for each key: the greatest by ``order`` (nulls least), then by all other columns.

    A null key is a key. Each task passes on one row of a key, however many there are.
    """
    others = [c for c in rows.columns if c not in {*keys, *by}]
    rest = F.struct(*others)
    first = F.struct(*order, *[c for c in others if c not in order])
    return rows.groupBy(*by, *keys).agg(F.max_by(rest, first).alias("latest")) \
        .select(*[F.col(f"latest.{c}").alias(c) if c in others else F.col(c) for c in rows.columns])


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _merged(path: str) -> str:
    return f"{path.rstrip('/')}.merged"


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])) \
        .parquet(path)


def _finish(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Replace the buckets of a merge that is complete beside the table; drop one that is not."""
    if exists(spark, f"{_merged(path)}/_SUCCESS"):
        _stored(spark, _merged(path), schema).write.mode("overwrite").partitionBy(BUCKET) \
            .option("partitionOverwriteMode", "dynamic").parquet(path)
    drop(spark, _merged(path))


def upsert(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
           order: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Merge a batch into the table at ``path`` and return the table.

    A row replaces the stored one of its key if it is greater by ``order``, then by all other columns;
    so batches may come in any order, and twice. ``buckets`` holds for a new table and must stay. A
    column that stored rows do not have is null there. One call at a time may change a table.
    """
    _finish(spark, path, batch.schema)
    new = latest(batch, keys, order).withColumn(BUCKET, bucket_of(keys, buckets))
    rows = new
    if exists(spark, path):
        touched = [r[BUCKET] for r in new.select(BUCKET).distinct().collect()]  # at most ``buckets``
        rows = new.unionByName(_stored(spark, path, batch.schema).where(F.col(BUCKET).isin(touched)))
    # one exchange by bucket serves the merge and the files
    latest(rows.repartition(BUCKET), keys, order, by=[BUCKET]) \
        .write.mode("overwrite").partitionBy(BUCKET).parquet(_merged(path))
    _finish(spark, path, batch.schema)
    return _stored(spark, path, batch.schema).drop(BUCKET)
