"""Dense surrogate keys and key checks.

``row_number()`` over an unpartitioned window would send every row to one task.
A dense key here takes no such step:

1. sort globally if the key must follow an order (Spark's range exchange, split by
   all columns and by source split, so one repeated value does not fill one task);
   skip the sort when any order will do;
2. note each row's place - task number and position in the task - with
   ``monotonically_increasing_id`` and write the table, which freezes the places;
3. count rows per task, and add up: one number per write task, however many rows;
4. key = rows in earlier tasks + position + 1, an expression completed on reading.

The written table makes the result survive lost executors: nothing is numbered
twice from a shuffle that may come back in another order. The rows are written once,
and a reader that does not use the key reads neither the places nor the counts.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalwatch.storage import fresh_path, save

_PLACE = "_place"
_SPLIT = "_split"
_TASK = "_task"
_STARTS = "_starts"
# monotonically_increasing_id keeps the position in its lower 33 bits
_POSITION_BITS = 33


def _task(place: Column) -> Column:
    return F.shiftright(place, _POSITION_BITS).cast("int")


def _starts(rows: DataFrame) -> DataFrame:
    """One row: for each write task in turn, how many rows earlier tasks wrote."""
    counts = rows.groupBy(_task(F.col(_PLACE)).alias(_TASK)).agg(F.count("*").alias("n"))
    # from here on one row per write task; tasks that wrote nothing are filled in
    tasks = counts.agg(F.max(_TASK).alias("last")).select(
        F.explode(F.sequence(F.lit(0), F.col("last"))).alias(_TASK)
    )
    earlier = Window.orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long")
    running = tasks.join(counts, _TASK, "left").select(_TASK, before.alias("before"))
    ordered = F.array_sort(F.collect_list(F.struct(_TASK, "before")))
    return running.agg(F.transform(ordered, lambda task: task["before"]).alias(_STARTS))


def write_keyed(df: DataFrame, path: str, order_by: Sequence[str] | None = None) -> None:
    """Write ``df`` to ``path`` with the places a dense key is made from."""
    if order_by:
        ties = [name for name in df.columns if name not in order_by]
        keys = [F.col(name).asc_nulls_last() for name in [*order_by, *ties]]
        placed = (
            df.withColumn(_SPLIT, F.spark_partition_id())
            .orderBy(*keys, F.col(_SPLIT))
            .drop(_SPLIT)
        )
    else:
        placed = df
    rows = save(placed.withColumn(_PLACE, F.monotonically_increasing_id()), f"{path}/rows")
    save(_starts(rows), f"{path}/starts")


def _numbered(spark: SparkSession, path: str, key: str, schema: T.StructType | None,
              between: tuple[int, int] | None = None) -> DataFrame:
    if schema is None:
        found = spark.read.parquet(f"{path}/rows").schema
        schema = T.StructType([field for field in found.fields if field.name != _PLACE])
    stored = T.StructType([*schema.fields, T.StructField(_PLACE, T.LongType())])
    starts_type = T.StructType([T.StructField(_STARTS, T.ArrayType(T.LongType()))])
    rows = spark.read.schema(stored).parquet(f"{path}/rows")
    place = F.col(_PLACE)
    if between:
        rows = rows.where(place.between(*between))
    starts = spark.read.schema(starts_type).parquet(f"{path}/starts").scalar()
    position = place.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    number = F.get(starts, _task(place)) + position + F.lit(1)
    return rows.select(number.alias(key), *schema.fieldNames())


def read_keyed(spark: SparkSession, path: str, key: str,
               schema: T.StructType | None = None) -> DataFrame:
    """The rows written by :func:`write_keyed`, led by their dense key ``1..n``.

    Without a ``schema`` the stored one is looked up.
    """
    return _numbered(spark, path, key, schema)


def read_key_range(spark: SparkSession, path: str, key: str, low: int, high: int,
                   schema: T.StructType | None = None) -> DataFrame:
    """The rows with keys from ``low`` to ``high`` (both included) of :func:`write_keyed`.

    Places grow with keys, so the range of keys is a range of places, which are stored: the filter
    reaches the scan, and files and row groups outside the range are not read.
    """
    starts = spark.read.parquet(f"{path}/starts").first()[_STARTS] or []  # one per write task

    def place(number: int) -> int:
        """Where key ``number`` lies, or would lie behind the last row."""
        # the last task whose rows start before it; a task that wrote nothing starts where the next does
        task = max(bisect_left(starts, number) - 1, 0)
        return (task << _POSITION_BITS) + number - 1 - (starts[task] if starts else 0)

    return _numbered(spark, path, key, schema, (place(max(low, 1)), place(max(high, 0))))


def dense_key(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Add a key ``1..n``, in ``order_by`` order (NULLs last) or in any order."""
    path = fresh_path(df.sparkSession, key)
    write_keyed(df, path, order_by)
    return read_keyed(df.sparkSession, path, key, df.schema)


def check_key(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows, missing keys and repeated keys ``df`` has."""
    return df.agg(
        F.count("*").alias("n_rows"),
        (F.count("*") - F.count(key)).alias("n_null"),
        (F.count(key) - F.count_distinct(F.col(key))).alias("n_dup"),
        F.min(key).cast("string").alias("min_key"),
        F.max(key).cast("string").alias("max_key"),
    )


def require_key(df: DataFrame, key: str) -> DataFrame:
    """Return ``df`` if ``key`` is a primary key of it, else raise."""
    found = check_key(df, key).first()
    if found["n_null"] or found["n_dup"]:
        raise ValueError(
            f"{key} is no primary key: {found['n_null']} missing, {found['n_dup']} repeated"
        )
    return df


def require_dense_key(df: DataFrame, key: str) -> DataFrame:
    """Return ``df`` if ``key`` runs from 1 to the number of rows, each once, else raise.

    One pass of sums, without a shuffle of the keys: as many keys as rows, the least and the greatest,
    and the sum and the exclusive or of all keys are those of 1 to n.
    """
    found = df.agg(
        F.count("*").alias("n_rows"), F.count(key).alias("n_keys"), F.min(key).alias("least"),
        F.max(key).alias("most"), F.sum(F.col(key).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(key).alias("mixed"),
    ).first()
    n = found["n_rows"]
    mixed = (n, 1, n + 1, 0)[n % 4]  # the exclusive or of 1 to n
    if n and (found["n_keys"], found["least"], found["most"], found["total"], found["mixed"]) != (
            n, 1, n, n * (n + 1) // 2, mixed):
        raise ValueError(f"{key} is no primary key from 1 to {n}: {found.asDict()}")
    return df
