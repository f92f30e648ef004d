"""Raw events brought into a first layer, as a stream.

Files of events arrive in a landing folder, out of order and sometimes twice. Three streams, each with
its own checkpoint, take them on:

1. *Arrival* sets rows aside that come too late: more than ``DELAY`` behind the newest event of earlier
   batches. A stateful stream would drop them without a word. A batch is written to a folder of its own
   and can be run again.
2. *Bronze* keeps the first row of each event, by a watermark: ids are remembered only as long as a
   copy can still come.
3. *Windows* adds up bronze events by event time, and appends a window once it is complete.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalwatch.storage import exists

#: How far an event may lie behind the newest one, and how far copies of one may lie apart.
DELAY = "2 hours"
WINDOW = "1 hour"

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


@dataclass(frozen=True)
class Layer:
    """The folders of one layer below ``root``."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def arrived(self) -> str:
        return f"{self.root}/arrived"

    @property
    def clock(self) -> str:
        return f"{self.root}/clock"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def windows(self) -> str:
        return f"{self.root}/windows"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def event_rows(table: DataFrame) -> DataFrame:
    """A table's events in the declared types; times are instants."""
    return table.select(*[F.col(f.name).cast(f.dataType) for f in EVENTS])


def create(spark: SparkSession, layer: Layer) -> None:
    """Make sure that the watched folder exists, adding no rows."""
    if not exists(spark, layer.landing):
        spark.createDataFrame([], EVENTS).write.parquet(layer.landing)


def land(events: DataFrame, layer: Layer) -> None:
    """Events arrive: new files in the landing folder."""
    event_rows(events).write.mode("append").parquet(layer.landing)


def _newest_before(spark: SparkSession, layer: Layer, batch_id: int) -> Column:
    """The newest event time of earlier batches, as a literal; null for the first batch."""
    newest = None
    if exists(spark, layer.clock):
        newest = spark.read.schema("newest timestamp, batch long").parquet(layer.clock) \
            .where(F.col("batch") < batch_id).agg(F.max("newest").cast("string")).first()[0]
    return F.lit(newest).cast("timestamp")


def _timely(batch: DataFrame, batch_id: int, layer: Layer, delay: str) -> None:
    spark = batch.sparkSession
    horizon = _newest_before(spark, layer, batch_id) - F.expr(f"interval {delay}")
    late = F.col("ts").isNull() | F.coalesce(F.col("ts") < horizon, F.lit(False))
    place = f"{layer.arrived}/batch={batch_id}"
    batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(place)
    spark.read.schema("ts timestamp").parquet(place).agg(F.max("ts").alias("newest")) \
        .write.mode("overwrite").parquet(f"{layer.clock}/batch={batch_id}")


def arrive(spark: SparkSession, layer: Layer, delay: str = DELAY,
           files_per_batch: int | None = None) -> None:
    """Split what has landed since the last run into rows on time and late ones, then stop.

    A row is late if its time is more than ``delay`` before the newest one of earlier batches, or
    missing. Batches that are run again after a failure write the same rows to the same place.
    """
    reader = spark.readStream.schema(EVENTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    (
        reader.parquet(layer.landing).writeStream
        .foreachBatch(lambda batch, batch_id: _timely(batch, batch_id, layer, delay))
        .option("checkpointLocation", layer.checkpoint("arrive"))
        .trigger(availableNow=True).start().awaitTermination()
    )


def _write(rows: DataFrame, path: str, checkpoint: str) -> None:
    (
        rows.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start().awaitTermination()
    )


def to_bronze(spark: SparkSession, layer: Layer, delay: str = DELAY) -> None:
    """Append the first row of each event to the bronze table.

    Events without an id are one event. Copies further apart than ``delay`` are events of their own.
    Which of several copies in one batch stays is open; they should be equal.
    """
    on_time = spark.readStream.schema(EVENTS).parquet(f"{layer.arrived}/*/late=false")
    once = on_time.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    _write(once, layer.bronze, layer.checkpoint("bronze"))


def to_windows(spark: SparkSession, layer: Layer, delay: str = DELAY, width: str = WINDOW) -> None:
    """Append windows of event time that no row on time can fall into any more: ``window_start,
    event_type, n_events, total_value``."""
    counted = spark.readStream.schema(EVENTS).parquet(layer.bronze).withWatermark("ts", delay) \
        .groupBy(F.window("ts", width).alias("w"), "event_type") \
        .agg(F.count("*").alias("n_events"), F.sum("value").alias("total_value")) \
        .select(F.col("w.start").alias("window_start"), "event_type", "n_events", "total_value")
    _write(counted, layer.windows, layer.checkpoint("windows"))


def ingest(spark: SparkSession, layer: Layer, delay: str = DELAY, width: str = WINDOW) -> None:
    """Bring in all that has landed since the last run, then stop."""
    create(spark, layer)
    arrive(spark, layer, delay)
    to_bronze(spark, layer, delay)
    to_windows(spark, layer, delay, width)


def _read(spark: SparkSession, path: str, schema: T.StructType | str,
          base: str | None = None) -> DataFrame:
    try:
        return spark.read.schema(schema).option("basePath", base or path).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_bronze(spark: SparkSession, layer: Layer) -> DataFrame:
    return _read(spark, layer.bronze, EVENTS)


def read_late(spark: SparkSession, layer: Layer) -> DataFrame:
    """The rows that were set aside, with the ``batch`` they came in."""
    return _read(spark, f"{layer.arrived}/*/late=true",
                 T.StructType([*EVENTS.fields, T.StructField("batch", T.LongType())]), layer.arrived)


def read_windows(spark: SparkSession, layer: Layer) -> DataFrame:
    return _read(spark, layer.windows, "window_start timestamp, event_type string, n_events long,"
                                       " total_value double")
