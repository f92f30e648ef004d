"""Audit log of rows inserted into the sales fact.

New fact rows are appended as files to an increments folder. A file stream logs each
of them once: the stream's checkpoint remembers the files read, and the Parquet sink
commits each batch as a whole. The initial load lies elsewhere, so it is not logged;
updates and deletes are not captured.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalwatch.operators.audit import audit_monitor, audit_rows, numbered_log
from signalwatch.schemas import AUDIT_LOG, FACT_SALES


def create_increments(spark: SparkSession, increments: str) -> None:
    """Make sure the watched folder exists, adding no rows."""
    spark.createDataFrame([], FACT_SALES).write.mode("append").parquet(increments)


def start_audit(spark: SparkSession, increments: str, log: str, checkpoint: str,
                files_per_batch: int | None = None, every: str | None = None) -> StreamingQuery:
    """Log all rows that arrived since the last run, then stop.

    ``files_per_batch`` bounds a batch when a long backlog waits. ``every``, such as
    "10 seconds", keeps the stream running and looks for new rows that often.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    reader = spark.readStream.schema(FACT_SALES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        audit_rows(reader.parquet(increments))
        .writeStream.format("parquet")
        .option("path", log)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def run_audit(spark: SparkSession, increments: str, log: str, checkpoint: str,
              files_per_batch: int | None = None) -> None:
    start_audit(spark, increments, log, checkpoint, files_per_batch).awaitTermination()


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The log as written, without running numbers; empty before the first entry."""
    try:
        return spark.read.schema(AUDIT_LOG).parquet(log)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], AUDIT_LOG)


def read_numbered_log(spark: SparkSession, log: str) -> DataFrame:
    return numbered_log(read_log(spark, log))


def run_monitor(spark: SparkSession, log: str, monitor: str, checkpoint: str) -> None:
    """Add what was logged since the last run to the stored summary, then stop.

    Totals are kept as the stream's state, so the log is read once. Each batch writes the totals that
    changed to a folder of its own; a batch that is run again writes the same ones there.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{monitor}/batch={batch_id}")

    totals = spark.readStream.schema(AUDIT_LOG).parquet(log).groupBy("table_name", "operation").agg(
        F.count("*").alias("total_operations"), F.max("created_at").alias("last_operation"))
    (
        totals.writeStream.foreachBatch(write).outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    )


_MONITOR = ("table_name string, operation string, total_operations long, last_operation timestamp, "
            "batch long")


def read_monitor(spark: SparkSession, monitor: str) -> DataFrame:
    """What :func:`audit_monitor` gives, from the newest totals of each table and operation."""
    try:
        stored = spark.read.schema(_MONITOR).parquet(monitor)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], _MONITOR)
    newest = F.max_by(F.struct("total_operations", "last_operation"), "batch").alias("newest")
    return stored.groupBy("table_name", "operation").agg(newest) \
        .select("table_name", "operation", "newest.*").orderBy(F.col("last_operation").desc())


def register_monitor(spark: SparkSession, log: str, view: str = "audit_monitor") -> None:
    """Create or replace the view that summarises the log."""
    audit_monitor(read_log(spark, log)).createOrReplaceTempView(view)
