from pyspark.sql import functions as F

from signalwatch.operators.audit import audit_monitor, audit_rows, inserted_rows, numbered_log
from signalwatch.plans.warehouse import append_sales
from signalwatch.streaming import audit


def sales(spark, start, n):
    return spark.range(start, start + n).select(
        F.col("id").alias("sales_sk"), F.lit(1).cast("long").alias("time_sk"),
        F.lit(2).cast("long").alias("product_sk"), F.lit(3).cast("long").alias("customer_sk"),
        F.lit(4).cast("long").alias("seller_sk"), F.lit("9.50").cast("decimal(10,2)").alias("price"),
        F.lit("0.50").cast("decimal(10,2)").alias("freight_value"),
        F.lit("10.00").cast("decimal(11,2)").alias("total_value"),
    )


def test_each_insert_is_logged_once(spark, tmp_path):
    increments, log, checkpoint = (str(tmp_path / n) for n in ("increments", "log", "checkpoint"))
    audit.create_increments(spark, increments)

    def run():
        audit.run_audit(spark, increments, log, checkpoint)
        return audit.read_log(spark, log).count()

    assert run() == 0
    append_sales(sales(spark, 1, 100), increments)
    assert run() == 100
    assert run() == 100
    append_sales(sales(spark, 101, 7), increments)
    assert run() == 107

    entries = audit.read_numbered_log(spark, log).collect()
    assert sorted(r.log_id for r in entries) == list(range(1, 108))
    assert sorted(r.sales_sk for r in entries) == list(range(1, 108))
    # the later batch has the later numbers
    assert {r.sales_sk for r in entries if r.log_id > 100} == set(range(101, 108))
    monitor = audit_monitor(audit.read_log(spark, log)).collect()
    assert [(r.table_name, r.operation, r.total_operations) for r in monitor] == [
        ("fact_sales", "INSERT", 107)
    ]
    assert monitor[0].last_operation == max(r.created_at for r in entries)
    audit.register_monitor(spark, log)
    assert spark.sql("SELECT total_operations FROM audit_monitor").first()[0] == 107


def test_a_long_backlog_is_read_in_bounded_batches(spark, tmp_path):
    increments, log, checkpoint = (str(tmp_path / n) for n in ("increments", "log", "checkpoint"))
    for start in (1, 11, 21):
        append_sales(sales(spark, start, 10).coalesce(1), increments)
    query = audit.start_audit(spark, increments, log, checkpoint, files_per_batch=1)
    query.awaitTermination()
    assert query.lastProgress["batchId"] == 2
    assert audit.read_log(spark, log).count() == 30


def test_a_running_stream_picks_up_later_inserts(spark, tmp_path):
    increments, log, checkpoint = (str(tmp_path / n) for n in ("increments", "log", "checkpoint"))
    append_sales(sales(spark, 1, 3), increments)
    query = audit.start_audit(spark, increments, log, checkpoint, every="1 second")
    try:
        query.processAllAvailable()
        append_sales(sales(spark, 4, 2), increments)
        query.processAllAvailable()
    finally:
        query.stop()
    assert audit.read_log(spark, log).count() == 5


def test_difference_of_two_loads(spark):
    old, new = sales(spark, 1, 5), sales(spark, 1, 8)
    logged = audit_rows(inserted_rows(new, old, "sales_sk"))
    assert sorted(r.sales_sk for r in logged.collect()) == [6, 7, 8]
    numbered = numbered_log(logged).collect()
    assert sorted((r.log_id, r.sales_sk) for r in numbered) == [(1, 6), (2, 7), (3, 8)]


def test_monitor_lists_the_latest_first(spark):
    log = spark.createDataFrame(
        [("a", "INSERT", "2024-01-01"), ("b", "INSERT", "2024-01-03"),
         ("a", "INSERT", "2024-01-02")], "table_name string, operation string, at string",
    ).withColumn("created_at", F.to_timestamp("at"))
    assert [(r.table_name, r.total_operations) for r in audit_monitor(log).collect()] == [
        ("b", 1), ("a", 2),
    ]
