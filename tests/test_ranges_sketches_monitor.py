import random

import pytest
from pyspark.sql import functions as F

from signalwatch.operators.audit import audit_monitor
from signalwatch.operators.keys import read_key_range, read_keyed, write_keyed
from signalwatch.operators.sketches import ERROR_BOUND, day_sketches, distinct_of
from signalwatch.schemas import AUDIT_LOG
from signalwatch.storage import fresh_path
from signalwatch.streaming import audit


@pytest.mark.parametrize("order", [["v"], None])
def test_key_ranges_are_those_of_all_rows(spark, order):
    path = fresh_path(spark, "range")
    # some write tasks have no rows
    rows = spark.range(500).select((F.col("id") * 7 % 500).alias("v")).repartition(6).where("v % 5 < 3") \
        .union(spark.range(0)).union(spark.range(40).select((F.col("id") + 1000).alias("v")))
    write_keyed(rows, path, order)
    every = {r["k"]: r["v"] for r in read_keyed(spark, path, "k", rows.schema).collect()}
    assert sorted(every) == list(range(1, 341))
    rng = random.Random(2)
    ranges = [(1, 340), (1, 1), (340, 340), (-5, 3), (338, 900), (900, 990), (7, 6), (0, 0), (-9, -1)]
    ranges += [tuple(sorted((rng.randrange(1, 341), rng.randrange(1, 341)))) for _ in range(12)]
    for low, high in ranges:
        found = {r["k"]: r["v"] for r in read_key_range(spark, path, "k", low, high).collect()}
        assert found == {k: v for k, v in every.items() if low <= k <= high}


def test_key_ranges_reach_the_files(spark):
    path = fresh_path(spark, "range")
    write_keyed(spark.range(1000).withColumnRenamed("id", "v"), path, ["v"])
    plan = read_key_range(spark, path, "k", 100, 110)._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert any("GreaterThanOrEqual(_place" in line and "LessThanOrEqual(_place" in line
               for line in pushed)


def test_no_rows_have_no_range(spark):
    path = fresh_path(spark, "range")
    write_keyed(spark.range(0).withColumnRenamed("id", "v"), path, ["v"])
    assert read_key_range(spark, path, "k", 1, 10).count() == 0


def test_sketches_of_days_add_up(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 30).alias("day"), (F.xxhash64("id") % 9000).alias("v"))
    sketches = day_sketches(rows.union(rows).union(rows.select("day", F.lit(None).cast("long"))), "v",
                            ["day"])
    exact = rows.withColumn("week", F.expr("day div 7")).groupBy("week") \
        .agg(F.count_distinct("v").alias("n"))
    found = distinct_of(sketches.withColumn("week", F.expr("day div 7")), ["week"])
    pairs = exact.join(found, "week").collect()
    assert len(pairs) == 5
    assert all(abs(r["estimate"] - r["n"]) <= ERROR_BOUND * r["n"] for r in pairs)
    few = rows.where("day = 1").limit(10)
    assert distinct_of(day_sketches(few, "v", ["day"]), ["day"]).first()["estimate"] \
        == few.select("v").distinct().count()


def logged(spark, first, n, operation="INSERT"):
    return spark.range(first, first + n).select(
        F.lit("fact_sales").alias("table_name"), F.lit(operation).alias("operation"),
        F.col("id").alias("sales_sk"), F.lit(1).alias("time_sk"), F.lit(2).alias("product_sk"),
        F.lit(3).alias("price"), F.timestamp_seconds(F.col("id") + 10**9).alias("created_at"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in AUDIT_LOG])


def test_the_streamed_monitor_is_that_of_the_whole_log(spark):
    place = fresh_path(spark, "monitor")
    paths = f"{place}/log", f"{place}/monitor", f"{place}/totals"
    assert audit.read_monitor(spark, paths[1]).count() == 0
    for rows in (logged(spark, 0, 50), logged(spark, 50, 30).union(logged(spark, 90, 5, "DELETE"))):
        rows.write.mode("append").parquet(paths[0])
        audit.run_monitor(spark, *paths)
        expected = audit_monitor(audit.read_log(spark, paths[0])).collect()
        assert audit.read_monitor(spark, paths[1]).collect() == expected
    # a batch that is run again writes the same totals to the same place
    last = spark.read.parquet(f"{paths[1]}/batch=1").collect()
    spark.createDataFrame(last).write.mode("overwrite").parquet(f"{paths[1]}/batch=1")
    assert audit.read_monitor(spark, paths[1]).collect() == expected
    audit.run_monitor(spark, *paths)
    assert audit.read_monitor(spark, paths[1]).collect() == expected
