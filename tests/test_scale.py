"""Plans and results where one key holds a large share of the rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from signalwatch.operators.daily import daily_sales
from signalwatch.plans import catalog
from signalwatch.schemas import CATEGORY

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(setting):
    """Treat the test tables as too large to broadcast, and small partitions as skewed."""
    setting(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A fact where one product has two thirds of the rows."""
    folder = tmp_path_factory.mktemp("hot")
    fact = spark.range(0, 30_000, 1, 6).select(
        (F.col("id") % 11 + 1).alias("time_sk"),
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id") % 500 + 2)
        .cast("long").alias("product_sk"),
        F.col("id").cast("decimal(10,2)").alias("price"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    product = spark.range(1, 600).select(
        F.col("id").alias("product_sk"), F.concat(F.lit("c"), F.col("id") % 5).alias(CATEGORY)
    )
    fact.write.parquet(f"{folder}/fact")
    product.write.parquet(f"{folder}/product")
    return spark.read.parquet(f"{folder}/fact"), spark.read.parquet(f"{folder}/product")


def test_hot_product_is_split_and_whole(hot, large):
    fact, product = hot
    joined = fact.join(product, "product_sk").groupBy(CATEGORY, "time_sk").agg(F.count("pad"))
    joined.collect()
    assert "skew=true" in plan(joined)

    got = {(r[CATEGORY], r.time_sk): (r.sales_volume, r.revenue)
           for r in daily_sales(fact, product).collect()}
    category = {r.product_sk: r[CATEGORY] for r in product.collect()}
    counts, sums = Counter(), Counter()
    for r in fact.collect():
        place = category[r.product_sk], r.time_sk
        counts[place] += 1
        sums[place] += float(r.price)
    assert got == {place: (counts[place], sums[place]) for place in counts}


def test_daily_sales_aggregate_before_they_shuffle(hot):
    text = plan(daily_sales(*hot))
    exchange = text.index("Exchange hashpartitioning")
    assert "partial_count(price" in text[exchange:]
    assert "pad" not in text  # unused columns are not read


@pytest.mark.parametrize("name", [
    "ml_frame", "daily_features", "daily_features_standalone", "category_alerts", "fact_sales",
    "signal_review", "audit_inserts", "category_spine", "ts_folds",
])
def test_no_cross_join_and_no_python(spark, name):
    df = catalog.QUERIES[name](spark, DATA)
    df.collect()
    text = plan(df)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["ml_frame", "daily_features", "top_alerts", "fact_sales"])
def test_same_result_without_broadcasts(spark, name, setting):
    def rows():
        return sorted(map(str, catalog.QUERIES[name](spark, DATA).collect()))

    catalog.warehouse(spark, DATA)
    expected = rows()
    setting(spark__sql__autoBroadcastJoinThreshold="-1",
            spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    df = catalog.QUERIES[name](spark, DATA)
    df.collect()
    assert "BroadcastHashJoin" not in plan(df)
    assert rows() == expected


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(catalog.fact_sales(spark, DATA))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "l_discount" not in text and "o_totalprice" not in text


def test_only_calendar_and_task_sized_windows_are_unpartitioned(spark):
    """No query over items or days runs a window without a partition."""
    for name in ("daily_features", "daily_features_standalone", "dim_trend", "ml_frame",
                 "category_alerts", "signal_shift_early", "holdout_split"):
        text = plan(catalog.QUERIES[name](spark, DATA))
        for line in text.splitlines():
            if "Window [" in line:
                assert CATEGORY in line.split("windowspecdefinition(")[1][:40]
