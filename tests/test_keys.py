import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalwatch.operators.keys import check_key, dense_key, require_dense_key, require_key


def test_order_with_missing_last_and_duplicates_kept(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("a",)], "id string")
    got = sorted((r.sk, r.id) for r in dense_key(df, "sk", ["id"]).collect())
    assert got == [(1, "a"), (2, "a"), (3, "b"), (4, None)]


def test_equals_a_row_number_over_everything(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 7).alias("day"), F.expr("uuid()").alias("name"), "id"
    ).repartition(7, "id").cache()
    got = dense_key(df, "sk", ["day", "name"]).toPandas().sort_values("sk")
    expected = df.toPandas().sort_values(["day", "name"])
    assert got["sk"].tolist() == list(range(1, 20_001))
    assert got["id"].tolist() == expected["id"].tolist()


def test_any_order_is_dense_and_whole(spark):
    df = spark.range(5_000).repartition(9).where("id % 3 = 0")
    got = dense_key(df, "sk").toPandas()
    assert sorted(got["sk"]) == list(range(1, len(got) + 1))
    assert sorted(got["id"]) == list(range(0, 5_000, 3))


def test_hot_copies_are_spread_over_tasks(spark, tmp_path, setting):
    """A value on two thirds of all rows does not end in one task."""
    setting(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8")
    path = str(tmp_path / "rows")
    spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("v")
    ).write.parquet(path)
    keyed = dense_key(spark.read.parquet(path), "sk", ["v"])
    rows = keyed.toPandas().sort_values("sk")
    assert rows["sk"].tolist() == list(range(1, 60_001))
    assert rows["v"].is_monotonic_increasing
    files = keyed.where("v = 'hot'").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 2


def test_empty(spark):
    empty = spark.createDataFrame([], "id string")
    assert dense_key(empty, "sk", ["id"]).collect() == []
    assert dense_key(empty, "sk").columns == ["sk", "id"]


def test_unused_key_is_not_read(spark):
    keyed = dense_key(spark.range(10).withColumnRenamed("id", "v"), "sk", ["v"])
    plan = keyed.select("v")._jdf.queryExecution().executedPlan().toString()
    assert "_place" not in plan and "_starts" not in plan


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=30),
       parts=st.integers(1, 5))
def test_dense_for_any_input(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(parts)
    got = sorted((r.sk, r.v) for r in dense_key(df, "sk", ["v"]).collect())
    expected = sorted(values, key=lambda v: (v is None, v or 0))
    assert got == list(enumerate(expected, 1))


def test_check_key(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "sk long")
    assert check_key(df, "sk").first().asDict() == {
        "n_rows": 4, "n_null": 1, "n_dup": 1, "min_key": "1", "max_key": "2",
    }
    with pytest.raises(ValueError, match="1 missing, 1 repeated"):
        require_key(df, "sk")
    good = spark.range(3)
    assert require_key(good, "id") is good


def test_dense_key_check(spark):
    require_dense_key(spark.range(1, 1001).withColumnRenamed("id", "sk"), "sk")
    require_dense_key(spark.range(0).withColumnRenamed("id", "sk"), "sk")
    for bad in ([1, 2, 2, 4], [1, 2, None], [0, 1, 2], [2, 3, 4], [1, 1, 4, 4], [1, 2, 3, 3, 6, 6]):
        rows = spark.createDataFrame([(v,) for v in bad], "sk long")
        with pytest.raises(ValueError, match="no primary key"):
            require_dense_key(rows, "sk")
