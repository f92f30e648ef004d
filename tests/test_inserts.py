import pytest
from conftest import DATA
from pyspark.sql import functions as F

from signalwatch.operators.daily import daily_from_parts, daily_sales
from signalwatch.plans import catalog, features
from signalwatch.plans.warehouse import (
    append_sales,
    insert_sales,
    require_insert_keys,
    with_inserts,
)
from signalwatch.schemas import CATEGORY
from signalwatch.storage import fresh_path
from signalwatch.streaming.audit import create_increments


@pytest.fixture
def loaded(spark):
    place = f"{fresh_path(spark, 'inserts')}/increments"
    create_increments(spark, place)
    return catalog.warehouse(spark, DATA), place


def test_nothing_inserted(spark, loaded):
    w, place = loaded
    whole = with_inserts(spark, w, place)
    assert whole["category_codes"] is w["category_codes"]
    assert whole["fact_sales"].count() == w["fact_sales"].count()
    require_insert_keys(spark, w["fact_sales"], place)


def test_sums_by_day_are_those_of_all_rows(spark, loaded):
    w, place = loaded
    fact = w["fact_sales"]
    for share in (3, 5):
        insert_sales(with_inserts(spark, w, place)["fact_sales"],
                     fact.where(F.col("product_sk") % share == 0).drop("sales_sk"), place)
        require_insert_keys(spark, fact, place)
    whole = with_inserts(spark, w, place)
    found = daily_from_parts(whole["day_parts"])
    expected = daily_sales(whole["fact_sales"], w["dim_product"])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    scanned = found._jdf.queryExecution().optimizedPlan().toString()
    files = [f for f in found.inputFiles()]
    assert not any("/fact_sales/" in f for f in files), scanned
    assert any("/increments/" in f for f in files) and any("/day_parts/" in f for f in files)


def test_a_category_that_is_first_sold_by_an_insert_keeps_its_rows(spark, loaded):
    w, place = loaded
    sold = features.category_codes(w["day_parts"]).select(CATEGORY)
    product = w["dim_product"].withColumn(CATEGORY, F.when(
        F.col("product_sk") % 50 == 7, "A NEW ONE").otherwise(F.col(CATEGORY)))
    new = w["fact_sales"].where("product_sk % 50 = 7")
    assert new.count() and "A NEW ONE" not in {r[0] for r in sold.collect()}
    w = type(w)(w | {"dim_product": product})
    insert_sales(w["fact_sales"], new.drop("sales_sk"), place)
    whole = with_inserts(spark, w, place)
    codes = {r[0]: r[1] for r in whole["category_codes"].select(CATEGORY, "category_code").collect()}
    assert codes["A NEW ONE"] == 0 and sorted(codes.values()) == list(range(len(codes)))
    days = daily_from_parts(whole["day_parts"])
    found = features.features_of_days(days, w["dim_time"], w["dim_trend"], w["dim_review"],
                                      whole["category_codes"])
    assert found.count() == days.count()
    assert found.where(F.col(CATEGORY) == "A NEW ONE").agg(F.sum("sales_volume")).first()[0] > 0


def test_two_inserts_at_a_time_are_found(spark, loaded):
    w, place = loaded
    fact = w["fact_sales"]
    more = fact.orderBy("sales_sk").limit(5).drop("sales_sk")
    insert_sales(fact, more, place)
    insert_sales(fact, more, place)  # read the same greatest key
    with pytest.raises(ValueError, match="sales_sk is no primary key"):
        require_insert_keys(spark, fact, place)


def test_a_hole_in_the_keys_is_found(spark, loaded):
    w, place = loaded
    append_sales(w["fact_sales"].limit(3).withColumn("sales_sk", F.col("sales_sk") + 10**6), place)
    with pytest.raises(ValueError):
        require_insert_keys(spark, w["fact_sales"], place)
