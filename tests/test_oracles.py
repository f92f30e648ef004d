import pytest

import __spark_entry__ as entry
from compare import connect, difference
from conftest import DATA

from signalwatch.plans.catalog import QUERIES
from signalwatch.plans.oracles import oracles

SQL = oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(SQL) == {"model_comparison", "feature_importance", "run_summary",
                                       "regularised_comparison"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, DATA).toPandas()
    assert len(ours)
    if name in SQL:
        assert difference(ours, duck.execute(SQL[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 5
