import pytest

import __spark_entry__ as entry
from check import connect, differences
from lumenfold.catalog import oracle
from lumenfold.catalog import queries as catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert catalog.ALL.keys() == oracle.ALL.keys()
    assert catalog.ALL.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(catalog.ALL))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert differences(df.toPandas(), duck.execute(entry.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["word", "beta", "p", "n", "side"]
