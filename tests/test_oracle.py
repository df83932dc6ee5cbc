"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle_check import compare, connect
from ticketlake_queries.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert compare(df, con, entry.oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "MapInArrow", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan  # everything runs in the JVM, nothing multiplies tables


def test_childless_companies_exist_at_the_next_scale(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    con = connect(sf_dir)
    df = entry.queries()["childless_companies"](spark, sf_dir)
    assert compare(df, con, entry.oracle_sql()["childless_companies"]) is None
    assert df.count() == 75


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
