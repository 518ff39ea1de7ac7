"""Every registered query with SQL agrees with it on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLE[name]) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["top_categories", "rfm_segments", "recommend_hybrid", "recommend_category", "copurchase_pairs"])
def test_no_cartesian_product(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
