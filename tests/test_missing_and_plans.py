"""NaN as a missing value, and plans that grow with the lookups in them."""

import math

import pytest

import __spark_entry__ as entry
from basketlens.operators import cleaning, kpis, profiling
from tests.conftest import rows
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def with_nan(spark):
    return spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (math.nan,)], "x double")


def test_nan_counts_as_missing(with_nan):
    assert rows(kpis.missing_values({"t": with_nan})) == [("t", "x", 5, 1, 20.0)]
    assert profiling.profile_columns(with_nan).first()["missing"] == 1
    assert [r["issue"] for r in profiling.quality_issues(with_nan).collect()] == ["Missing Values"]
    assert [r["problem"] for r in profiling.improvement_plan(with_nan).collect()][0] == "missing values"
    assert cleaning.drop_sparse_columns(with_nan, 0.1).columns == []


def test_nan_is_no_outlier_and_spoils_no_scale(with_nan):
    assert profiling.iqr_outliers(with_nan).first()["outliers"] == 0
    assert rows(cleaning.winsorize(with_nan, ["x"])) == rows(with_nan.filter("x < 5")) + [(None,)]
    assert cleaning.remove_outliers(with_nan, ["x"]).count() == 4
    assert sorted((r["x"] for r in cleaning.minmax_scale(with_nan, ["x"]).collect() if r["x"] is not None)) == pytest.approx([0, 1 / 3, 2 / 3, 1])
    assert sum(r["x"] is None for r in cleaning.standard_scale(with_nan, ["x"]).collect()) == 1


@pytest.mark.parametrize("name", ["merged_order_facts", "category_affinity", "price_sensitivity", "recommend_popular"])
def test_lookups_do_not_multiply_scans(spark, no_broadcast, name):
    scans = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans <= 24


@pytest.mark.parametrize("name", ["merged_order_facts", "category_affinity", "price_sensitivity", "customer_purchase_history"])
def test_large_dimensions_give_the_same(spark, no_broadcast, name):
    assert compare(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) == ""
