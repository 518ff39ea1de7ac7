import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.functions.joins import hot_keys, lookup
from basketlens.functions.ordering import exact_quantiles, global_rank, rank_in_group, running_totals
from basketlens.functions.scalars import whole_days
from tests.conftest import rows


@pytest.mark.parametrize("passes", [0, 1, 2])
def test_quantiles_equal_numpy(spark, passes):
    rng = random.Random(3)
    values = [rng.choice([1.5, rng.gauss(0, 1e6), rng.random(), None, float("nan")]) for _ in range(800)]
    df = spark.createDataFrame([(v, 7) for v in values], "a double, b int")
    probs = [0.0, 0.2, 0.25, 0.5, 0.9, 1.0]
    found = {r["column"]: r for r in exact_quantiles(df, ["a", "b"], probs, passes).collect()}
    known = [v for v in values if v is not None and v == v]
    assert found["a"]["n"] == len(known)
    np.testing.assert_allclose(found["a"]["quantiles"], np.quantile(known, probs), rtol=1e-12)
    assert found["b"]["quantiles"] == [7.0] * 6


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "a double"), ["a"], [0.5]).collect() == []


def test_ranks_without_a_single_task(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 100).alias("v"), (F.col("id") % 3).alias("g"))
    found = global_rank(df, [F.desc("v"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, 1001))
    assert [(-r["v"], r["id"]) for r in found] == sorted((-r["v"], r["id"]) for r in found)
    groups = rank_in_group(df, "g", [F.asc("v"), F.asc("id")])
    for g in range(3):
        part = groups.filter(F.col("g") == g).orderBy("v", "id").collect()
        assert [r["rank"] for r in part] == list(range(1, len(part) + 1))
    plan = found and global_rank(df, [F.asc("id")])._jdf.queryExecution().toString()
    assert "Window" not in plan.split("Physical Plan")[0].split("Join")[0]


def test_running_totals(spark):
    df = spark.createDataFrame([(i, i * i % 11, 1) for i in range(300)], "k int, x long, y long")
    before = 0
    for r in running_totals(df, [F.asc("k")], ["x", "y"]).orderBy("k").collect():
        assert (r["x_before"], r["y_before"]) == (before, r["k"])
        before += r["x"]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_spreads_hot_keys(spark, no_broadcast, how):
    # key 0 holds a third of the rows, key 99 has no match, some keys are null
    facts = spark.createDataFrame(
        [(0 if i % 3 == 0 else (None if i % 7 == 0 else i % 40 if i % 11 else 99), i) for i in range(900)], "k int, v int"
    )
    dim = spark.createDataFrame([(k, f"name {k}") for k in range(40)], "k int, name string")
    found = lookup(facts, dim, "k", how, hot_limit=10)
    assert rows(found.select("k", "v", "name")) == rows(facts.join(dim, "k", how).select("k", "v", "name"))
    # key 0 is cut into pieces of a tenth of the rows that have a key
    assert rows(hot_keys(facts, ["k"], 10)) == [(0, 4)]
    assert "_salt" in found._jdf.queryExecution().toString()


def test_days_are_24_hours(spark):
    df = spark.sql(
        "SELECT timestamp_ntz '2020-01-01 10:00:00' AS a, timestamp_ntz '2020-01-03 09:00:00' AS b"
    ).select(whole_days(F.col("a"), F.col("b")).alias("up"), whole_days(F.col("b"), F.col("a")).alias("down"))
    assert rows(df) == [(1, -2)]
