"""Profiles by sketches: merging, batches, and how close they are."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.operators import profiling, sketches
from tests.conftest import rows

DDL = "name string, kind string, n long, x double, at timestamp, `odd.name` string"


def table(spark, n=6000):
    rng = np.random.default_rng(1)
    made = [(f"name {i % 2500}", "abc"[i % 3] if i % 7 else None, i, float(rng.normal()) if i % 5 else float("nan"), None, "z" * (2000 if i % 2 else 3)) for i in range(n)]
    return spark.createDataFrame(made, DDL).repartition(4)


def figures(profile):
    shown = [c for c in profile.columns if c not in ("n_distinct", "listed_values")]
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(profile.select(*shown))]


def test_sketch_profile_is_close_to_the_exact_one(spark):
    df = table(spark)
    exact, approx = profiling.profile_columns(df), profiling.profile_columns(df, approx=True)
    assert approx.columns == exact.columns and dict(approx.dtypes) == dict(exact.dtypes)
    assert figures(approx) == figures(exact)
    want, got = ({r["column"]: r for r in p.collect()} for p in (exact, approx))
    for name in ("name", "kind", "odd.name"):
        assert got[name]["n_distinct"] == pytest.approx(want[name]["n_distinct"], rel=sketches.ERROR_BOUND)
    assert got["kind"]["listed_values"] == want["kind"]["listed_values"] == "a|b|c"
    # values too long to be listed, and columns that are no text
    assert got["odd.name"]["listed_values"] is None and got["n"]["n_distinct"] is None


def test_merged_parts_equal_the_whole(spark):
    df = table(spark)
    parts = [df.filter(F.col("n") % 3 == k) for k in range(3)]
    merged = sketches.merged_sketches(sketches.profile_sketch(parts[0]).unionByName(sketches.profile_sketch(parts[1])).unionByName(sketches.profile_sketch(parts[2])))
    whole = sketches.profile_of(sketches.profile_sketch(df))
    assert figures(sketches.profile_of(merged)) == figures(whole)
    got, want = ({r["column"]: r.asDict() for r in p.collect()} for p in (sketches.profile_of(merged), whole))
    for name in want:
        assert got[name]["listed_values"] == want[name]["listed_values"]
        # the same registers; a merged sketch estimates by another formula
        assert got[name]["n_distinct"] == pytest.approx(want[name]["n_distinct"] or 0, rel=0.005) or want[name]["n_distinct"] is None


def test_batches_are_kept_and_replaced(spark, tmp_path):
    df, path = table(spark), str(tmp_path / "kept")
    sketches.add_to_profile(df.filter("n < 2000"), path, "monday")
    sketches.add_to_profile(df.filter("n >= 3000"), path, "tuesday")
    sketches.add_to_profile(df.filter("n >= 2000"), path, "tuesday")  # again, complete this time
    assert figures(sketches.kept_profile(spark, path)) == figures(profiling.profile_columns(df))
    assert spark.read.parquet(path).count() == 2 * len(df.columns)


def test_empty_table(spark):
    found = {r["column"]: r for r in profiling.profile_columns(table(spark, 3).limit(0), approx=True).collect()}
    assert found["name"]["rows"] == 0 and found["name"]["n_distinct"] == 0 and found["x"]["mean_value"] is None


def test_one_scan(spark, tmp_path):
    table(spark, 100).write.parquet(str(tmp_path / "t"))
    plan = sketches.profile_sketch(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
