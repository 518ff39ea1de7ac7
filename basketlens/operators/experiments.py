"""A/B tests: assignment by hash, results per variant, significance."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.scalars import ratio

CI_FACTOR = 1.96  # fixed value: 95 % whatever alpha is
INSUFFICIENT = "insufficient data"


def variant_index(user: Column, experiment: Column, n: int) -> Column:
    """The 128-bit md5 of "user_experiment" modulo ``n``, folded in four
    32-bit pieces so that nothing exceeds a long."""
    digest = F.md5(F.concat(user.cast("string"), F.lit("_"), experiment))
    index = F.lit(0).cast("long")
    for piece in range(4):
        word = F.conv(F.substring(digest, 1 + 8 * piece, 8), 16, 10).cast("long")
        index = (index * (1 << 32) + word) % n
    return index


def assign_variant(users: DataFrame, experiment: str | Column, variants: Sequence[str], user: str = "user_id") -> DataFrame:
    """Add ``variant``: always the same for a user and an experiment."""
    name = F.lit(experiment) if isinstance(experiment, str) else experiment
    names = F.array(*[F.lit(v) for v in variants])
    return users.withColumn("variant", F.element_at(names, (variant_index(F.col(user), name, len(variants)) + 1).cast("int")))


def experiment_results(conversions: DataFrame, variants: Sequence[str] | None = None) -> DataFrame:
    """Tracked rows, conversions and values per experiment and variant.

    ``conversions`` is (experiment, variant, converted, value).  Variants
    listed but never tracked appear with zeros.
    """
    found = conversions.groupBy("experiment", "variant").agg(
        F.count("*").alias("users"),
        F.count_if("converted").alias("conversions"),
        F.avg(F.col("converted").cast("int")).alias("conversion_rate"),
        F.avg("value").alias("avg_value"),
        F.sum(F.col("value").cast("decimal(28,6)")).cast("double").alias("total_value"),
    )
    if variants is None:
        return found
    expected = conversions.select("experiment").distinct().select(
        "experiment", F.explode(F.array(*[F.lit(v) for v in variants])).alias("variant")
    )
    return expected.join(found, ["experiment", "variant"], "left").na.fill(0)


@F.pandas_udf(T.DoubleType())
def _two_sided_p(z: pd.Series) -> pd.Series:
    """2 * (1 - normal CDF of |z|); one value per experiment."""
    return z.map(lambda score: math.erfc(abs(score) / math.sqrt(2.0)), na_action="ignore")


def significance(results: DataFrame, variant_a: str, variant_b: str, alpha: float = 0.05) -> DataFrame:
    """Pooled two-proportion z-test of b against a, one row per experiment."""
    sides = results.filter(F.col("variant").isin(variant_a, variant_b)).groupBy("experiment").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("variant") == name, F.col(column))), F.lit(0)).alias(f"{short}_{side}")
            for side, name in (("a", variant_a), ("b", variant_b))
            for short, column in (("n", "users"), ("x", "conversions"))
        ]
    )
    n_a, n_b, x_a, x_b = F.col("n_a"), F.col("n_b"), F.col("x_a"), F.col("x_b")
    rates = sides.withColumn("rate_a", ratio(x_a, n_a)).withColumn("rate_b", ratio(x_b, n_b))
    difference = F.col("rate_b") - F.col("rate_a")
    pooled = ratio(x_a + x_b, n_a + n_b)
    spread = F.when((n_a > 0) & (n_b > 0), pooled * (1 - pooled) * (ratio(F.lit(1), n_a) + ratio(F.lit(1), n_b)))
    scored = rates.withColumn("se", F.sqrt(spread)).withColumn(
        "z_score", F.when(F.col("se") == 0, F.lit(0.0)).otherwise(F.try_divide(difference, F.col("se")))
    )
    return scored.withColumn("p_value", _two_sided_p(F.col("z_score"))).select(
        "experiment",
        F.lit(variant_a).alias("variant_a"),
        F.lit(variant_b).alias("variant_b"),
        "n_a",
        "n_b",
        "rate_a",
        "rate_b",
        F.when(F.col("rate_a") > 0, difference / F.col("rate_a") * 100).when(F.col("se").isNotNull(), 0.0).alias("uplift_percent"),
        "z_score",
        "p_value",
        (F.col("p_value") < alpha).alias("is_significant"),
        (difference - CI_FACTOR * F.col("se")).alias("ci_lower"),
        (difference + CI_FACTOR * F.col("se")).alias("ci_upper"),
        F.when(F.col("se").isNull(), INSUFFICIENT).alias("note"),
    )


def experiment_report(conversions: DataFrame, variants: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Results of every experiment with the test of its first two variants."""
    results = experiment_results(conversions, variants)
    tests = significance(results, variants[0], variants[1], alpha)
    return results.join(
        tests.select("experiment", "uplift_percent", "z_score", "p_value", "is_significant", "note"), "experiment", "left"
    )
