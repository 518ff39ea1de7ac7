"""The numbers behind each chart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.dataset import Dataset
from basketlens.functions.ordering import exact_quantiles, quantile_columns
from basketlens.functions.scalars import month_number, month_of, percent, quoted, total_of
from basketlens.operators.facts import person_of_customer
from basketlens.operators.kpis import monthly_orders, orders_per_person

PERSON = "customer_unique_id"


def retention_cohort(ds: Dataset, periods: int = 12) -> DataFrame:
    """People of each first-order month who ordered again ``period`` months
    later.  Orders shrink to one row per person and month first."""
    ts = F.col("order_purchase_timestamp")
    per_id = ds.orders.filter(ts.isNotNull()).select("customer_id", month_of(ts).alias("month")).distinct()
    active = (
        per_id.join(person_of_customer(ds), "customer_id")
        .filter(F.col(PERSON).isNotNull())
        .select(PERSON, "month")
        .distinct()
    )
    cohort = F.min("month").over(W.partitionBy(PERSON))
    period = month_number(F.col("month")) - month_number(F.col("cohort"))
    counts = (
        active.withColumn("cohort", cohort)
        .withColumn("period", period)
        .groupBy("cohort", "period")
        .agg(F.count("*").alias("customers"))
    )
    size = F.max(F.when(F.col("period") == 0, F.col("customers"))).over(W.partitionBy("cohort"))
    return (
        counts.withColumn("cohort_size", size)
        .withColumn("retention_pct", percent(F.col("customers"), F.col("cohort_size")))
        .filter(F.col("period") < periods)
    )


def retention_matrix(ds: Dataset, periods: int = 12) -> DataFrame:
    """Retention with one column per period, null where nobody returned."""
    wide = retention_cohort(ds, periods).groupBy("cohort").pivot("period", list(range(periods)))
    return wide.agg(F.first("retention_pct"))


def monthly_orders_trend(ds: Dataset) -> DataFrame:
    """Orders per month with the least-squares line over the months present."""
    # one row per calendar month: the window sees a few hundred rows
    numbered = monthly_orders(ds).withColumn("idx", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("month")) - 1)
    fit = numbered.agg(
        F.struct(F.regr_slope("orders", "idx").alias("slope"), F.regr_intercept("orders", "idx").alias("intercept"))
    ).scalar()
    return numbered.select(
        "month",
        "idx",
        "orders",
        (fit["intercept"] + fit["slope"] * F.col("idx")).alias("trend"),
        fit["slope"].alias("slope"),
        F.when(fit["slope"] > 0, "increasing").otherwise("decreasing").alias("direction"),
    )


def price_histogram(df: DataFrame, column: str = "price", bins: int = 50) -> DataFrame:
    """Equal-width bins over the range of a column, the last one closed; bins
    without rows included.  A constant column has a single bin."""
    value = quoted(column).cast("double")
    values = df.select(value.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    span = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    width = F.when(span["hi"] > span["lo"], (span["hi"] - span["lo"]) / bins)
    bin_of = F.least(F.floor(F.coalesce((F.col("x") - span["lo"]) / width, F.lit(0.0))), F.lit(bins - 1)) + 1
    counts = values.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    edges = df.sparkSession.range(1, bins + 1).select(
        F.col("id").alias("bin"),
        (span["lo"] + (F.col("id") - 1) * width).alias("lo"),
        (span["lo"] + F.col("id") * width).alias("hi"),
    )
    single = edges.filter((F.col("bin") == 1) | F.col("lo").isNotNull())
    filled = single.withColumn("lo", F.coalesce("lo", span["lo"])).withColumn("hi", F.coalesce("hi", span["hi"]))
    return filled.filter(F.col("lo").isNotNull()).join(counts, "bin", "left").na.fill(0, ["n"])


def price_median(df: DataFrame, column: str = "price") -> DataFrame:
    """The median drawn into the histogram."""
    return quantile_columns(df, column, [0.5], ["median"])


def box_plot_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles, whiskers (the last points within 1.5 IQR) and the number of
    points beyond them, per column."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", *[F.get("quantiles", F.lit(i)).alias(name) for i, name in enumerate(["q1", "median", "q3"])]
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    values = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("double").alias("x")) for c in columns]))
    ).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    # one row per column on the right
    placed = values.join(F.broadcast(quartiles), "column")
    inside = F.col("x").between(F.col("q1") - reach, F.col("q3") + reach)
    return placed.groupBy("column", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def customer_split(ds: Dataset) -> DataFrame:
    """Single against repeat buyers."""
    per_person = orders_per_person(ds)
    kind = F.when(F.col("orders") > 1, "Repeat Purchase").otherwise("Single Purchase")
    counts = per_person.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), total_of(per_person, F.count("*"))))
