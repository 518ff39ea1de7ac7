"""Churn data sets: one row of features and a label per person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.dataset import Dataset
from basketlens.functions.scalars import ratio, total_of, whole_days
from basketlens.operators.features import PERSON, customer_lifetime, orders_by_person, rfm_scores
from basketlens.operators.kpis import order_gaps

LAST_ORDER_FEATURES = [
    "recency_days",
    "frequency",
    "monetary",
    "avg_order_value",
    "avg_days_between_orders",
    "std_days_between_orders",
]
RFM_FEATURES = [
    "recency_days",
    "frequency",
    "monetary",
    "recency_score",
    "frequency_score",
    "monetary_score",
    "rfm_score",
    "customer_lifetime_days",
    "avg_days_between_orders",
    "unique_categories_purchased",
]


def churn_dataset_last_order(ds: Dataset, window_days: int = 90) -> DataFrame:
    """People with two or more orders: features of all orders but the last,
    and whether the last one lies more than ``window_days`` before the end of
    the data.

    Everything follows from sums over all orders less the last one's part,
    so the orders of a person are aggregated, never sorted or listed: the
    days from the order before to the last one are also its last gap.
    """
    ts = F.col("order_purchase_timestamp")
    dated = ds.with_tables(orders=ds.orders.filter(ts.isNotNull()))
    totals = orders_by_person(
        dated,
        ("orders", F.count("*"), "sum"),
        ("valued", F.count("order_value"), "sum"),
        ("value", F.sum("order_value"), "sum"),
        ("last", F.max(F.struct(ts.alias("ts"), "order_id", "order_value")), "max"),
    ).filter("orders >= 2")
    gaps = order_gaps(dated).groupBy(PERSON).agg(
        F.sum("gap_days").alias("days"),
        F.sum(F.col("gap_days") * F.col("gap_days")).alias("squares"),
        F.max(F.struct("day", "n", "gap_days")).alias("end"),
    )
    joined = totals.join(gaps, PERSON).withColumns(
        {
            "recency_days": F.when(F.col("end.n") > 1, F.lit(0)).otherwise(F.col("end.gap_days")),
            "days": F.coalesce("days", F.lit(0)),
            "squares": F.coalesce("squares", F.lit(0)),
            "frequency": F.col("orders") - 1,
        }
    )
    last_gap = F.col("recency_days")
    n = F.col("frequency") - 1  # gaps between the orders before the last
    days = (F.col("days") - last_gap).cast("double")
    squares = (F.col("squares") - last_gap * last_gap).cast("double")
    variance = (squares - days * days / n) / (n - 1)
    last_value = F.col("last.order_value")
    monetary = F.coalesce(F.col("value"), F.lit(0)) - F.coalesce(last_value, F.lit(0))
    age = whole_days(F.col("last.ts"), total_of(dated.orders, F.max(ts)))
    return joined.select(
        PERSON,
        last_gap.cast("long").alias("recency_days"),
        "frequency",
        monetary.cast("double").alias("monetary"),
        F.coalesce(ratio(monetary, F.col("valued") - last_value.isNotNull().cast("int")), F.lit(0.0)).alias("avg_order_value"),
        F.when(n >= 1, days / n).otherwise(0.0).alias("avg_days_between_orders"),
        F.when(n >= 2, F.sqrt(F.greatest(variance, F.lit(0.0)))).otherwise(0.0).alias("std_days_between_orders"),
        age.alias("days_since_last"),
    ).withColumn("churn", (F.col("days_since_last") > window_days).cast("int"))


def churn_features(ds: Dataset) -> DataFrame:
    """The features of ``churn_dataset_last_order`` over all orders of every
    person, for scoring: days since the last order, and gaps between all."""
    ts = F.col("order_purchase_timestamp")
    dated = ds.with_tables(orders=ds.orders.filter(ts.isNotNull()))
    totals = orders_by_person(
        dated,
        ("frequency", F.count("*"), "sum"),
        ("valued", F.count("order_value"), "sum"),
        ("value", F.sum("order_value"), "sum"),
        ("last", F.max(ts), "max"),
    )
    gaps = order_gaps(dated).groupBy(PERSON).agg(
        F.sum("gap_days").cast("double").alias("days"),
        F.sum(F.col("gap_days") * F.col("gap_days")).cast("double").alias("squares"),
    )
    n, days = F.col("frequency") - 1, F.coalesce("days", F.lit(0.0))
    variance = (F.coalesce("squares", F.lit(0.0)) - days * days / n) / (n - 1)
    return totals.join(gaps, PERSON, "left").select(
        PERSON,
        whole_days(F.col("last"), total_of(dated.orders, F.max(ts))).cast("long").alias("recency_days"),
        "frequency",
        F.coalesce("value", F.lit(0)).cast("double").alias("monetary"),
        F.coalesce(ratio(F.col("value"), F.col("valued")), F.lit(0.0)).alias("avg_order_value"),
        F.when(n >= 1, days / n).otherwise(0.0).alias("avg_days_between_orders"),
        F.when(n >= 2, F.sqrt(F.greatest(variance, F.lit(0.0)))).otherwise(0.0).alias("std_days_between_orders"),
    )


def churn_dataset_ahead(ds: Dataset, window_days: int = 90) -> DataFrame:
    """Scores, lifetime and variety by the orders up to ``window_days`` before
    the end of the data, and whether the person ordered nothing after that.

    The label is no function of a feature, as it is in
    ``churn_dataset_rfm``, so models that learn from this predict."""
    ts = F.col("order_purchase_timestamp")
    cut = total_of(ds.orders, F.max(ts)) - F.make_dt_interval(F.lit(window_days))
    past, later = (ds.with_tables(orders=ds.orders.filter(side)) for side in (ts <= cut, ts > cut))
    came_back = orders_by_person(later, ("later_orders", F.count("*"), "sum"))
    features = churn_dataset_rfm(past, window_days).drop("churned")
    labelled = features.join(came_back.select(PERSON, "later_orders"), PERSON, "left")
    return labelled.withColumn("churned", F.col("later_orders").isNull().cast("int")).drop("later_orders")


def churn_dataset_rfm(ds: Dataset, window_days: int = 90) -> DataFrame:
    """Everybody: scores, lifetime and variety, and whether the last order
    lies more than ``window_days`` before the end of the data.

    As published, where the label follows from ``recency_days``; learn from
    ``churn_dataset_ahead`` instead."""
    scores = rfm_scores(ds)
    life = customer_lifetime(ds)
    end = total_of(ds.orders, F.max("order_purchase_timestamp"))
    churned = (whole_days(F.col("last_purchase"), end) > window_days).cast("int")
    return scores.join(life, PERSON).select(
        *scores.columns,
        "customer_lifetime_days",
        "avg_days_between_orders",
        "unique_categories_purchased",
        churned.alias("churned"),
    )
