import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketlens.operators import charts, churn, features, kpis, splits
from tests.conftest import one, rows

PEOPLE = [("c1", "u1"), ("c2", "u1"), ("c3", "u2"), ("c4", "u3")]
ORDERS = [("o1", "c1", "2020-01-01 10:00"), ("o2", "c2", "2020-01-03 09:00"), ("o3", "c3", "2020-01-02"), ("o4", "c4", "2020-03-01")]


def test_people_not_order_ids(shop):
    found = one(kpis.repeat_purchase(shop(orders=ORDERS, customers=PEOPLE)))
    assert (found["total_customers"], found["repeat_customers"], found["max_orders_per_customer"]) == (3, 1, 2)
    assert found["repeat_purchase_rate"] == pytest.approx(100 / 3)


def test_gap_of_47_hours_is_one_day(shop):
    assert one(kpis.avg_days_between_orders(shop(orders=ORDERS, customers=PEOPLE))) == {"avg_days": 1.0, "n_gaps": 1}


def test_gaps_within_a_day_and_across(shop):
    times = ["2020-01-01 01:00", "2020-01-01 23:00", "2020-01-02 00:30", "2020-01-05 12:00", "2020-01-05 12:00"]
    ds = shop(orders=[(f"o{i}", "c1", t) for i, t in enumerate(times)], customers=[("c1", "u1")])
    assert one(kpis.avg_days_between_orders(ds)) == {"avg_days": 0.75, "n_gaps": 4}


def test_order_without_items(shop):
    ds = shop(
        orders=ORDERS, customers=PEOPLE, items=[("o1", "p1", 10), ("o1", "p2", 30), ("o3", "p1", 20)], products=[("p1", "A"), ("p2", "B")]
    )
    assert one(kpis.kpi_summary(ds))["avg_order_value"] == 30.0
    money = {r["customer_unique_id"]: r["monetary"] for r in features.rfm(ds).collect()}
    assert money == {"u1": 40.0, "u2": 20.0, "u3": 0.0}


def test_null_category_is_no_group(shop):
    ds = shop(orders=ORDERS, items=[("o1", "p1", 5), ("o1", "p2", 7)], products=[("p1", "A"), ("p2", None)])
    assert rows(kpis.top_categories(ds)) == [("A", 1, 1, 5.0, 5.0)]


def test_frequency_quintiles_by_rank(shop):
    ids = [f"u{i}" for i in range(7)]
    ds = shop(
        orders=[(f"o{u}", u, f"2020-01-0{i + 1}") for i, u in enumerate(ids)], customers=[(u, u) for u in ids], items=[("ou0", "p", 1)]
    )
    scores = {r["customer_unique_id"]: r["frequency_score"] for r in features.rfm_scores(ds).collect()}
    assert [scores[u] for u in ids] == [1, 1, 2, 3, 4, 5, 5]


def test_scores_of_one_person(shop):
    ds = shop(orders=[("o", "c", "2020-01-01")], customers=[("c", "u")])
    assert one(features.rfm_scores(ds))["frequency_score"] == 1


def test_explicit_reference_date_rounds_down(shop):
    ds = shop(orders=[("o", "c", "2020-01-02 12:00")], customers=[("c", "u")])
    assert one(features.rfm(ds, "2020-01-02 00:00:00"))["recency_days"] == -1


def test_segments(spark):
    triples = [(5, 5, 5), (1, 5, 1), (4, 2, 2), (5, 1, 1), (2, 3, 5), (5, 3, 1)]
    df = spark.createDataFrame(triples, "r int, f int, m int")
    parity = [x[0] for x in df.select(features.segment_of(F.col("r"), F.col("f"), F.col("m"))).collect()]
    assert parity == ["Champions", "Loyal Customers", "Potential Loyalists", "New Customers", "Need Attention", "Other"]
    narrow = [x[0] for x in df.select(features.segment_of(F.col("r"), F.col("f"), F.col("m"), parity=False)).collect()]
    assert narrow == ["Champions", "At Risk", "Potential Loyalists", "New Customers", "Can't Lose", "Other"]


def test_mode_takes_smallest_on_tie(shop):
    ds = shop(orders=[(f"o{i}", "c", f"2020-01-0{i + 1} {h:02}:00") for i, h in enumerate([14, 9, 9, 14])], customers=[("c", "u")])
    assert one(features.temporal_preferences(features.order_times(ds)))["preferred_hour"] == 9


def test_cohorts(shop):
    ds = shop(
        orders=[("o1", "c1", "2020-01-05"), ("o2", "c2", "2020-03-09"), ("o3", "c3", "2020-01-07"), ("o4", "c4", "2020-02-01")],
        customers=[("c1", "u1"), ("c2", "u1"), ("c3", "u2"), ("c4", "u3")],
    )
    jan, feb = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    assert rows(charts.retention_cohort(ds)) == [(jan, 0, 2, 2, 100.0), (jan, 2, 1, 2, 50.0), (feb, 0, 1, 1, 100.0)]


def test_histogram_bins(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "price double")
    found = {r["bin"]: r["n"] for r in charts.price_histogram(df).collect()}
    assert len(found) == 50 and {b for b, n in found.items() if n} == {1, 26, 50}
    assert rows(charts.price_histogram(spark.createDataFrame([(3.0,)] * 4, "price double"))) == [(1, 3.0, 3.0, 4)]


def test_time_split(shop):
    ds = shop(orders=[(f"o{i}", "c", f"2020-01-{i + 1:02}") for i in range(10)], customers=[("c", "u")])
    parts = {r["order_id"]: r["split"] for r in splits.time_split(ds).collect()}
    assert [parts[f"o{i}"] for i in range(10)] == ["train"] * 8 + ["test"] * 2


def test_churn_features(shop):
    days = ["2020-01-01", "2020-01-11", "2020-02-10"]  # days 0, 10, 40
    ds = shop(
        orders=[*[(f"o{i}", f"c{i}", d) for i, d in enumerate(days)], ("end", "c9", "2020-07-19")],
        customers=[("c0", "u1"), ("c1", "u1"), ("c2", "u1"), ("c9", "u9")],
        items=[("o0", "p", 10), ("o2", "p", 99)],
    )
    found = one(churn.churn_dataset_last_order(ds))
    assert found == {
        "customer_unique_id": "u1",
        "recency_days": 30,
        "frequency": 2,
        "monetary": 10.0,
        "avg_order_value": 10.0,
        "avg_days_between_orders": 10.0,
        "std_days_between_orders": 0.0,
        "days_since_last": 160,
        "churn": 1,
    }


def test_empty_data_set(shop):
    ds = shop()
    assert one(kpis.repeat_purchase(ds))["repeat_purchase_rate"] is None
    assert one(kpis.avg_days_between_orders(ds)) == {"avg_days": None, "n_gaps": 0}
    assert one(kpis.kpi_summary(ds))["total_orders"] == 0
    for found in (
        kpis.top_categories(ds),
        features.rfm_segments(ds),
        features.customer_features(ds),
        charts.retention_cohort(ds),
        charts.monthly_orders_trend(ds),
        churn.churn_dataset_last_order(ds),
        splits.time_split(ds),
    ):
        assert found.collect() == [] and found.columns
