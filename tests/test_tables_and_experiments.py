import datetime as dt
import math

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from basketlens import load_dataset
from basketlens.operators import classifiers, cleaning, experiments, profiling
from basketlens.sources.retail_files import load_pipeline, save_pipeline, write_result
from basketlens.streaming import conversions
from tests.conftest import one, rows


def test_quality_of_a_small_table(spark):
    df = spark.createDataFrame([("1", 5, "a"), ("2", 5, "b"), ("3", 5, "c"), ("4", 5, "d")], "code string, flat int, name string")
    assert rows(profiling.quality_issues(df).select("issue", "column_name", "impact")) == [
        ("Incorrect Data Type", "code", -5.0),
        ("Zero Variance", "flat", -10.0),
    ]
    assert rows(profiling.quality_score(df)) == [(85.0, "GOOD", 2)]


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    assert one(profiling.duplicate_rows(df))["duplicates"] == 1
    assert cleaning.dedupe(df).count() == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "x string, y int")
    found = {r["column"]: r for r in profiling.profile_columns(df).collect()}
    assert found["x"]["rows"] == 0 and found["x"]["missing_pct"] == 0.0 and found["x"]["n_distinct"] == 0
    assert one(profiling.quality_score(df))["score"] <= 100
    assert profiling.iqr_outliers(df).collect() == []
    assert cleaning.winsorize(df, ["y"]).collect() == [] and cleaning.impute(df).collect() == []


def test_profile_of_odd_names(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "`a.b c` string, `x y` double")
    found = {r["column"]: r for r in profiling.profile_columns(df).collect()}
    assert found["a.b c"]["missing"] == 1 and found["x y"]["mean_value"] == 1.5


def test_clip_keeps_nulls_and_filter_drops_them(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 9)] + [(100.0,), (None,)], "x double")
    clipped = [r["x"] for r in cleaning.winsorize(df, ["x"]).collect()]
    assert None in clipped and max(v for v in clipped if v is not None) < 100
    kept = [r["x"] for r in cleaning.remove_outliers(df, ["x"]).collect()]
    assert sorted(kept) == [float(v) for v in range(1, 9)]


def test_sparse_columns_and_scaling(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (5.0, "x")], "a double, b string")
    assert cleaning.drop_sparse_columns(df).columns == ["a"]
    assert [r["a"] for r in cleaning.minmax_scale(df, ["a"]).orderBy("a").collect()] == [0.0, 0.5, 1.0]
    z = [r["a"] for r in cleaning.standard_scale(df, ["a"]).orderBy("a").collect()]
    assert z[2] == pytest.approx(math.sqrt(1.5))


def test_variant_by_hash(spark):
    users = spark.createDataFrame([("u",)], "user_id string")
    assert one(experiments.assign_variant(users, "1", ["a", "b"]))["variant"] == "b"


def _tracked(spark, counts):
    rows_ = [("e", v, i < c, 1.0) for v, (n, c) in counts.items() for i in range(n)]
    return spark.createDataFrame(rows_, "experiment string, variant string, converted boolean, value double")


def test_z_test(spark):
    found = one(experiments.significance(experiments.experiment_results(_tracked(spark, {"a": (1000, 50), "b": (1000, 70)})), "a", "b"))
    assert found["uplift_percent"] == pytest.approx(40)
    assert found["z_score"] == pytest.approx(1.883, abs=1e-3)
    assert found["p_value"] == pytest.approx(0.0597, abs=1e-4) and found["is_significant"] is False


def test_untracked_variant(spark):
    results = experiments.experiment_results(_tracked(spark, {"a": (10, 5)}), ["a", "b"])
    empty = results.filter("variant = 'b'").first().asDict()
    assert (empty["users"], empty["total_value"]) == (0, 0.0)
    found = one(experiments.significance(results, "a", "b"))
    assert found["note"] == "insufficient data" and found["z_score"] is None and found["p_value"] is None


def test_stream_equals_batch(spark, tmp_path):
    schema = "event_id long, ts timestamp, experiment string, variant string, converted boolean, value double"

    def at(hour):
        return dt.datetime(2024, 1, 1 + hour // 24, hour % 24)

    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    first = [(1, at(1), "e", "a", True, 2.0), (1, at(1), "e", "a", True, 2.0), (2, at(30), "e", "a", False, 1.0)]
    later = [(3, at(31), "e", "a", True, 4.0), (4, at(2), "e", "b", True, 9.0)]  # event 4 is a day late
    found = None
    for batch in (first, later):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        events = conversions.event_stream(spark, source, spark.createDataFrame([], schema).schema)
        found = conversions.run_to_table(conversions.windowed_results(events), table)
    got = {(r["window_start"].day, r["variant"]): (r["users"], r["conversions"], r["total_value"]) for r in found.collect()}
    assert got == {(1, "a"): (1, 1, 2.0), (2, "a"): (2, 1, 5.0)}


def test_measures_of_a_classifier(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, guess int")
    found = {r["class"]: r for r in classifiers.classification_metrics(df, "label", "guess").collect()}
    assert (found[1]["precision"], found[1]["recall"], found[1]["accuracy"]) == (1.0, 0.5, 0.75)
    scores = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "label int, score double")
    assert one(classifiers.roc_auc(scores, "label", "score"))["roc_auc"] == 0.625
    assert rows(classifiers.roc_curve(scores, "label", "score")) == [(0.1, 1.0, 1.0), (0.4, 0.5, 1.0), (0.9, 0.5, 0.5)]


def test_balanced_classes(spark):
    df = spark.createDataFrame([(i, int(i < 3)) for i in range(10)], "id int, label int")
    assert rows(classifiers.oversample(df, "id", "label").groupBy("label").count()) == [(0, 7), (1, 7)]
    assert one(classifiers.class_weights(df, "label").agg(F.sum("weight").alias("w")))["w"] == pytest.approx(10)


def test_training_is_reproducible(spark, tmp_path):
    rows_ = [(f"u{i:03}", float(i % 17), float(i % 5), int((i % 17) + (i % 5) > 9)) for i in range(300)]
    data = spark.createDataFrame(rows_, "customer_unique_id string, a double, b double, churn int")
    small = classifiers.gradient_boosting("churn", maxIter=3, maxDepth=3)
    scores = []
    for _ in range(2):
        model, held = classifiers.train_churn(data, ["a", "b"], estimator=small)
        scores.append(rows(held.select("customer_unique_id", "score")))
    assert scores[0] == scores[1] and len(scores[0]) == 60
    area = one(classifiers.roc_auc(held, "churn", "score"))["roc_auc"]
    assert 0.9 < area <= 1.0
    save_pipeline(model, str(tmp_path / "m"))
    again = load_pipeline(str(tmp_path / "m")).transform(data)
    assert rows(again.select("prediction")) == rows(model.transform(data).select("prediction"))
    segments = data.select("customer_unique_id", F.lit("Other").alias("segment")).limit(5)
    scored = classifiers.score_churn(model, data, segments)
    assert {r["risk_level"] for r in scored.collect()} <= {"Low", "Medium", "High"}
    assert scored.filter("segment = 'Unknown'").count() == 295
    assert classifiers.at_risk_customers(scored, n=7).count() == 7


def test_comparison_and_search(spark):
    rows_ = [(f"u{i:03}", float(i % 13), int(i % 13 > 6)) for i in range(200)]
    data = spark.createDataFrame(rows_, "customer_unique_id string, a double, churned int")
    learners = {"lr": LogisticRegression(labelCol="churned", maxIter=5)}
    found = one(classifiers.compare_models(data, ["a"], "churned", learners, folds=2))
    assert found["roc_auc"] == 1.0 and found["cv_roc_auc_mean"] == pytest.approx(1.0)
    tuned = classifiers.tune_model(data, ["a"], "churned", learners["lr"], {"regParam": [0.0, 0.1, 0.5]}, n_iter=2, folds=2)
    assert tuned.count() == 2


def test_files_round_trip(spark, shop, tmp_path):
    ds = shop(orders=[("o", "c", "2020-01-01 10:00")], items=[("o", "p", 9.5)], products=[("p", "A")], customers=[("c", "u")])
    header = "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
    header += "order_delivered_customer_date,order_estimated_delivery_date\n"
    (tmp_path / "olist_orders_dataset.csv").write_text(header + "o,c,delivered,2020-01-01 10:00:00,,,,\n")
    (tmp_path / "olist_order_items_dataset.csv").write_text(
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\no,1,p,s,2020-01-02 00:00:00,9.50,1.25\n"
    )
    loaded = load_dataset(spark, str(tmp_path))
    assert loaded.products is None
    assert loaded.orders.first()["order_purchase_timestamp"] == dt.datetime(2020, 1, 1, 10)
    assert float(loaded.order_items.first()["freight_value"]) == 1.25
    write_result(ds.orders, str(tmp_path / "out"), "csv")
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 1
    with pytest.raises(ValueError):
        loaded.require("products")
