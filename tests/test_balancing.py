"""Neighbours within a class, synthetic rows and areas by group."""

import itertools

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from basketlens.operators import classifiers, neighbours
from basketlens.operators.smote import smote, smote_rows
from tests.conftest import rows

COLUMNS = ["a", "b", "c"]
DDL = "id string, cls int, a double, b double, c double"


def points(kind, n=240):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3))
    if kind == "grid":
        x = np.round(x * 1.5)
    if kind == "hot":
        x[60:150] = x[7]
    return [(f"k{i:04d}", int(i % 3 == 0), *map(float, r)) for i, r in enumerate(x)]


def brute(rows_, k=5):
    found = {}
    for i, c, *p in rows_:
        gap = lambda q: sum((u - v) * (u - v) for u, v in zip(p, q))
        found[i] = [j for _, j in sorted((gap(q), j) for j, d, *q in rows_ if d == c and j != i)[:k]]
    return found


@pytest.mark.parametrize("kind", ["normal", "grid", "hot"])
def test_neighbours_equal_brute_force(spark, monkeypatch, no_broadcast, kind):
    monkeypatch.setattr(neighbours, "BLOCK_POINTS", 16)
    monkeypatch.setattr(neighbours, "ASKED_AT_ONCE", 10)
    made = points(kind)
    odd = [("n1", 1, None, 0.0, 0.0), ("n2", 0, float("nan"), 0.0, 0.0), ("n3", None, 0.0, 0.0, 0.0), (None, 1, 0.0, 0.0, 0.0)]
    table = spark.createDataFrame(made + odd + made[:3], DDL).withColumn("block", F.lit(1)).repartition(3)
    found = neighbours.nearest_in_group(table, "id", "cls", COLUMNS).collect()
    assert {r["id"]: [n["key"] for n in r["neighbours"]] for r in found} == brute(made)
    assert neighbours.nearest_in_group(table.limit(0), "id", "cls", COLUMNS).isEmpty()


def test_synthetic_rows_lie_between_neighbours(spark):
    made = points("normal")
    table = spark.createDataFrame(made, DDL)
    found = smote_rows(table, "id", "cls", COLUMNS).collect()
    assert rows(smote_rows(table.repartition(7), "id", "cls", COLUMNS)) == sorted((tuple(r) for r in found), key=repr)
    assert len(found) == 160 - 80 and {r["cls"] for r in found} == {1}
    near, at = brute(made), {i: np.array(p) for i, _, *p in made}
    for r in found:
        assert r["neighbour"] in near[r["id"]] and 0 <= r["share"] < 1
        want = at[r["id"]] + r["share"] * (at[r["neighbour"]] - at[r["id"]])
        assert np.allclose(want, [r[c] for c in COLUMNS], rtol=0, atol=1e-12)
    assert len({r["neighbour"] for r in found}) > 20
    balanced = smote(table, "id", "cls", COLUMNS)
    assert rows(balanced.groupBy("cls").count()) == [(0, 160), (1, 160)]
    assert balanced.filter("synthetic").count() == 80


def test_small_classes(spark):
    made = [("a", 0, 1.0, 1.0, 1.0)] * 1 + [(f"b{i}", 1, float(i), 0.0, 0.0) for i in range(4)] + [(f"c{i}", 2, float(i), 1.0, 0.0) for i in range(2)]
    made += [("d", 3, None, 0.0, 0.0), (None, 1, 0.0, 0.0, 0.0), ("e", None, 0.0, 0.0, 0.0)]
    table = spark.createDataFrame(made, DDL)
    found = smote_rows(table, "id", "cls", COLUMNS)
    assert rows(found.groupBy("cls").count()) == [(0, 3), (2, 2)]
    alone = found.filter("cls = 0").select("id", "neighbour", *COLUMNS)
    assert set(rows(alone)) == {("a", "a", 1.0, 1.0, 1.0)}
    assert smote_rows(table.filter("cls = 1"), "id", "cls", COLUMNS).isEmpty()
    assert smote_rows(table.limit(0), "id", "cls", COLUMNS).isEmpty()


def test_areas_by_group_equal_pairs(spark):
    rng = np.random.default_rng(2)
    made = [(int(g), int(y), float(s)) for g, y, s in zip(rng.integers(0, 3, 300), rng.integers(0, 2, 300), rng.integers(0, 20, 300) / 20)]
    made += [(7, 1, 0.5), (7, 1, 0.6), (8, None, 0.1), (None, 1, 0.1), (0, 1, None)]
    table = spark.createDataFrame(made, "g int, y int, s double").repartition(4)
    found = {r["g"]: (r["positives"], r["negatives"], r["roc_auc"]) for r in classifiers.roc_auc_by(table, ["g"], "y", "s").collect()}
    for g in range(3):
        ones, zeros = ([s for h, y, s in made if h == g and y == v and s is not None] for v in (1, 0))
        above = sum((a > b) + (a == b) / 2 for a, b in itertools.product(ones, zeros))
        assert found[g] == (len(ones), len(zeros), pytest.approx(above / len(ones) / len(zeros), abs=1e-12))
    assert found[7] == (2, 0, None) and set(found) == {0, 1, 2, 7}


def test_models_learn_from_synthetic_rows_of_the_training_part_only(spark, monkeypatch):
    seen = []

    def spy(df, key, label, columns, **kwargs):
        seen.append({r[key] for r in df.select(key).collect()})
        return smote_rows(df, key, label, columns, **kwargs)

    monkeypatch.setattr(classifiers, "smote_rows", spy)
    made = [(f"u{i:03}", float(i % 13), float(i % 7), int(i % 13 > 10)) for i in range(200)]
    data = spark.createDataFrame(made, "customer_unique_id string, a double, b double, churned int")
    learners = {"lr": LogisticRegression(labelCol="churned", maxIter=5)}
    found = classifiers.compare_models(data, ["a", "b"], "churned", learners, folds=2, balance="smote").collect()
    assert len(found) == 1 and found[0]["roc_auc"] > 0.95 and found[0]["recall"] > 0.9
    split = classifiers.stratified_split(data, "customer_unique_id", "churned", 0.2, classifiers.SEED)
    held_out = {r[0] for r in split.filter("split = 'test'").select("customer_unique_id").collect()}
    assert len(seen) == 3 and not any(s & held_out for s in seen)
    assert sorted(map(len, seen))[-1] == len(made) - len(held_out)
    folds = classifiers.cross_validate(data, ["a", "b"], "churned", learners["lr"], folds=4).collect()
    areas = [r["roc_auc"] for r in folds]
    assert sorted(r["fold"] for r in folds) == [0, 1, 2, 3]
    assert [r["roc_auc_mean"] for r in folds] == pytest.approx([np.mean(areas)] * 4)
    assert [r["roc_auc_std"] for r in folds] == pytest.approx([np.std(areas)] * 4)
    with pytest.raises(ValueError):
        classifiers.compare_models(data, ["a"], "churned", learners, balance="other")
