import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.functions import joins
from basketlens.operators import baskets, content, evaluation, facts, factorization, matching, methods, recommend
from basketlens.operators.recommend import Recommender
from tests.conftest import brute_pairs, one, rows


def test_lines_count_with_multiplicity(shop):
    ds = shop(items=[("o", "A", 1), ("o", "A", 1), ("o", "B", 1), ("x", "C", 1)])
    assert rows(recommend.copurchase_pairs(ds, 1)) == [("A", "A", 2), ("A", "B", 2), ("B", "A", 2)]


def test_rules(shop):
    ds = shop(
        items=[("1", "a", 1), ("1", "b", 1), ("2", "a", 1), ("2", "b", 1), ("3", "a", 1), ("4", "c", 1)],
        products=[("a", "A"), ("b", "B"), ("c", "C")],
    )
    found = {(r["antecedent"], r["consequent"]): r for r in baskets.association_rules(baskets.basket_lines(ds)).collect()}
    assert set(found) == {("A", "B"), ("B", "A")}
    assert found["A", "B"]["support"] == 0.5
    assert found["A", "B"]["confidence"] == pytest.approx(2 / 3)
    assert found["A", "B"]["lift"] == found["B", "A"]["lift"] == pytest.approx(4 / 3)


def test_null_item_counts_in_the_denominator(shop):
    ds = shop(items=[("1", "a", 1), ("1", "n", 1), ("2", "a", 1), ("2", "b", 1)], products=[("a", "A"), ("b", "B"), ("n", None)])
    assert [tuple(r) for r in baskets.frequent_pairs(baskets.basket_lines(ds)).collect()] == [("A", "B", 1, 0.5)]
    assert one(baskets.basket_stats(baskets.basket_lines(ds))) == {"baskets": 2, "avg_length": 2.0}


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_big_baskets_are_exact(spark, least):
    rng = random.Random(least)
    lines = [(b, i, rng.choice([1, 1, 1, 3])) for b in range(30) for i in rng.sample(range(25), rng.randint(1, 5))]
    lines += [(100 + b, i, rng.choice([1, 1, 2, 4])) for b in range(3) for i in range(25)]  # baskets of everything
    df = spark.createDataFrame(lines, "basket long, item long, n long")
    assert rows(baskets.pair_counts(df, least, big_basket=6)) == brute_pairs(lines, least)
    assert rows(baskets.pair_counts(df, least)) == brute_pairs(lines, least)


def test_no_frequent_pair_is_an_empty_table(shop):
    ds = shop(items=[("1", "a", 1)], products=[("a", "A")])
    found = baskets.association_rules(baskets.basket_lines(ds))
    assert found.collect() == [] and found.columns == ["antecedent", "consequent", "support", "confidence", "lift"]


@pytest.mark.parametrize("short", [3, 512])
def test_first_unlisted_equals_filtering(spark, short):
    rng = random.Random(5)
    lists = {g: [f"{g}{i}" for i in range(n)] for g, n in (("x", 12), ("y", 4))}
    ranking = spark.createDataFrame(
        [(g, i + 1, p) for g, ps in lists.items() for i, p in enumerate(ps)], "list_id string, rank long, product_id string"
    )
    excluded = {(w, g): rng.sample(ps, rng.randint(0, len(ps))) for w in range(20) for g, ps in lists.items()}
    taken = spark.createDataFrame([(w, g, p) for (w, g), ps in excluded.items() for p in ps], "who long, list_id string, product_id string")
    wants = spark.createDataFrame([(w, g, w % 5) for w in range(21) for g in lists], "who long, list_id string, need int")
    found = recommend.first_unlisted(ranking, wants, taken, 5, short).select("who", "list_id", "product_id")
    expected = [
        (w, g, p) for w in range(21) for g, ps in lists.items() for p in [q for q in ps if q not in excluded.get((w, g), [])][: w % 5]
    ]
    assert rows(found) == sorted(expected, key=repr)


def _shop_with_hubs(shop):
    rng = random.Random(1)
    orders, items = [], []
    for o in range(120):
        customer = f"c{rng.randint(0, 19)}"
        orders.append((f"o{o}", customer, f"2020-01-{o % 28 + 1:02}"))
        for p in {rng.choice(["p0", "p1", f"p{rng.randint(2, 15)}"]) for _ in range(4)}:
            items.append((f"o{o}", p, rng.randint(1, 9)))
    products = [(f"p{i}", f"k{i % 4}") for i in range(18)]
    return shop(orders=orders, items=items, products=products, customers=[(f"c{i}", f"c{i}") for i in range(22)])


def _expected_copurchase(ds, least, k):
    pairs = Counter({(r[0], r[1]): r[2] for r in recommend.copurchase_pairs(ds, least).collect()})
    bought = {}
    for who, product in recommend.bought_products(ds).collect():
        bought.setdefault(who, set()).add(product)
    expected = []
    for who, mine in bought.items():
        scores = Counter()
        for (p, q), n in pairs.items():
            if p in mine:
                scores[q] += n
        best = sorted(((-s, q) for q, s in scores.items() if q not in mine))[:k]
        expected += [(who, q, -s) for s, q in best]
    return sorted(expected, key=repr)


@pytest.mark.parametrize("partners", [2, 100])
def test_hubs_do_not_change_the_scores(shop, partners):
    ds = _shop_with_hubs(shop)
    best, _ = recommend.copurchase_scores(
        recommend.bought_products(ds), recommend.copurchase_pairs(ds, 2), 3, buyers=4 if partners == 2 else 1000, partners=partners
    )
    assert rows(best.select("who", "product_id", "score")) == _expected_copurchase(ds, 2, 3)


def test_recommendations_keep_their_promises(shop, spark, tmp_path):
    ds = _shop_with_hubs(shop)
    Recommender.fit(ds, 2).save(str(tmp_path / "model"))
    model = Recommender.load(spark, str(tmp_path / "model"))
    bought = {tuple(r) for r in recommend.bought_products(ds).collect()}
    for method in recommend.METHODS:
        found = recommend.recommend(model, ds, method, k=4).collect()
        assert not bought & {(r["customer_id"], r["product_id"]) for r in found}
        per_person = Counter(r["customer_id"] for r in found)
        assert max(per_person.values()) <= 4
        # c21 has no orders and gets the most popular products
        assert per_person["c21"] == 4
        assert len({(r["customer_id"], r["rank"]) for r in found}) == len(found)
    with pytest.raises(ValueError):
        recommend.recommend(model, ds, "random")
    with pytest.raises(ValueError):
        recommend.recommend(model, ds, k=51)


def test_all_methods_by_name(shop):
    ds = shop(
        orders=[(f"o{i}", f"c{i % 6}", f"2020-01-{i + 1:02}") for i in range(18)],
        items=[(f"o{i}", f"p{j}", 1 + j) for i in range(18) for j in ((i * 5) % 7, (i * 3) % 7)],
        products=[(f"p{j}", "AB"[j % 2]) for j in range(7)],
        customers=[(f"c{i}", f"u{i}") for i in range(6)],
    )
    model = Recommender.fit(ds, 1)
    some = recommend.all_people(ds).filter("who IN ('u1', 'u4')")
    bought = {(r[0], r[1]) for r in recommend.bought_products(ds).collect()}
    for method in methods.OTHERS:
        found = methods.recommend_by(method, model, ds, some, 2)
        assert set(found.columns) == {"customer_id", "rank", "product_id", "score", "method"}
        listed = found.collect()
        assert {r["customer_id"] for r in listed} <= {"u1", "u4"} and all(r["rank"] <= 2 for r in listed)
        assert not {(r["customer_id"], r["product_id"]) for r in listed} & bought
    with pytest.raises(ValueError):
        methods.recommend_by("none", model, ds)
    with pytest.raises(ValueError):
        methods.recommend_by("content", model, ds, k=51)


def test_ranking_measures(spark):
    recs = spark.createDataFrame([("u", i + 1, p) for i, p in enumerate("ABCDE")], "customer_id string, rank int, product_id string")
    truth = spark.createDataFrame([("u", p) for p in "ACF"], "customer_id string, product_id string")
    found = one(evaluation.ranking_scores(recs, truth, 5))
    assert found["precision_at_k"] == 0.4
    assert found["recall_at_k"] == pytest.approx(0.6667, abs=1e-4)
    assert found["average_precision"] == pytest.approx(0.5556, abs=1e-4)
    assert found["ndcg"] == pytest.approx(0.7039, abs=1e-4)


def test_short_list(spark):
    recs = spark.createDataFrame([("u", 1, "A"), ("u", 2, "B")], "customer_id string, rank int, product_id string")
    truth = spark.createDataFrame([("u", "A"), ("v", "B")], "customer_id string, product_id string")
    found = {r["customer_id"]: r for r in evaluation.ranking_scores(recs, truth, 5).collect()}
    assert (found["u"]["precision_at_k"], found["u"]["precision_at_returned"]) == (0.2, 0.5)
    assert (found["v"]["precision_at_k"], found["v"]["precision_at_returned"], found["v"]["ndcg"]) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("broadcast", [True, False])
def test_rules_of_any_size_equal_counting(spark, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    rnd = random.Random(4)
    held = {b: set(rnd.sample("ABCDEF", rnd.randint(0, 5))) for b in range(60)}
    held[60] = {"A", "B", "C", "D"}
    lines = [(b, i, 1) for b, items in held.items() for i in items] + [(b, None, 1) for b in held]
    table = spark.createDataFrame(lines, "order_id long, item string, n long")
    count = lambda items: sum(set(items) <= h for h in held.values())
    n, want = len(held), {}
    for size in range(2, 6):
        for items in itertools.combinations("ABCDEF", size):
            if count(items) >= 0.05 * n:
                for c in items:
                    rest = tuple(x for x in items if x != c)
                    confidence = count(items) / count(rest)
                    lift = confidence / (count([c]) / n)
                    if confidence >= 0.4 and lift >= 1.0:
                        want[rest, c] = (count(items) / n, confidence, lift)
    rules = baskets.itemset_rules(table, 0.05, 0.4, 1.0)
    found = {(tuple(r["antecedent"]), r["consequent"]): (r["support"], r["confidence"], r["lift"]) for r in rules.collect()}
    assert found.keys() == want.keys() and any(len(a) == 3 for a, _ in found)
    for key, figures in want.items():
        assert found[key] == pytest.approx(figures)
    asked = spark.createDataFrame([(b, i) for b, h in held.items() for i in h] + [(99, "Z"), (99, None)], "basket long, item string")
    got = {}
    for r in baskets.basket_recommend_sets(rules, asked, 2).collect():
        got.setdefault(r["basket"], []).append((r["item"], pytest.approx(r["score"])))
    for b, h in held.items():
        scores = {}
        for (a, c), (_, confidence, lift) in want.items():
            if set(a) <= h and c not in h:
                scores[c] = max(scores.get(c, 0), confidence * lift)
        best = sorted(scores.items(), key=lambda e: (-e[1], e[0]))[:2]
        assert got.get(b, []) == best
    assert 99 not in got


def made_vectors(kind):
    rng = np.random.default_rng(0)
    if kind == "clusters":
        return rng.normal(size=(6, 6))[np.arange(90) % 6] + rng.normal(size=(90, 6)) * 0.02
    vectors = rng.normal(size=(90, 6))
    if kind == "lengths":
        return vectors * rng.exponential(size=(90, 1)) ** 3
    if kind == "copies":
        vectors[20:60] = vectors[3]
    return vectors


@pytest.mark.parametrize("kind,broadcast", [("noise", True), ("clusters", False), ("copies", True), ("lengths", False)])
def test_matches_equal_brute_force(spark, monkeypatch, request, kind, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    monkeypatch.setattr(matching, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(matching, "PROFILES_AT_ONCE", 20)
    vectors, rng = made_vectors(kind), np.random.default_rng(1)
    gone = {(int(w), int(p)) for w, p in zip(rng.integers(0, 90, 300), rng.integers(0, 100, 300))} | {(5, p) for p in range(88)}
    profiles = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "who long, profile array<double>")
    length = np.square(vectors).sum(1)
    order = -length if kind == "lengths" else vectors[:, 0]
    items = spark.createDataFrame([(i, v.tolist(), float(o)) for (i, v), o in zip(enumerate(vectors), order)], "product_id long, unit array<double>, place double")
    excluded = spark.createDataFrame(sorted(gone) * 2, "who long, product_id long")
    report = {}
    found = rows(matching.best_matches(profiles, excluded, items, ["place", "product_id"], 4, report).select("who", "rank", "product_id"))
    scores = np.round(vectors @ vectors.T, matching.DIGITS)
    want = []
    for i in range(90):
        left = sorted((-scores[i, j], j) for j in range(90) if (i, j) not in gone)[:4]
        want += [(i, r, j) for r, (_, j) in enumerate(left, 1)]
    assert found == sorted(want, key=repr)
    assert report["asked"] <= report["all"] == 90 * 13
    if kind in ("clusters", "lengths"):
        assert report["asked"] < 0.5 * report["all"]
    if kind == "noise":
        assert matching.best_matches(profiles.limit(0), excluded, items, ["place"], 4).isEmpty()
        assert matching.best_matches(profiles, excluded, items.limit(0), ["place"], 4).isEmpty()


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6, 1e25])
def test_scores_of_a_shelf_are_exact_at_any_scale(scale):
    """Short numbers find candidates; close calls are decided by the exact products."""
    rng, kept = np.random.default_rng(9), []
    units = rng.normal(size=(600, 12))
    units[300:] = units[:300] * (1 + rng.normal(size=(300, 1)) * 1e-8)
    profiles = rng.normal(size=(50, 12)) * scale
    taken = rng.integers(0, 50, 400), rng.integers(0, 600, 400)
    scores = np.round(profiles @ units.T, matching.DIGITS)
    scores[taken] = -np.inf
    best, _ = matching.shelf_matches(profiles, np.full(50, -np.inf), units, np.arange(600) // 40, np.arange(600), taken, 7)
    assert len(best.row) == 350
    for row, column, score in zip(best.row, best.column, best.score):
        assert score == pytest.approx(scores[row, column], rel=1e-12)
        kept.append((row, column))
    least = np.sort(scores, axis=1)[:, -7]
    for row, column in kept:
        assert scores[row, column] >= least[row] - 1e-9 * max(1.0, scale * 1e-5)


def test_matches_ask_few_blocks_in_any_order(spark, monkeypatch):
    """Like items share a block even if the given order scatters them."""
    monkeypatch.setattr(matching, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(matching, "SHELF_ITEMS", 20)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(10, 6))[np.arange(200) % 10] + rng.normal(size=(200, 6)) * 0.01
    profiles = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors[:60])], "who long, profile array<double>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "product_id long, unit array<double>")
    own = profiles.select("who", F.col("who").alias("product_id"))
    report, got = {}, {}
    for r in matching.best_matches(profiles, own, items, ["product_id"], 3, report).collect():
        got.setdefault(r["who"], {})[r["rank"]] = r["product_id"]
    scores = np.round(vectors[:60] @ vectors.T, matching.DIGITS)
    scores[np.arange(60), np.arange(60)] = -np.inf
    assert got == {i: dict(enumerate(np.argsort(-scores[i], kind="stable")[:3].tolist(), 1)) for i in range(60)}
    assert report["all"] == 60 * 40 and report["asked"] < 0.3 * report["all"]


def test_similar_items_leave_the_item_out(spark):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made_vectors("noise"))], "id long, v array<double>")
    unit = made_vectors("noise") / np.linalg.norm(made_vectors("noise"), axis=1, keepdims=True)
    cosines = unit @ unit.T
    np.fill_diagonal(cosines, -9)
    got = {}
    for r in content.similar_items(df, "id", "v", 4).collect():
        got.setdefault(r["id"], set()).add(r["neighbour"])
    assert got == {i: set(np.argsort(-cosines[i])[:4].tolist()) for i in range(90)}


def entries_of(spark, matrix):
    made = [(f"u{i}", f"p{j}", int(i), int(j), int(matrix[i, j])) for i, j in zip(*np.nonzero(matrix))]
    return spark.createDataFrame(made, "customer_unique_id string, product_id string, user_index long, item_index long, purchases long")


def test_singular_values(spark):
    rng = np.random.default_rng(2)
    matrix = np.where(rng.random((40, 30)) < 0.4, rng.integers(1, 9, (40, 30)), 0)
    values, left, right = factorization.truncated_svd(entries_of(spark, matrix), 4, 8)
    np.testing.assert_allclose(values, np.linalg.svd(matrix, compute_uv=False)[:4], rtol=2e-2)
    assert values[0] == pytest.approx(np.linalg.svd(matrix, compute_uv=False)[0], rel=1e-6)
    u = np.array([r["v"] for r in left.collect()])
    np.testing.assert_allclose(u.T @ u, np.eye(4), atol=1e-6)
    assert right.count() == 30


def test_factors_from_cells_and_segments(spark, monkeypatch):
    """Many small cells, missing rows and repeated entries: the dense answer, and the same bits each time."""
    for name, value in (("CELL_ENTRIES", 40), ("FEWEST_CELLS", 5), ("BLOCK_NUMBERS", 90), ("SEGMENT_NUMBERS", 36)):
        monkeypatch.setattr(factorization, name, value)
    rng = np.random.default_rng(8)
    matrix = rng.integers(0, 3, (40, 4)) @ (rng.integers(0, 3, (4, 30)) * (rng.random(30) < 0.8))
    matrix[[7, 21]] = 0
    once = entries_of(spark, matrix)
    entries = once.unionByName(once)
    values, left, right = factorization.truncated_svd(entries, 4, 8)
    np.testing.assert_allclose(values, 2 * np.linalg.svd(matrix, compute_uv=False)[:4], rtol=1e-8)
    u, v = ({r[0]: r[1] for r in t.collect()} for t in (left, right))
    assert sorted(u) == np.flatnonzero(matrix.any(1)).tolist() and sorted(v) == np.flatnonzero(matrix.any(0)).tolist()
    for i in u:
        for j in v:
            assert np.dot(np.array(u[i]) * values, v[j]) == pytest.approx(2 * matrix[i, j], abs=1e-6)
    again = factorization.truncated_svd(entries.repartition(5), 4, 8)
    assert again[0] == values and {r[0]: r[1] for r in again[1].collect()} == u


def test_factors_of_both_sides_and_their_lists(spark, monkeypatch):
    """A matrix of rank 4 is found exactly: factors, expectations and lists."""
    monkeypatch.setattr(matching, "BLOCK_ITEMS", 5)
    rng = np.random.default_rng(3)
    matrix = rng.integers(0, 3, (40, 4)) @ (rng.integers(0, 3, (4, 30)) * (rng.random(30) < 0.8))
    matrix[7] = 0
    entries = entries_of(spark, matrix)
    values, left, right = factorization.truncated_svd(entries, 4, 8)
    table = factorization.factor_table(left, right).collect()
    u, v = np.zeros((40, 4)), np.zeros((30, 4))
    for r in table:
        (u if r["side"] == "user" else v)[r["index"], r["factor"]] = r["value"]
    for side in (u, v):
        np.testing.assert_allclose(side.T @ side, np.eye(4), atol=1e-6)
    full = np.linalg.svd(matrix)
    np.testing.assert_allclose(values, full[1][:4], rtol=1e-8)
    np.testing.assert_allclose((u * values) @ v.T, matrix, atol=1e-6)
    lists = {}
    for r in factorization.recommend_factors(entries, 3, 4, 8).collect():
        lists.setdefault(r["customer_id"], []).append((r["rank"], r["product_id"], r["score"]))
    assert "u7" not in lists
    held = np.flatnonzero(matrix.any(0))
    for i in np.flatnonzero(matrix.any(1)):
        new = [j for j in held if matrix[i, j] == 0]
        assert len(lists.get(f"u{i}", [])) == min(3, len(new))
        for _, product, score in lists.get(f"u{i}", []):
            assert matrix[i, int(product[1:])] == 0 and score == pytest.approx(0, abs=1e-6)


def test_lists_from_factors_equal_dense_decomposition(spark, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK_ITEMS", 5)
    rng = np.random.default_rng(6)
    matrix = np.where(rng.random((50, 36)) < 0.3, rng.integers(1, 9, (50, 36)), 0) * rng.integers(1, 6, 36)
    u, s, vt = np.linalg.svd(matrix, full_matrices=False)
    expected = (u[:, :5] * s[:5]) @ vt[:5]
    got, report = {}, {}
    for r in factorization.recommend_factors(entries_of(spark, matrix), 4, 5, 60, report).collect():
        got.setdefault(r["customer_id"], {})[r["rank"]] = (r["product_id"], r["score"])
    for i in range(50):
        order = [j for j in np.argsort(-expected[i]) if matrix[i, j] == 0][:4]
        assert [got[f"u{i}"][n][0] for n in range(1, 5)] == [f"p{j}" for j in order]
        assert [got[f"u{i}"][n][1] for n in range(1, 5)] == pytest.approx(expected[i, order], abs=1e-5)
    assert report["asked"] < report["all"]


def test_blocks_of_a_factorization_grow_with_its_entries(spark, monkeypatch):
    entries, asked, real = entries_of(spark, np.ones((12, 10))), {}, factorization.ALS
    monkeypatch.setattr(factorization, "ALS", lambda **options: asked.update(options) or real(**options))
    assert factorization.matrix_factorization(entries, 2, 1).userFactors.count() == 12
    assert asked["numUserBlocks"] == asked["numItemBlocks"] == 10
    monkeypatch.setattr(factorization, "ALS_BLOCK_ENTRIES", 5)
    assert factorization.matrix_factorization(entries, 2, 1).itemFactors.count() == 10
    assert asked["numUserBlocks"] == asked["numItemBlocks"] == 24


def test_decay(shop):
    ds = shop(orders=[("a", "c", "2020-01-01"), ("b", "c", "2020-01-31")], items=[("a", "p", 1), ("b", "p", 1)], customers=[("c", "u")])
    assert rows(recommend.decayed_popularity(ds).select("product_id", "weight")) == [("p", 1.5)]


def test_items_are_counted_once_on_their_way_to_persons(shop, no_broadcast, monkeypatch):
    ds = shop(orders=[("a", "c", "2020-01-01"), ("b", "x", "2020-01-02"), ("d", "e", "2020-01-03")],
              items=[("a", "p", 1), ("a", "p", 2), ("a", "q", 3), ("b", "p", 4), (None, "p", 5)], customers=[("c", "u"), ("e", None)])
    counted, hot_keys = [], joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda facts, *others: counted.append(facts.count()) or hot_keys(facts, *others))
    found = facts.items_with_person(ds)
    assert found.columns == ["customer_id", "order_id", "product_id", "price", "freight_value", "customer_unique_id"]
    assert rows(found.select("customer_id", "order_id", "product_id", "customer_unique_id")) == [
        ("c", "a", "p", "u"), ("c", "a", "p", "u"), ("c", "a", "q", "u")]
    assert counted == [3, 4]  # orders, then items; never their join


def test_what_an_evaluation_reads_often_is_written(shop):
    ds = shop(orders=[(f"o{d}", "c", f"2020-01-0{d}") for d in range(1, 6)], items=[(f"o{d}", f"p{d}", 1) for d in range(1, 6)], customers=[("c", "u")])
    known, truth = evaluation.held_out(ds)
    assert rows(known.order_items.select("order_id")) == [(f"o{d}",) for d in range(1, 5)] and rows(truth) == [("u", "p5")]
    for table in (known.orders, known.order_items, truth):
        assert table.inputFiles() and all("/basketlens-" in f for f in table.inputFiles())
