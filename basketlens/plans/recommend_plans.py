"""Baskets, recommendations and their evaluation over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.functions.shared_tables import new_path, written_table
from basketlens.operators import baskets, evaluation, recommend, splits
from basketlens.operators.recommend import Recommender
from basketlens.plans.base import Plan, retail, rounded, sql
from basketlens.plans.feature_plans import TIME_SPLIT
from basketlens.sources.star_schema import load_star_schema

MIN_SUPPORT = 2  # the test orders are small; the largest pair count is 5
ITEMSET_SUPPORT = 0.01
K = 5

# --- baskets ---------------------------------------------------------------

HELD = "SELECT DISTINCT order_id, category AS item FROM d_items JOIN d_products USING (product_id) WHERE category IS NOT NULL"
PAIRS = f"""SELECT a.item AS item_1, b.item AS item_2, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(DISTINCT order_id)
    FROM d_items) AS support FROM held a JOIN held b ON a.order_id = b.order_id AND a.item < b.item GROUP BY ALL
    HAVING count(*) >= {ITEMSET_SUPPORT} * (SELECT count(DISTINCT order_id) FROM d_items)"""
SUPPORTS = """SELECT item, CAST(count(*) AS DOUBLE) / (SELECT count(DISTINCT order_id) FROM d_items) AS s FROM held GROUP BY item"""
CONFIDENCE = 0.1  # brands are bought at random here: a higher bound leaves no rule
RULES = f"""SELECT * FROM (SELECT a AS antecedent, c AS consequent, support, support / x.s AS confidence, support / x.s / y.s AS lift
    FROM (SELECT item_1 AS a, item_2 AS c, support FROM pairs UNION ALL SELECT item_2, item_1, support FROM pairs)
    JOIN supports x ON x.item = a JOIN supports y ON y.item = c) WHERE confidence >= {CONFIDENCE} AND lift >= 1.0"""
BASKET_CTES = {"held": HELD, "pairs": PAIRS, "supports": SUPPORTS, "rules": RULES}


def _rules(ds):
    return baskets.association_rules(baskets.basket_lines(ds), ITEMSET_SUPPORT, CONFIDENCE, 1.0)


def _basket_recommend(ds):
    lines = baskets.basket_lines(ds)
    held = lines.filter(F.col("item").isNotNull()).select(F.col("order_id").alias("basket"), "item")
    rules = baskets.association_rules(lines, ITEMSET_SUPPORT, CONFIDENCE, 1.0)
    rounded_rules = rules.withColumns({"confidence": F.round("confidence", 6), "lift": F.round("lift", 6)})
    return baskets.basket_recommend(rounded_rules, held, K)


def _itemsets(ds):
    found = baskets.frequent_itemsets_fpgrowth(baskets.basket_lines(ds), ITEMSET_SUPPORT)
    return found.select(F.concat_ws("|", F.array_sort("items")).alias("items"), "freq")


def _sets_sql(support: float) -> str:
    """Sorted lists of 1 to 7 items; an order has 7 lines at most."""
    selects = []
    for size in range(1, 8):
        names = "abcdefg"[:size]
        joins = f"held {names[0]} " + " ".join(
            f"JOIN held {y} ON {x}.order_id = {y}.order_id AND {x}.item < {y}.item" for x, y in zip(names, names[1:])
        )
        items = ", ".join(f"{n}.item" for n in names)
        selects.append(
            f"SELECT [{items}] AS items, count(*) AS freq FROM {joins} GROUP BY ALL "
            f"HAVING count(*) >= ceil({support} * (SELECT count(DISTINCT order_id) FROM d_items))"
        )
    return " UNION ALL ".join(selects)


RULE_SUPPORT = 0.001  # low enough for sets of three items
SET_RULES = f"""SELECT antecedent, consequent, s.freq / total AS support, s.freq / b.freq AS confidence, s.freq / b.freq / (c.freq / total) AS lift
    FROM (SELECT freq, consequent, list_filter(items, lambda x: x <> consequent) AS antecedent
    FROM (SELECT items, freq, unnest(items) AS consequent FROM sets WHERE len(items) > 1)) s JOIN sets b ON b.items = antecedent
    JOIN sets c ON c.items = [consequent], (SELECT CAST(count(DISTINCT order_id) AS DOUBLE) AS total FROM d_items)
    WHERE s.freq / b.freq >= {CONFIDENCE} AND s.freq / b.freq / (c.freq / total) >= 1.0"""


def _set_rules(ds):
    return baskets.itemset_rules(baskets.basket_lines(ds), RULE_SUPPORT, CONFIDENCE, 1.0)


def _named_rules(ds):
    return _set_rules(ds).withColumn("antecedent", F.concat_ws("|", "antecedent"))


def _recommend_by_sets(ds):
    held = baskets.basket_lines(ds).select(F.col("order_id").alias("basket"), "item").filter("item IS NOT NULL")
    rules = _set_rules(ds).withColumns({"confidence": F.round("confidence", 6), "lift": F.round("lift", 6)})
    return baskets.basket_recommend_sets(rules, held, K)


# --- recommendations ---------------------------------------------------------


def fitted_sql(orders: str = "d_orders", items: str = "d_items") -> dict[str, str]:
    """Popularity, pairs and the customers' products, from given tables."""
    return {
        "lines_n": f"SELECT order_id, product_id, count(*) AS n FROM {items} GROUP BY ALL",
        "pop": f"SELECT product_id, count(*) AS purchase_count FROM {items} GROUP BY product_id",
        "pairs": f"""SELECT a.product_id AS p1, b.product_id AS p2, sum(a.n * b.n) AS c FROM lines_n a JOIN lines_n b
            ON a.order_id = b.order_id AND a.product_id <> b.product_id GROUP BY ALL HAVING sum(a.n * b.n) >= {MIN_SUPPORT}
            UNION ALL SELECT product_id, product_id, sum(n * (n - 1)) FROM lines_n GROUP BY product_id
            HAVING sum(n * (n - 1)) >= {MIN_SUPPORT}""",
        "bought": f"""SELECT DISTINCT person AS who, product_id FROM {items} JOIN {orders} USING (order_id)
            JOIN d_customers USING (customer_id)""",
    }


def _top(rows: str, k: int, order: str = "score DESC, product_id") -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY who ORDER BY {order}) AS rank FROM ({rows}))
        WHERE rank <= {k}"""


def popular_sql(people: str, k: int) -> str:
    return _top(f"""SELECT who, product_id, purchase_count AS score, 'popularity' AS method FROM {people}, pop
        WHERE NOT EXISTS (SELECT 1 FROM bought b WHERE b.who = {people}.who AND b.product_id = pop.product_id)""", k)


PEOPLE = "SELECT DISTINCT person AS who FROM d_customers"
PARTNERS = "SELECT who, p2 AS product_id, sum(c) AS score FROM bought JOIN pairs ON p1 = product_id GROUP BY ALL"


def copurchase_ctes(people: str, k: int) -> dict[str, str]:
    new = f"""SELECT who, product_id, score, 'copurchase' AS method FROM partners WHERE who IN (SELECT who FROM {people}) AND
        NOT EXISTS (SELECT 1 FROM bought b WHERE b.who = partners.who AND b.product_id = partners.product_id)"""
    return {
        "partners": PARTNERS,
        "co": _top(new, k),
        "unpaired": f"SELECT who FROM {people} WHERE who NOT IN (SELECT who FROM partners)",
        "copurchase": f"SELECT who, product_id, score, method, rank FROM co UNION ALL "
        f"SELECT who, product_id, score, method, rank FROM ({popular_sql('unpaired', k)})",
    }


def hybrid_sql(people: str, k: int) -> str:
    filler = f"""SELECT who, product_id, purchase_count AS score, 'popularity' AS method, 1 AS part FROM {people}, pop WHERE NOT EXISTS
        (SELECT 1 FROM bought b WHERE b.who = {people}.who AND b.product_id = pop.product_id) AND NOT EXISTS
        (SELECT 1 FROM co WHERE co.who = {people}.who AND co.product_id = pop.product_id)"""
    both = f"SELECT who, product_id, score, method, 0 AS part FROM co UNION ALL {filler}"
    return f"SELECT who, product_id, score, method, rank FROM ({_top(both, k, 'part, score DESC, product_id')})"


def result_sql(table: str) -> str:
    return f"""SELECT who AS customer_id, CAST(rank AS INTEGER) AS rank, product_id, round(CAST(score AS DOUBLE), 6) AS score,
        method FROM {table}"""


FITTED = {"people": PEOPLE, **fitted_sql()}
LIKED = """SELECT *, count(*) OVER (PARTITION BY who) AS cats FROM (SELECT person AS who, category, row_number() OVER
    (PARTITION BY person ORDER BY count(*) DESC, category) AS place FROM d_items JOIN d_orders USING (order_id)
    JOIN d_customers USING (customer_id) JOIN d_products USING (product_id) WHERE category IS NOT NULL
    GROUP BY person, category) WHERE place <= 3"""


def category_sql(k: int) -> str:
    return f"""SELECT who, product_id, score, 'category_aware' AS method, rank FROM ({_top(f'''SELECT * FROM (SELECT who, product_id,
        place, coalesce(purchase_count, 0) AS score, greatest(1, {k} // cats) AS need, row_number() OVER (PARTITION BY who, category
        ORDER BY coalesce(purchase_count, 0) DESC, product_id) AS i FROM liked JOIN d_products USING (category)
        LEFT JOIN pop USING (product_id) WHERE NOT EXISTS (SELECT 1 FROM bought b WHERE b.who = liked.who AND
        b.product_id = d_products.product_id)) WHERE i <= need''', k, 'place, score DESC, product_id')})"""


def _model(ds):
    return Recommender.fit(ds, MIN_SUPPORT)


def _saved(spark, folder):
    """Lists of a recommender that was saved and loaded."""
    ds, path = load_star_schema(spark, folder), new_path(spark, "model")
    _model(ds).save(path)
    return rounded(recommend.recommend(Recommender.load(spark, path), ds, "popularity", k=K))


def _explain(ds):
    """Reasons for everything recommended, plus one unknown product each."""
    recs = recommend.recommend(_model(ds), ds, "hybrid", k=K).select(F.col("customer_id").alias("who"), "product_id")
    unknown = recommend.all_people(ds).withColumn("product_id", F.lit(-1).cast("long"))
    found = recommend.explain_recommendation(ds, recs.unionByName(unknown))
    return found.withColumn("reasons", F.concat_ws("; ", "reasons"))


EXPLAIN = """SELECT who AS customer_id, product_id, category, CASE WHEN p.product_id IS NULL THEN 'Product not found'
    ELSE coalesce(nullif(concat_ws('; ', CASE WHEN purchase_count > 100 THEN 'Popular product (' || purchase_count || ' purchases)' END,
    CASE WHEN mine > 0 THEN 'You''ve purchased ' || mine || ' items from ' || category || ' category' END), ''),
    'Trending product in our store') END AS reasons FROM (SELECT who, product_id FROM hybrid UNION ALL SELECT who, -1 FROM people) r
    LEFT JOIN d_products p USING (product_id) LEFT JOIN pop USING (product_id) LEFT JOIN (SELECT person AS who, category,
    count(*) AS mine FROM d_items JOIN d_orders USING (order_id) JOIN d_customers USING (customer_id)
    JOIN d_products USING (product_id) GROUP BY ALL) USING (who, category)"""


def _interactions(ds):
    return recommend.user_item_interactions(ds)


INTERACTIONS = """SELECT person AS customer_unique_id, product_id, dense_rank() OVER (ORDER BY person) - 1 AS user_index,
    dense_rank() OVER (ORDER BY product_id) - 1 AS item_index, count(*) AS purchases FROM d_items JOIN d_orders USING (order_id)
    JOIN d_customers USING (customer_id) GROUP BY person, product_id"""

# --- evaluation ----------------------------------------------------------------

EVALUATION_CTES = {
    "s": TIME_SPLIT,
    "t_orders": "SELECT * FROM d_orders WHERE order_id IN (SELECT order_id FROM s WHERE split = 'train')",
    "t_items": "SELECT * FROM d_items WHERE order_id IN (SELECT order_id FROM s WHERE split = 'train')",
    "truth": """SELECT DISTINCT person AS who, product_id FROM d_items JOIN s USING (order_id) JOIN d_customers USING (customer_id)
        WHERE split = 'test'""",
    "people": "SELECT DISTINCT who FROM truth",
    **fitted_sql("t_orders", "t_items"),
    "popularity": f"SELECT who, product_id, score, method, rank FROM ({popular_sql('people', K)})",
    **copurchase_ctes("people", K),
    "hybrid": hybrid_sql("people", K),
}


def scores_sql(recs: str) -> str:
    """One row per person of the truth."""
    ideal = "[" + ", ".join(" + ".join(f"1 / log2({j + 1})" for j in range(1, i + 1)) for i in range(1, K + 1)) + "]"
    return f"""SELECT who, coalesce(returned, 0) AS returned, relevant, coalesce(hits, 0) AS hits,
        coalesce(hits, 0) / {K}.0 AS precision_at_k, coalesce(hits / returned, 0) AS precision_at_returned,
        coalesce(hits, 0) / relevant AS recall_at_k, coalesce(gain, 0) / least(relevant, {K}) AS average_precision,
        coalesce(dcg, 0) / ({ideal})[CAST(least(relevant, {K}) AS BIGINT)] AS ndcg, coalesce(categories / returned, 0) AS diversity,
        coalesce(surprise / returned, 0) AS novelty FROM (SELECT who, CAST(count(*) AS DOUBLE) AS relevant FROM truth GROUP BY who)
        LEFT JOIN (SELECT who, CAST(count(*) AS DOUBLE) AS returned, CAST(sum(hit) AS DOUBLE) AS hits, sum(hit * so_far / rank) AS gain,
        sum(hit / log2(rank + 1)) AS dcg, count(DISTINCT category) AS categories,
        sum(coalesce(-log2(sold / (SELECT CAST(count(*) AS DOUBLE) FROM d_items)), 0)) AS surprise FROM
        (SELECT *, sum(hit) OVER (PARTITION BY who ORDER BY rank) AS so_far FROM (SELECT r.who, r.rank, category, sold,
        CAST(t.who IS NOT NULL AS DOUBLE) AS hit FROM {recs} r LEFT JOIN truth t USING (who, product_id)
        LEFT JOIN d_products USING (product_id) LEFT JOIN (SELECT product_id, count(*) AS sold FROM d_items GROUP BY 1)
        USING (product_id))) GROUP BY who) USING (who)"""


def _coverage_sql(recs: str) -> str:
    return f"""(SELECT CAST(count(DISTINCT product_id) AS DOUBLE) FROM {recs} WHERE who IN (SELECT who FROM truth))
        / (SELECT count(*) FROM d_products)"""


def evaluate_sql(methods: tuple[str, ...] = ("popularity", "copurchase", "hybrid")) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{m}' AS method, CAST({K} AS INTEGER) AS k, round(precision_at_k, 6) AS precision_at_k,
        round(precision_at_returned, 6) AS precision_at_returned, round(recall_at_k, 6) AS recall_at_k,
        round(coalesce(2 * precision_at_returned * recall_at_k / nullif(precision_at_returned + recall_at_k, 0), 0), 6) AS f1_at_k,
        round(map_at_k, 6) AS map_at_k, round(ndcg_at_k, 6) AS ndcg_at_k, round({_coverage_sql(m)}, 6) AS coverage,
        round(diversity, 6) AS diversity, round(novelty, 6) AS novelty, customers FROM (SELECT avg(precision_at_k) AS precision_at_k,
        avg(precision_at_returned) AS precision_at_returned, avg(recall_at_k) AS recall_at_k, avg(average_precision) AS map_at_k,
        avg(ndcg) AS ndcg_at_k, avg(diversity) AS diversity, avg(novelty) AS novelty, count(*) AS customers FROM ({scores_sql(m)}))"""
        for m in methods
    )


def _held_out(measure):
    """Run a measure on hybrid recommendations made from the train orders."""

    def run(spark, folder):
        ds = load_star_schema(spark, folder)
        known, truth = evaluation.held_out(ds)
        people = truth.select(F.col("customer_id").alias("who")).distinct()
        recs = written_table(recommend.recommend(_model(known), known, "hybrid", people, K), "recs")
        return rounded(measure(recs, truth, ds))

    return run


def _ground_truth(ds):
    _, test_orders = splits.train_and_test(ds)
    return evaluation.ground_truth(ds, test_orders)


def _measured(select: str) -> str:
    return sql(f"SELECT {select} FROM ({scores_sql('hybrid')})", **EVALUATION_CTES)


PLANS = {
    "transactions": Plan(
        retail(baskets.basket_lines),
        sql("SELECT order_id, category AS item, count(*) AS n FROM d_items LEFT JOIN d_products USING (product_id) GROUP BY ALL"),
    ),
    "transaction_stats": Plan(
        retail(lambda ds: baskets.basket_stats(baskets.basket_lines(ds))),
        sql("""SELECT count(DISTINCT order_id) AS baskets, round(CAST(count(*) AS DOUBLE) / count(DISTINCT order_id), 6) AS avg_length
            FROM d_items"""),
    ),
    "frequent_pairs": Plan(
        retail(lambda ds: baskets.frequent_pairs(baskets.basket_lines(ds), ITEMSET_SUPPORT)),
        sql("SELECT item_1, item_2, n, round(support, 6) AS support FROM pairs", held=HELD, pairs=PAIRS),
    ),
    "association_rules": Plan(
        retail(_rules),
        sql("""SELECT antecedent, consequent, round(support, 6) AS support, round(confidence, 6) AS confidence,
            round(lift, 6) AS lift FROM rules""", **BASKET_CTES),
    ),
    "basket_recommend": Plan(
        retail(_basket_recommend),
        sql(f"""SELECT basket, item, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank, 'market_basket' AS method FROM
            (SELECT *, row_number() OVER (PARTITION BY basket ORDER BY score DESC, item) AS rank FROM (SELECT h.order_id AS basket,
            consequent AS item, max(round(confidence, 6) * round(lift, 6)) AS score FROM held h JOIN rules ON antecedent = h.item
            WHERE NOT EXISTS (SELECT 1 FROM held x WHERE x.order_id = h.order_id AND x.item = consequent) GROUP BY ALL))
            WHERE rank <= {K}""", **BASKET_CTES),
    ),
    "frequent_itemsets_fpgrowth": Plan(retail(_itemsets), sql("SELECT array_to_string(items, '|') AS items, freq FROM sets",
        held=HELD, sets=_sets_sql(ITEMSET_SUPPORT))),
    "itemset_rules": Plan(
        retail(_named_rules),
        sql("""SELECT array_to_string(antecedent, '|') AS antecedent, consequent, round(support, 6) AS support,
            round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM set_rules""",
            held=HELD, sets=_sets_sql(RULE_SUPPORT), set_rules=SET_RULES),
    ),
    "basket_recommend_sets": Plan(
        lambda spark, folder: rounded(_recommend_by_sets(load_star_schema(spark, folder)), keep=("score",)),
        sql(f"""SELECT basket, item, score, CAST(rank AS INTEGER) AS rank, 'market_basket' AS method FROM
            (SELECT *, row_number() OVER (PARTITION BY basket ORDER BY score DESC, item) AS rank FROM (SELECT h.basket, consequent AS item,
            max(round(confidence, 6) * round(lift, 6)) AS score FROM (SELECT order_id AS basket, list(item) AS items FROM held GROUP BY 1) h
            JOIN set_rules ON list_has_all(h.items, antecedent) AND NOT list_contains(h.items, consequent) GROUP BY ALL)) WHERE rank <= {K}""",
            held=HELD, sets=_sets_sql(RULE_SUPPORT), set_rules=SET_RULES),
    ),
    "popularity": Plan(
        retail(recommend.popularity),
        sql("SELECT product_id, count(*) AS purchase_count, category FROM d_items LEFT JOIN d_products USING (product_id) GROUP BY ALL"),
    ),
    "copurchase_pairs": Plan(
        retail(lambda ds: recommend.copurchase_pairs(ds, MIN_SUPPORT)),
        sql("SELECT p1 AS product_id_1, p2 AS product_id_2, CAST(c AS BIGINT) AS co_purchase_count FROM pairs", **fitted_sql()),
    ),
    "recommend_popular": Plan(
        retail(lambda ds: recommend.recommend(_model(ds), ds, "popularity", k=K)),
        sql(result_sql("popular"), **FITTED, popular=popular_sql("people", K)),
    ),
    "recommend_saved_model": Plan(_saved, sql(result_sql("popular"), **FITTED, popular=popular_sql("people", K))),
    "recommend_copurchase": Plan(
        retail(lambda ds: recommend.recommend(_model(ds), ds, "copurchase", k=K)),
        sql(result_sql("copurchase"), **FITTED, **copurchase_ctes("people", K)),
    ),
    "recommend_hybrid": Plan(
        retail(lambda ds: recommend.recommend(_model(ds), ds, "hybrid", k=K)),
        sql(result_sql("hybrid"), **FITTED, **copurchase_ctes("people", K), hybrid=hybrid_sql("people", K)),
    ),
    "recommend_category": Plan(
        retail(lambda ds: recommend.recommend_category(ds, k=K)),
        sql(result_sql("category_aware"), **FITTED, liked=LIKED, category_aware=category_sql(K)),
    ),
    "explain_recommendation": Plan(
        retail(_explain),
        sql(EXPLAIN, **FITTED, **copurchase_ctes("people", K), hybrid=hybrid_sql("people", K)),
    ),
    "temporal_weights": Plan(
        retail(recommend.temporal_weights),
        sql("""SELECT order_id, days_ago, round(pow(0.5, days_ago / 30.0), 6) + 0.0 AS temporal_weight FROM (SELECT order_id,
            date_sub('day', ts, (SELECT max(ts) FROM d_orders)) AS days_ago FROM d_orders)"""),
    ),
    "decayed_popularity": Plan(
        retail(recommend.decayed_popularity),
        sql("""SELECT product_id, round(sum(pow(0.5, date_sub('day', ts, (SELECT max(ts) FROM d_orders)) / 30.0)), 6) AS weight,
            count(*) AS purchase_count FROM d_items JOIN d_orders USING (order_id) GROUP BY product_id"""),
    ),
    "user_item_interactions": Plan(retail(_interactions), sql(INTERACTIONS)),
    "ground_truth": Plan(retail(_ground_truth), sql("SELECT who AS customer_id, product_id FROM truth", **EVALUATION_CTES)),
    "precision_recall_at_k": Plan(
        _held_out(lambda r, t, ds: evaluation.precision_recall_at_k(r, t, K)),
        _measured("round(avg(precision_at_k), 6) AS precision_at_k, round(avg(recall_at_k), 6) AS recall_at_k, count(*) AS customers"),
    ),
    "precision_at_returned": Plan(
        _held_out(lambda r, t, ds: evaluation.precision_at_returned(r, t, K)),
        _measured("round(avg(precision_at_returned), 6) AS precision_at_returned, round(avg(recall_at_k), 6) AS recall_at_k, "
                  "round(coalesce(2 * avg(precision_at_returned) * avg(recall_at_k) / nullif(avg(precision_at_returned) "
                  "+ avg(recall_at_k), 0), 0), 6) AS f1_at_k"),
    ),
    "map_at_k": Plan(
        _held_out(lambda r, t, ds: evaluation.map_at_k(r, t, K)), _measured("round(avg(average_precision), 6) AS map_at_k")
    ),
    "ndcg_at_k": Plan(_held_out(lambda r, t, ds: evaluation.ndcg_at_k(r, t, K)), _measured("round(avg(ndcg), 6) AS ndcg_at_k")),
    "coverage": Plan(
        _held_out(lambda r, t, ds: evaluation.coverage(r, t, ds, K)),
        sql(f"""SELECT (SELECT count(DISTINCT product_id) FROM hybrid) AS recommended, (SELECT count(*) FROM d_products) AS catalogue,
            round({_coverage_sql('hybrid')}, 6) AS coverage""", **EVALUATION_CTES),
    ),
    "diversity": Plan(
        _held_out(lambda r, t, ds: evaluation.diversity(r, t, ds, K)), _measured("round(avg(diversity), 6) AS diversity")
    ),
    "novelty": Plan(_held_out(lambda r, t, ds: evaluation.novelty(r, t, ds, K)), _measured("round(avg(novelty), 6) AS novelty")),
    "evaluate_methods": Plan(
        retail(lambda ds: evaluation.evaluate_methods(ds, k=K, min_support=MIN_SUPPORT)), sql(evaluate_sql(), **EVALUATION_CTES)
    ),
}
