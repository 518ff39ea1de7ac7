"""Churn data sets, classifiers and their measures over the test tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from basketlens.functions.shared_tables import written_table
from basketlens.operators import churn, classifiers
from basketlens.operators.neighbours import nearest_in_group
from basketlens.operators.smote import smote_rows
from basketlens.plans.base import TABLES, Plan, retail, rounded, sql
from basketlens.plans.feature_plans import AFFINITY, LIFETIME, ORDER_VALUES, SCORE_CTES
from basketlens.sources.star_schema import load_star_schema, read_table

WINDOW = 90

LAST_ORDER = f"""SELECT person AS customer_unique_id, max(gap) FILTER (WHERE i = n) AS recency_days, n - 1 AS frequency,
    coalesce(CAST(sum(v) FILTER (WHERE i < n) AS DOUBLE), 0.0) AS monetary,
    coalesce(CAST(sum(v) FILTER (WHERE i < n) AS DOUBLE) / count(v) FILTER (WHERE i < n), 0.0) AS avg_order_value,
    coalesce(avg(gap) FILTER (WHERE i < n), 0.0) AS avg_days_between_orders,
    coalesce(stddev_samp(gap) FILTER (WHERE i < n), 0.0) AS std_days_between_orders,
    date_sub('day', max(ts), (SELECT max(ts) FROM d_orders)) AS days_since_last,
    CAST(date_sub('day', max(ts), (SELECT max(ts) FROM d_orders)) > {WINDOW} AS INTEGER) AS churn
    FROM (SELECT person, ts, v, row_number() OVER w AS i, count(*) OVER (PARTITION BY person) AS n,
    date_sub('day', lag(ts) OVER w, ts) AS gap FROM d_orders JOIN d_customers USING (customer_id)
    LEFT JOIN order_values USING (order_id) WINDOW w AS (PARTITION BY person ORDER BY ts, order_id)) WHERE n >= 2 GROUP BY person, n"""
EXACT = ("monetary", "avg_order_value", "avg_days_between_orders")
CHURN_RFM = f"""SELECT t.*, customer_lifetime_days, avg_days_between_orders, unique_categories_purchased,
    CAST(date_sub('day', last_purchase, (SELECT max(ts) FROM d_orders)) > {WINDOW} AS INTEGER) AS churned
    FROM totals t JOIN lifetime USING (customer_unique_id)"""


CUT = f"(SELECT max(o_orderdate) - INTERVAL {WINDOW} DAY FROM orders)"


def _events(spark, folder):
    events = read_table(spark, folder, "events")
    return events.select("event_id", (F.col("event_type") == "purchase").cast("int").alias("label"), F.col("value").alias("score"))


EVENTS = """SELECT "value" AS score, CAST(event_type = 'purchase' AS INTEGER) AS label FROM events"""
STEPS = """SELECT score, sum(label) AS p, count(*) - sum(label) AS n, sum(sum(label)) OVER w AS tp,
    sum(count(*) - sum(label)) OVER w AS fp FROM scored GROUP BY score WINDOW w AS (ORDER BY score DESC)"""


def _labels(spark, folder):
    """How well "not toxic" predicts quality."""
    return read_table(spark, folder, "labels").select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("guess"))


METRICS = """SELECT c AS class, support, predicted, correct, round(p, 6) AS precision, round(r, 6) AS recall,
    round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1, (SELECT round(avg(CAST(label = guess AS INTEGER)), 6) FROM g) AS accuracy,
    (SELECT round(greatest(avg(label), 1 - avg(label)), 6) FROM g) AS majority_baseline
    FROM (SELECT *, coalesce(CAST(correct AS DOUBLE) / nullif(predicted, 0), 0) AS p,
    coalesce(CAST(correct AS DOUBLE) / nullif(support, 0), 0) AS r FROM (SELECT c, (SELECT count(*) FROM g WHERE label = c) AS support,
    (SELECT count(*) FROM g WHERE guess = c) AS predicted, (SELECT count(*) FROM g WHERE label = c AND guess = c) AS correct
    FROM (SELECT DISTINCT label AS c FROM g UNION SELECT DISTINCT guess FROM g)))"""


def _last_order(ds):
    return churn.churn_dataset_last_order(ds, WINDOW)


def _weights(spark, folder):
    found = classifiers.class_weights(read_table(spark, folder, "events").select("event_id", "event_type"), "event_type")
    return rounded(found)


def _oversample(spark, folder):
    return classifiers.oversample(_events(spark, folder).drop("score"), "event_id", "label")


OVERSAMPLED = """SELECT event_id, label, unnest(range(1, most // n + CAST(rn <= most % n AS INTEGER) + 1)) AS copy FROM
    (SELECT *, max(n) OVER () AS most FROM (SELECT event_id, label, row_number() OVER (PARTITION BY label
    ORDER BY md5(event_id || '_42'), event_id) AS rn, count(*) OVER (PARTITION BY label) AS n FROM
    (SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS label FROM events)))"""


def _preprocess(spark, folder):
    """Scaled line item figures; the tax-included price repeats the price."""
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("charged"),
        F.lit(1.0).alias("flat"),
    )
    scaled, _ = classifiers.preprocess_features(lines, ["l_quantity", "l_extendedprice", "charged", "flat"])
    return rounded(scaled, 4)


def _report(spark, folder):
    data = _last_order(load_star_schema(spark, folder))
    return rounded(classifiers.churn_report(data))


def _importance(spark, folder):
    data = _last_order(load_star_schema(spark, folder))
    model, _ = classifiers.train_churn(data)
    return rounded(classifiers.feature_importance(model, churn.LAST_ORDER_FEATURES, spark))


def _score(spark, folder):
    return rounded(classifiers.score_all_customers(load_star_schema(spark, folder)))


def _at_risk(spark, folder):
    return classifiers.at_risk_customers(_score(spark, folder))


def _ahead_data(spark, folder):
    """Written once: every learner and fold reads it."""
    return written_table(churn.churn_dataset_ahead(load_star_schema(spark, folder), WINDOW), "churn-ahead")


def _compare(spark, folder):
    return rounded(classifiers.compare_models(_ahead_data(spark, folder), churn.RFM_FEATURES, "churned"))


def _cross_validate(spark, folder):
    learner = LogisticRegression(labelCol="churned", maxIter=100)
    return rounded(classifiers.cross_validate(_ahead_data(spark, folder), churn.RFM_FEATURES, "churned", learner))


def _compare_smote(spark, folder):
    learners = {n: m for n, m in classifiers.classifiers("churned").items() if n in ("Logistic Regression", "Naive Bayes")}
    return rounded(classifiers.compare_models(_ahead_data(spark, folder), churn.RFM_FEATURES, "churned", learners, balance="smote"))


# Documents with a toxic label, and three counts of their texts.
MARKED = """SELECT doc_id, toxic, CAST(n_chars AS DOUBLE) AS chars, CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS spaces,
    CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS es FROM documents JOIN labels USING (doc_id)"""
COUNTS = ["chars", "spaces", "es"]


def _marked(spark, folder):
    """All labelled documents, as a training part."""
    documents, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    length = lambda c: F.length(F.replace("text", F.lit(c)))
    counts = [F.col("n_chars"), F.length("text") - length(" "), F.length("text") - length("e")]
    joined = documents.join(labels, "doc_id")
    return joined.select("doc_id", "toxic", *[c.cast("double").alias(n) for c, n in zip(counts, COUNTS)])


# All pairs of one class, the nearest first; distances add up column by column.
NEAREST = f"""SELECT a.doc_id, a.toxic, b.doc_id AS neighbour, {" + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in COUNTS)} AS gap,
    row_number() OVER (PARTITION BY a.doc_id ORDER BY {" + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in COUNTS)}, b.doc_id) AS rank
    FROM marked a JOIN marked b ON a.toxic = b.toxic AND a.doc_id <> b.doc_id QUALIFY rank <= 5"""
BITS = "CAST('0x' || substr(md5(concat_ws('_', doc_id, copy, 42, '{what}')), 1, 8) AS BIGINT)"
SMOTE = f"""SELECT c.doc_id, c.toxic, c.copy, c.neighbour, c.share, {", ".join(f"a.{x} + c.share * (b.{x} - a.{x}) AS {x}" for x in COUNTS)} FROM
    (SELECT c.*, n.neighbour FROM (SELECT *, {BITS.format(what="neighbour")} % held AS pick, {BITS.format(what="share")} / 4294967296.0::DOUBLE AS share FROM
    (SELECT doc_id, toxic, held, CAST(unnest(range(1, (most - n) // n + CAST(r <= (most - n) % n AS INTEGER) + 1)) AS INTEGER) AS copy FROM
    (SELECT *, max(n) OVER () AS most, least(n - 1, 5) AS held FROM (SELECT doc_id, toxic, count(*) OVER (PARTITION BY toxic) AS n,
    row_number() OVER (PARTITION BY toxic ORDER BY md5(doc_id || '_42'), doc_id) AS r FROM marked)))) c
    JOIN nearest n ON n.doc_id = c.doc_id AND n.rank = pick + 1) c
    JOIN marked a ON a.doc_id = c.doc_id JOIN marked b ON b.doc_id = c.neighbour"""


def _nearest(spark, folder):
    found = nearest_in_group(_marked(spark, folder), "doc_id", "toxic", COUNTS)
    listed = found.select("doc_id", "toxic", F.posexplode("neighbours").alias("rank", "n"))
    return rounded(listed.select("doc_id", "toxic", (F.col("rank") + 1).alias("rank"), F.col("n.key").alias("neighbour"), F.col("n.distance").alias("distance")))


def _smote(spark, folder):
    return rounded(smote_rows(_marked(spark, folder), "doc_id", "toxic", COUNTS))


def _naive_bayes(spark, folder):
    """How toxic the counts of a document make it look to the learner of the
    comparison that has a closed form."""
    marked = _marked(spark, folder).dropna()
    learner = classifiers.classifiers("toxic")["Naive Bayes"]
    model = Pipeline(stages=[VectorAssembler(inputCols=COUNTS, outputCol="features"), learner]).fit(marked)
    return rounded(classifiers.probability_of_one(model, marked).select("doc_id", "score"))


# Means and variances of each class and count; the largest variance of a
# count, by 1e-9, is added to all.
NAIVE_BAYES = f"""WITH marked AS (SELECT * FROM ({MARKED}) WHERE toxic IS NOT NULL AND chars IS NOT NULL AND spaces IS NOT NULL),
    widest AS (SELECT greatest({", ".join(f"var_pop({c})" for c in COUNTS)}) * 1e-9 AS e FROM marked),
    class AS (SELECT toxic, ln(count(*)) AS prior, {", ".join(f"avg({c}) AS m_{c}, var_pop({c}) + any_value(e) AS s_{c}" for c in COUNTS)}
    FROM marked, widest GROUP BY toxic),
    fit AS (SELECT doc_id, m.toxic, c.toxic AS class, prior - 0.5 * ({" + ".join(f"ln(s_{c}) + ({c} - m_{c}) * ({c} - m_{c}) / s_{c}" for c in COUNTS)}) AS l
    FROM marked m, class c)
    SELECT doc_id, round(1 / (1 + exp(any_value(l) FILTER (WHERE class = 0) - any_value(l) FILTER (WHERE class = 1))), 6) + 0.0 AS score
    FROM fit GROUP BY doc_id"""


def _areas(spark, folder):
    """How well the value tells purchases, hour by hour."""
    scored = _events(spark, folder).withColumn("hour", (F.col("event_id") % 24).cast("int"))
    return rounded(classifiers.roc_auc_by(scored, ["hour"], "label", "score"))


def _tune(spark, folder):
    learner = LogisticRegression(labelCol="churned", maxIter=50)
    space = {"regParam": [0.0, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]}
    return rounded(classifiers.tune_model(_ahead_data(spark, folder), churn.RFM_FEATURES, "churned", learner, space))


PLANS = {
    "churn_dataset_last_order": Plan(
        lambda spark, folder: rounded(_last_order(load_star_schema(spark, folder)), 4, EXACT),
        sql(f"SELECT * REPLACE (round(std_days_between_orders, 4) AS std_days_between_orders) FROM ({LAST_ORDER})",
            order_values=ORDER_VALUES),
    ),
    "churn_dataset_rfm": Plan(
        retail(lambda ds: churn.churn_dataset_rfm(ds, WINDOW)),
        sql(f"""SELECT * REPLACE (round(monetary, 6) AS monetary, round(avg_days_between_orders, 6) AS avg_days_between_orders)
            FROM ({CHURN_RFM})""", **SCORE_CTES, affinity=AFFINITY, lifetime=LIFETIME),
    ),
    "churn_dataset_ahead": Plan(
        retail(lambda ds: churn.churn_dataset_ahead(ds, WINDOW)),
        sql(f"""SELECT t.* REPLACE (round(monetary, 6) AS monetary), customer_lifetime_days,
            round(avg_days_between_orders, 6) AS avg_days_between_orders, unique_categories_purchased,
            CAST(customer_unique_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate > {CUT}) AS INTEGER) AS churned
            FROM totals t JOIN lifetime USING (customer_unique_id)""",
            d_orders=f"SELECT * FROM ({TABLES['d_orders']}) WHERE ts <= {CUT}", **SCORE_CTES, affinity=AFFINITY, lifetime=LIFETIME),
    ),
    "classification_metrics": Plan(
        lambda spark, folder: rounded(classifiers.classification_metrics(_labels(spark, folder), "label", "guess")),
        sql(METRICS, g="SELECT quality AS label, 1 - toxic AS guess FROM labels"),
    ),
    "confusion_matrix": Plan(
        lambda spark, folder: classifiers.confusion(_labels(spark, folder), "label", "guess"),
        "SELECT quality AS label, 1 - toxic AS prediction, count(*) AS n FROM labels GROUP BY ALL",
    ),
    "roc_curve": Plan(
        lambda spark, folder: rounded(classifiers.roc_curve(_events(spark, folder), "label", "score")),
        f"""WITH scored AS ({EVENTS}), steps AS ({STEPS}) SELECT round(score, 6) AS threshold, round(CAST(fp AS DOUBLE)
        / (SELECT sum(n) FROM steps), 6) AS fpr, round(CAST(tp AS DOUBLE) / (SELECT sum(p) FROM steps), 6) AS tpr FROM steps""",
    ),
    "roc_curve_thinned": Plan(
        lambda spark, folder: rounded(classifiers.roc_curve(_events(spark, folder), "label", "score", points=100)),
        f"""WITH scored AS ({EVENTS}), steps AS ({STEPS}), total AS (SELECT sum(n + p) AS t FROM steps) SELECT round(score, 6) AS threshold,
        round(CAST(fp AS DOUBLE) / (SELECT sum(n) FROM steps), 6) AS fpr, round(CAST(tp AS DOUBLE) / (SELECT sum(p) FROM steps), 6) AS tpr
        FROM steps, total WHERE (tp + fp) * 100 // t > (tp + fp - p - n) * 100 // t""",
    ),
    "pr_curve": Plan(
        lambda spark, folder: rounded(classifiers.pr_curve(_events(spark, folder), "label", "score")),
        f"""WITH scored AS ({EVENTS}), steps AS ({STEPS}) SELECT round(score, 6) AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 6)
        AS precision, round(CAST(tp AS DOUBLE) / (SELECT sum(p) FROM steps), 6) AS recall FROM steps""",
    ),
    "roc_auc": Plan(
        lambda spark, folder: rounded(classifiers.roc_auc(_events(spark, folder), "label", "score")),
        f"""WITH scored AS ({EVENTS}), steps AS ({STEPS}) SELECT CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives,
        round(CAST(sum((tp - p) * n + p * n / 2.0) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * sum(n)), 6) AS roc_auc FROM steps""",
    ),
    "roc_auc_by_group": Plan(
        _areas,
        """SELECT hour, CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives, round(CAST(sum((tp - p) * n + p * n / 2.0)
        AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * sum(n)), 6) AS roc_auc FROM (SELECT hour, score, sum(label) AS p, count(*) - sum(label) AS n,
        sum(sum(label)) OVER (PARTITION BY hour ORDER BY score DESC) AS tp FROM (SELECT CAST(event_id % 24 AS INTEGER) AS hour,
        "value" AS score, CAST(event_type = 'purchase' AS INTEGER) AS label FROM events) GROUP BY hour, score) GROUP BY hour""",
    ),
    "nearest_in_group": Plan(
        _nearest,
        f"""WITH marked AS ({MARKED}), nearest AS ({NEAREST}) SELECT doc_id, toxic, CAST(rank AS INTEGER) AS rank, neighbour,
        round(sqrt(gap), 6) AS distance FROM nearest""",
    ),
    "smote_rows": Plan(
        _smote,
        f"""WITH marked AS ({MARKED}), nearest AS ({NEAREST}) SELECT doc_id, toxic, copy, neighbour, round(share, 6) AS share,
        {", ".join(f"round({c}, 6) AS {c}" for c in COUNTS)} FROM ({SMOTE})""",
    ),
    "naive_bayes_scores": Plan(_naive_bayes, NAIVE_BAYES),
    "compare_models_smote": Plan(_compare_smote),
    "class_weights": Plan(
        _weights,
        """SELECT event_id, event_type, round(CAST((SELECT count(*) FROM events) AS DOUBLE) / ((SELECT count(DISTINCT event_type)
        FROM events) * count(*) OVER (PARTITION BY event_type)), 6) AS weight FROM events""",
    ),
    "oversample": Plan(_oversample, OVERSAMPLED),
    "preprocess_features": Plan(
        _preprocess,
        """SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - mq) / sq, 4) + 0.0 AS l_quantity,
        round((l_extendedprice - mp) / sp, 4) + 0.0 AS l_extendedprice FROM lineitem, (SELECT avg(l_quantity) AS mq,
        stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem)""",
    ),
    "train_churn": Plan(_report),
    "feature_importance": Plan(_importance),
    "score_churn": Plan(_score),
    "at_risk_customers": Plan(_at_risk),
    "compare_models": Plan(_compare),
    "cross_validate": Plan(_cross_validate),
    "tune_model": Plan(_tune),
}
