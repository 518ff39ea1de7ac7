"""Customer features, cohorts, charts and splits over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.functions.shared_tables import new_path
from basketlens.operators import charts, features, splits
from basketlens.plans.base import Plan, retail, rounded, sql
from basketlens.plans.kpi_plans import PER_PERSON
from basketlens.sources import keyed_table
from basketlens.sources.star_schema import load_star_schema, read_table

# sums of exact decimals and one division: the same double in both engines
EXACT = ("monetary", "avg_price", "min_price", "max_price", "price_range")
ORDER_VALUES = "SELECT order_id, sum(price) AS v FROM d_items GROUP BY order_id"
RFM = """SELECT person AS customer_unique_id, date_sub('day', max(ts), (SELECT max(ts) FROM d_orders)) AS recency_days,
    count(*) AS frequency, coalesce(CAST(sum(v) AS DOUBLE), 0.0) AS monetary FROM d_orders
    JOIN d_customers USING (customer_id) LEFT JOIN order_values USING (order_id) GROUP BY person"""
RFM_RANKED = """SELECT *, row_number() OVER (ORDER BY frequency, customer_unique_id) AS rn,
    (SELECT count(*) FROM rfm) AS people FROM rfm"""


def _score(column: str) -> str:
    return " + ".join(
        f"CAST({column} > (SELECT quantile_cont(CAST({column} AS DOUBLE), {q}) FROM rfm) AS INTEGER)"
        for q in (0.2, 0.4, 0.6, 0.8)
    )


RFM_SCORES = f"""SELECT customer_unique_id, recency_days, frequency, monetary,
    CAST(5 - ({_score('recency_days')}) AS INTEGER) AS recency_score,
    CAST(greatest(1, (5 * (rn - 1) + people - 2) // (people - 1)) AS INTEGER) AS frequency_score,
    CAST(1 + {_score('monetary')} AS INTEGER) AS monetary_score FROM ranked"""
RFM_TOTAL = """SELECT *, recency_score * 100 + frequency_score * 10 + monetary_score AS rfm_score FROM scores"""
SEGMENTS = """SELECT *, CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
    WHEN frequency_score >= 4 THEN 'Loyal Customers'
    WHEN recency_score >= 4 AND frequency_score >= 2 AND monetary_score >= 2 THEN 'Potential Loyalists'
    WHEN recency_score >= 4 AND frequency_score = 1 THEN 'New Customers'
    WHEN recency_score <= 3 AND frequency_score <= 3 THEN 'Need Attention' ELSE 'Other' END AS segment FROM totals"""
SEGMENTS_NARROW = """SELECT *, CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
    WHEN recency_score <= 2 AND frequency_score >= 4 THEN 'At Risk' WHEN frequency_score >= 4 THEN 'Loyal Customers'
    WHEN recency_score >= 4 AND frequency_score >= 2 AND monetary_score >= 2 THEN 'Potential Loyalists'
    WHEN recency_score >= 4 AND frequency_score = 1 THEN 'New Customers'
    WHEN recency_score <= 2 AND monetary_score >= 4 THEN 'Can''t Lose'
    WHEN recency_score <= 2 AND frequency_score <= 2 THEN 'About to Sleep'
    WHEN recency_score <= 3 AND frequency_score <= 3 THEN 'Need Attention' ELSE 'Other' END AS segment FROM totals"""
RFM_CTES = {"order_values": ORDER_VALUES, "rfm": RFM}
SCORE_CTES = {**RFM_CTES, "ranked": RFM_RANKED, "scores": RFM_SCORES, "totals": RFM_TOTAL}

AFFINITY = """SELECT person AS customer_unique_id, category, count(*) AS purchase_count FROM d_items JOIN d_orders USING (order_id)
    JOIN d_customers USING (customer_id) JOIN d_products USING (product_id) WHERE category IS NOT NULL GROUP BY ALL"""
PRICES = """SELECT person AS customer_unique_id, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
    CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
    round(coalesce(stddev_samp(CAST(price AS DOUBLE)), 0), 4) AS std_price,
    CAST(max(price) AS DOUBLE) - CAST(min(price) AS DOUBLE) AS price_range FROM d_items
    JOIN d_orders USING (order_id) JOIN d_customers USING (customer_id) GROUP BY person"""


def preferred_sql(rows: str, person: str) -> str:
    """Most frequent hour, weekday and month of ``rows`` (person, ts)."""
    parts = {
        "preferred_hour": "date_part('hour', ts)",
        "preferred_day_of_week": "isodow(ts) - 1",
        "preferred_month": "date_part('month', ts)",
    }
    one = [
        f"""(SELECT who, CAST(v AS INTEGER) AS {name} FROM (SELECT {person} AS who, {part} AS v, row_number() OVER
        (PARTITION BY {person} ORDER BY count(*) DESC, {part}) AS rn FROM ({rows}) GROUP BY 1, 2) WHERE rn = 1)"""
        for name, part in parts.items()
    ]
    return f"SELECT who AS {person}, {', '.join(parts)} FROM {one[0]} JOIN {one[1]} USING (who) JOIN {one[2]} USING (who)"


PERSON_TIMES = "SELECT person AS customer_unique_id, ts FROM d_orders JOIN d_customers USING (customer_id)"
FEATURES = """SELECT s.*, avg_price, min_price, max_price, std_price, price_range, preferred_hour, preferred_day_of_week,
    preferred_month FROM segments s LEFT JOIN prices USING (customer_unique_id) LEFT JOIN times USING (customer_unique_id)"""
FEATURE_CTES = {
    **SCORE_CTES,
    "segments": SEGMENTS,
    "prices": PRICES,
    "times": preferred_sql(PERSON_TIMES, "customer_unique_id"),
}
LIFETIME = """SELECT person AS customer_unique_id, total_orders, first_purchase, last_purchase, customer_lifetime_days,
    customer_lifetime_days / CAST(greatest(total_orders, 1) AS DOUBLE) AS avg_days_between_orders,
    coalesce(k, 0) AS unique_categories_purchased FROM (SELECT person, count(*) AS total_orders, min(ts) AS first_purchase,
    max(ts) AS last_purchase, date_sub('day', min(ts), max(ts)) AS customer_lifetime_days FROM d_orders
    JOIN d_customers USING (customer_id) GROUP BY person) LEFT JOIN (SELECT customer_unique_id AS person, count(*) AS k
    FROM affinity GROUP BY 1) USING (person)"""
TIME_SPLIT = """SELECT order_id, customer_id, ts, CASE WHEN row_number() OVER (ORDER BY ts, order_id) <=
    floor((SELECT count(*) FROM d_orders) * 0.8) THEN 'train' ELSE 'test' END AS split FROM d_orders"""
ACTIVE = """SELECT DISTINCT person, CAST(date_trunc('month', ts) AS DATE) AS month FROM d_orders
    JOIN d_customers USING (customer_id)"""
COHORTS = """SELECT cohort, period, count(*) AS customers FROM (SELECT person, cohort,
    CAST((12 * year(month) + month(month)) - (12 * year(cohort) + month(cohort)) AS INTEGER) AS period
    FROM active JOIN (SELECT person, min(month) AS cohort FROM active GROUP BY person) USING (person)) GROUP BY ALL"""


def _prices(ds):
    return features.price_sensitivity(ds)


def _seen_customers(spark, folder):
    """Feature rows of everybody who appears in the event stream."""
    ds = load_star_schema(spark, folder)
    seen = read_table(spark, folder, "events").select(F.col("user_id").alias("customer_unique_id"))
    return rounded(features.customer_feature_lookup(features.customer_features(ds), seen), 4, EXACT)


def _seen_customers_keyed(spark, folder):
    """The same from features that are written by key once."""
    path = new_path(spark, "features")
    keyed_table.write_keyed(features.customer_features(load_star_schema(spark, folder)), path, features.PERSON, buckets=8)
    seen = read_table(spark, folder, "events").select(F.col("user_id").alias("customer_unique_id"))
    return rounded(keyed_table.read_keyed(spark, path, features.PERSON, seen, buckets=8), 4, EXACT)


def _event_times(spark, folder):
    events = read_table(spark, folder, "events")
    return features.temporal_preferences(events, "user_id", "ts")


def _lifetime(ds):
    found = features.customer_lifetime(ds)
    return found.withColumns({c: F.col(c).cast("date") for c in ("first_purchase", "last_purchase")})


def _matrix_sql() -> str:
    cells = ", ".join(
        f"""round(max(100.0 * customers / size) FILTER (WHERE period = {p}), 6) AS "{p}" """ for p in range(12)
    )
    return f"SELECT cohort, {cells} FROM cohorts JOIN (SELECT cohort, customers AS size FROM cohorts WHERE period = 0) USING (cohort) GROUP BY cohort"


def _line_split(spark, folder):
    """Customers split with the same mix of market segments in both parts."""
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return splits.stratified_split(customers, "c_custkey", "c_mktsegment")


def _line_folds(spark, folder):
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return splits.stratified_folds(customers, "c_custkey", "c_mktsegment")


STRATA = """SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment
    ORDER BY md5(c_custkey || '_42'), c_custkey) AS rn, count(*) OVER (PARTITION BY c_mktsegment) AS size FROM customer"""


PLANS = {
    "rfm": Plan(retail(features.rfm), sql("SELECT * REPLACE (round(monetary, 6) AS monetary) FROM rfm", **RFM_CTES)),
    "rfm_scores": Plan(
        retail(features.rfm_scores), sql("SELECT * REPLACE (round(monetary, 6) AS monetary) FROM totals", **SCORE_CTES)
    ),
    "rfm_segments": Plan(
        retail(features.rfm_segments),
        sql("SELECT * REPLACE (round(monetary, 6) AS monetary) FROM segments", **SCORE_CTES, segments=SEGMENTS),
    ),
    "rfm_segments_narrow_first": Plan(
        retail(lambda ds: features.rfm_segments(ds, parity=False)),
        sql("SELECT * REPLACE (round(monetary, 6) AS monetary) FROM segments", **SCORE_CTES, segments=SEGMENTS_NARROW),
    ),
    "segment_shares": Plan(
        retail(lambda ds: features.segment_counts(features.rfm_segments(ds))),
        sql("SELECT segment, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM segments), 6) AS pct "
            "FROM segments GROUP BY segment", **SCORE_CTES, segments=SEGMENTS),
    ),
    "category_affinity": Plan(retail(features.category_affinity), sql(AFFINITY)),
    "category_affinity_wide": Plan(
        retail(features.category_affinity_wide),
        sql("SELECT customer_unique_id, "
            + ", ".join(f"""CAST(coalesce(max(purchase_count) FILTER (WHERE category = 'Brand#{i}'), 0) AS BIGINT) AS "Brand#{i}" """ for i in range(1, 26))
            + " FROM affinity GROUP BY 1", affinity=AFFINITY),
    ),
    "price_sensitivity": Plan(
        lambda spark, folder: rounded(features.price_sensitivity(load_star_schema(spark, folder)), 4, EXACT), sql(PRICES)
    ),
    "temporal_preferences": Plan(
        retail(lambda ds: features.temporal_preferences(features.order_times(ds))),
        sql(preferred_sql(PERSON_TIMES, "customer_unique_id")),
    ),
    "temporal_preferences_events": Plan(_event_times, preferred_sql("SELECT user_id, ts FROM events", "user_id")),
    "customer_features": Plan(
        lambda spark, folder: rounded(features.customer_features(load_star_schema(spark, folder)), 4, EXACT),
        sql(FEATURES, **FEATURE_CTES),
    ),
    "customer_feature_lookup": Plan(
        _seen_customers,
        sql(f"SELECT * FROM ({FEATURES}) "
            "WHERE customer_unique_id IN (SELECT user_id FROM events)", **FEATURE_CTES),
    ),
    "customer_feature_keyed_lookup": Plan(
        _seen_customers_keyed,
        sql(f"SELECT * FROM ({FEATURES}) "
            "WHERE customer_unique_id IN (SELECT user_id FROM events)", **FEATURE_CTES),
    ),
    "customer_lifetime": Plan(
        retail(_lifetime),
        sql("SELECT * REPLACE (round(avg_days_between_orders, 6) AS avg_days_between_orders, CAST(first_purchase AS DATE) "
            "AS first_purchase, CAST(last_purchase AS DATE) AS last_purchase) FROM lifetime",
            affinity=AFFINITY, lifetime=LIFETIME),
    ),
    "retention_cohort": Plan(
        retail(charts.retention_cohort),
        sql("""SELECT cohort, period, customers, cohort_size, round(100.0 * customers / cohort_size, 6) AS retention_pct
            FROM cohorts JOIN (SELECT cohort, customers AS cohort_size FROM cohorts WHERE period = 0) USING (cohort)
            WHERE period < 12""", active=ACTIVE, cohorts=COHORTS),
    ),
    "retention_matrix": Plan(retail(charts.retention_matrix), sql(_matrix_sql(), active=ACTIVE, cohorts=COHORTS)),
    "monthly_orders_trend": Plan(
        retail(charts.monthly_orders_trend),
        sql("""SELECT month, CAST(idx AS INTEGER) AS idx, orders, round(b + a * idx, 6) AS trend, round(a, 6) AS slope,
            CASE WHEN a > 0 THEN 'increasing' ELSE 'decreasing' END AS direction FROM m,
            (SELECT regr_slope(orders, idx) AS a, regr_intercept(orders, idx) AS b FROM m)""",
            m="""SELECT CAST(date_trunc('month', ts) AS DATE) AS month, row_number() OVER (ORDER BY date_trunc('month', ts)) - 1
            AS idx, count(*) AS orders FROM d_orders GROUP BY date_trunc('month', ts)"""),
    ),
    "price_histogram": Plan(
        retail(lambda ds: charts.price_histogram(ds.order_items)),
        sql("""SELECT bin, round(lo + (bin - 1) * ((hi - lo) / 50), 6) AS lo, round(lo + bin * ((hi - lo) / 50), 6) AS hi,
            coalesce(n, 0) AS n FROM (SELECT unnest(range(1, 51)) AS bin, lo, hi FROM span) LEFT JOIN (SELECT
            CAST(least(floor((x - lo) / ((hi - lo) / 50)), 49) + 1 AS BIGINT) AS bin, count(*) AS n FROM
            (SELECT CAST(price AS DOUBLE) AS x FROM d_items), span GROUP BY 1) USING (bin)""",
            span="SELECT CAST(min(price) AS DOUBLE) AS lo, CAST(max(price) AS DOUBLE) AS hi FROM d_items"),
    ),
    "price_median": Plan(
        retail(lambda ds: charts.price_median(ds.order_items)),
        sql("SELECT round(quantile_cont(CAST(price AS DOUBLE), 0.5), 6) AS median FROM d_items"),
    ),
    "box_plot_stats": Plan(
        retail(lambda ds: charts.box_plot_stats(ds.order_items, ["price", "freight_value"])),
        sql(" UNION ALL ".join(
            f"""SELECT '{name}' AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
            round(min(x) FILTER (WHERE x BETWEEN q1 - r AND q3 + r), 6) AS whisker_low,
            round(max(x) FILTER (WHERE x BETWEEN q1 - r AND q3 + r), 6) AS whisker_high,
            count(*) FILTER (WHERE NOT x BETWEEN q1 - r AND q3 + r) AS outliers
            FROM (SELECT CAST({column} AS DOUBLE) AS x FROM d_items), (SELECT *, 1.5 * (q3 - q1) AS r FROM (SELECT
            quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({column} AS DOUBLE), 0.5) AS median,
            quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM d_items)) GROUP BY q1, median, q3"""
            for name, column in (("price", "price"), ("freight_value", "freight")))),
    ),
    "customer_split": Plan(
        retail(charts.customer_split),
        sql("""SELECT CASE WHEN orders > 1 THEN 'Repeat Purchase' ELSE 'Single Purchase' END AS kind, count(*) AS n,
            round(100.0 * count(*) / (SELECT count(*) FROM per_person), 6) AS pct FROM per_person GROUP BY 1""",
            per_person=PER_PERSON),
    ),
    "time_split": Plan(retail(splits.time_split), sql("SELECT order_id, split FROM s", s=TIME_SPLIT)),
    "stratified_split": Plan(
        _line_split,
        f"""SELECT c_custkey, c_mktsegment, CASE WHEN rn <= round(size * 0.2) THEN 'test' ELSE 'train' END AS split
        FROM ({STRATA})""",
    ),
    "stratified_folds": Plan(
        _line_folds, f"SELECT c_custkey, c_mktsegment, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM ({STRATA})"
    ),
}
