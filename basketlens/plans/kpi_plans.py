"""KPIs and distributions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.operators import facts, kpis
from basketlens.plans.base import Plan, retail, rounded, sql
from basketlens.sources.star_schema import load_star_schema, read_table

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

PER_PERSON = (
    "SELECT person, count(*) AS orders FROM d_orders JOIN d_customers USING (customer_id) GROUP BY person"
)
TABLE_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp"],
    "order_items": ["order_id", "product_id", "price", "freight_value"],
}


def _merged(ds):
    merged = facts.merged_order_facts(ds)
    return merged.select(
        "order_id",
        "product_id",
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
        "product_category_name",
        "customer_id",
        "order_status",
        F.col("order_purchase_timestamp").cast("date").alias("order_date"),
        "customer_unique_id",
        "customer_state",
        "product_category_name_english",
    )


def _reviews(ds):
    return facts.orders_with_reviews(ds).select("order_id", "customer_id", "order_status", "review_score")


def _history(ds):
    ids = ds.customers.select("customer_id")
    return facts.customer_purchase_history(ds, ids).select(
        "customer_id", "order_id", "product_id", F.col("price").cast("double").alias("price"), "product_category_name"
    )


def _weekdays(spark, folder):
    """Seasonality of the event stream, which has hours and uneven days."""
    events = read_table(spark, folder, "events")
    return rounded(kpis.seasonality(load_star_schema(spark, folder), "ts", events))


def _correlations(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    found = kpis.correlations(lines, [*LINE_NUMBERS, "l_linenumber"], top=10)
    return rounded(found, 4)


def _corr_sql() -> str:
    columns = [*LINE_NUMBERS, "l_linenumber"]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_1, '{b}' AS column_2, round(corr({a}, {b}), 4) + 0.0 AS correlation FROM lineitem"
        for a, b in pairs
    )


def _describe(spark, folder):
    return rounded(kpis.describe_numeric(read_table(spark, folder, "lineitem"), LINE_NUMBERS), 4)


def describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        round(CAST(min({c}) AS DOUBLE), 4) AS "min", round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS p50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75,
        round(CAST(max({c}) AS DOUBLE), 4) AS "max" FROM {table}"""
        for c in columns
    )


def missing_sql(tables: dict[str, list[str]], source: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS "rows", count(*) - count({c}) AS missing,
        round(100.0 * (count(*) - count({c})) / count(*), 6) AS missing_pct FROM {source[t]}"""
        for t, columns in tables.items()
        for c in columns
    )


def _missing(ds):
    return kpis.missing_values({"orders": ds.orders, "order_items": ds.order_items})


PLANS = {
    "merged_order_facts": Plan(
        retail(_merged),
        sql("""SELECT order_id, product_id, CAST(price AS DOUBLE) AS price, CAST(freight AS DOUBLE) AS freight_value,
            category AS product_category_name, customer_id, order_status, CAST(ts AS DATE) AS order_date,
            person AS customer_unique_id, customer_state, english AS product_category_name_english
            FROM d_items LEFT JOIN d_products USING (product_id) LEFT JOIN d_orders USING (order_id)
            LEFT JOIN d_customers USING (customer_id) LEFT JOIN d_translation USING (category)"""),
    ),
    "orders_with_reviews": Plan(
        retail(_reviews),
        sql("SELECT order_id, customer_id, order_status, review_score FROM d_orders LEFT JOIN d_reviews USING (order_id)"),
    ),
    "customer_purchase_history": Plan(
        retail(_history),
        sql("""SELECT customer_id, order_id, product_id, CAST(price AS DOUBLE) AS price, category AS product_category_name
            FROM d_items JOIN d_orders USING (order_id) LEFT JOIN d_products USING (product_id)
            WHERE customer_id IN (SELECT customer_id FROM d_customers)"""),
    ),
    "dataset_stats": Plan(
        retail(kpis.dataset_stats),
        sql("""SELECT count(*) AS total_orders, (SELECT count(DISTINCT person) FROM d_customers) AS total_customers,
            (SELECT count(*) FROM d_products) AS total_products,
            (SELECT count(DISTINCT category) FROM d_products) AS total_categories,
            CAST(min(ts) AS DATE) AS first_date, CAST(max(ts) AS DATE) AS last_date FROM d_orders"""),
    ),
    "kpi_summary": Plan(
        retail(kpis.kpi_summary),
        sql("""SELECT (SELECT count(*) FROM d_orders) AS total_orders,
            (SELECT count(DISTINCT person) FROM d_customers) AS total_customers,
            round(CAST(sum(v) AS DOUBLE), 6) AS total_gmv, round(CAST(sum(v) AS DOUBLE) / count(v), 6) AS avg_order_value,
            (SELECT round(100.0 * count(*) FILTER (WHERE order_status = 'F') / count(*), 6) FROM d_orders) AS delivery_rate
            FROM (SELECT order_id, sum(price) AS v FROM d_items GROUP BY order_id)"""),
    ),
    "repeat_purchase": Plan(
        retail(kpis.repeat_purchase),
        sql("""SELECT count(*) AS total_customers, count(*) FILTER (WHERE orders > 1) AS repeat_customers,
            count(*) FILTER (WHERE orders = 1) AS one_time_customers,
            round(100.0 * count(*) FILTER (WHERE orders > 1) / count(*), 6) AS repeat_purchase_rate,
            round(avg(orders), 6) AS avg_orders_per_customer, CAST(max(orders) AS BIGINT) AS max_orders_per_customer
            FROM per_person""", per_person=PER_PERSON),
    ),
    "order_count_distribution": Plan(
        retail(kpis.order_count_distribution),
        sql("""SELECT orders, count(*) AS customers,
            round(100.0 * count(*) / (SELECT count(*) FROM per_person), 6) AS pct,
            (SELECT round(CAST(count(*) FILTER (WHERE orders = 1) AS DOUBLE)
                / nullif(count(*) FILTER (WHERE orders > 1), 0), 6) FROM per_person) AS imbalance_ratio
            FROM per_person GROUP BY orders""", per_person=PER_PERSON),
    ),
    "top_categories": Plan(
        retail(kpis.top_categories),
        sql("""SELECT english AS category, count(DISTINCT order_id) AS total_orders, count(*) AS total_items,
            round(CAST(sum(price) AS DOUBLE), 6) AS total_gmv, round(CAST(sum(price) AS DOUBLE) / count(price), 6) AS avg_price
            FROM d_items LEFT JOIN d_products USING (product_id) LEFT JOIN d_translation USING (category)
            WHERE english IS NOT NULL GROUP BY english ORDER BY sum(price) DESC, english LIMIT 10"""),
    ),
    "category_revenue": Plan(
        retail(kpis.category_revenue),
        sql("""SELECT category, round(CAST(sum(price) AS DOUBLE), 6) AS revenue FROM d_items JOIN d_products USING (product_id)
            WHERE category IS NOT NULL GROUP BY category ORDER BY sum(price) DESC, category LIMIT 15"""),
    ),
    "review_distribution": Plan(
        retail(kpis.review_distribution),
        sql("""SELECT review_score, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM d_reviews), 6) AS pct,
            (SELECT round(avg(review_score), 6) FROM d_reviews) AS avg_score FROM d_reviews GROUP BY review_score"""),
    ),
    "review_sentiment": Plan(
        retail(kpis.review_sentiment),
        sql("""SELECT *, round(100.0 * positive / total, 6) AS positive_pct, round(100.0 * neutral / total, 6) AS neutral_pct,
            round(100.0 * negative / total, 6) AS negative_pct FROM (SELECT count(*) AS total,
            count(*) FILTER (WHERE review_score >= 4) AS positive, count(*) FILTER (WHERE review_score = 3) AS neutral,
            count(*) FILTER (WHERE review_score <= 2) AS negative FROM d_reviews)"""),
    ),
    "avg_days_between_orders": Plan(
        retail(kpis.avg_days_between_orders),
        sql("""SELECT round(avg(gap), 6) AS avg_days, count(gap) AS n_gaps FROM (
            SELECT date_sub('day', lag(ts) OVER (PARTITION BY person ORDER BY ts, order_id), ts) AS gap
            FROM d_orders JOIN d_customers USING (customer_id))"""),
    ),
    "customer_summary": Plan(
        retail(kpis.customer_summary),
        sql("""SELECT total_customers, single_customers, round(100.0 * single_customers / total_customers, 6) AS single_pct,
            repeat_customers, round(100.0 * repeat_customers / total_customers, 6) AS repeat_pct, avg_orders, max_orders
            FROM (SELECT (SELECT count(DISTINCT person) FROM d_customers) AS total_customers,
            count(*) FILTER (WHERE orders = 1) AS single_customers, count(*) FILTER (WHERE orders > 1) AS repeat_customers,
            round(avg(orders), 6) AS avg_orders, CAST(max(orders) AS BIGINT) AS max_orders FROM per_person)""",
            per_person=PER_PERSON),
    ),
    "top_states": Plan(
        retail(kpis.top_states),
        sql("""SELECT customer_state, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM d_customers), 6) AS pct
            FROM d_customers WHERE customer_state IS NOT NULL GROUP BY customer_state ORDER BY n DESC, customer_state LIMIT 5"""),
    ),
    "product_summary": Plan(
        retail(kpis.product_summary),
        sql("""SELECT total_products, total_categories, avg_sales_per_product, total_products - sold AS unsold_products,
            round(100.0 * (total_products - sold) / total_products, 6) AS unsold_pct,
            round(100.0 * largest / total_products, 6) AS top_category_pct FROM (SELECT
            (SELECT count(*) FROM d_products) AS total_products, (SELECT count(DISTINCT category) FROM d_products) AS total_categories,
            (SELECT round(CAST(count(*) AS DOUBLE) / count(DISTINCT product_id), 6) FROM d_items) AS avg_sales_per_product,
            (SELECT count(DISTINCT product_id) FROM d_items WHERE product_id IN (SELECT product_id FROM d_products)) AS sold,
            (SELECT max(n) FROM (SELECT count(*) AS n FROM d_products GROUP BY category)) AS largest)"""),
    ),
    "category_balance": Plan(
        retail(kpis.category_balance),
        sql("""SELECT category, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM d_products), 6) AS pct
            FROM d_products GROUP BY category ORDER BY n DESC, category LIMIT 10"""),
    ),
    "order_status_distribution": Plan(
        retail(kpis.order_status_distribution),
        sql("""SELECT order_status, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM d_orders), 6) AS pct,
            order_status = 'F' AS delivered FROM d_orders GROUP BY order_status"""),
    ),
    "revenue_summary": Plan(
        retail(kpis.revenue_summary),
        sql("""SELECT round(CAST(revenue AS DOUBLE), 6) AS total_revenue, round(CAST(freight AS DOUBLE), 6) AS total_freight,
            round(CAST(revenue + freight AS DOUBLE), 6) AS gmv,
            round(CAST(freight AS DOUBLE) / CAST(revenue + freight AS DOUBLE) * 100, 6) AS freight_pct,
            round(CAST(revenue AS DOUBLE) / orders_with_items, 6) AS aov_orders_with_items,
            round(CAST(revenue AS DOUBLE) / (SELECT count(*) FROM d_orders), 6) AS aov_all_orders,
            round(CAST(revenue AS DOUBLE) / items, 6) AS avg_item_price FROM (SELECT sum(price) AS revenue,
            sum(freight) AS freight, count(price) AS items, count(DISTINCT order_id) AS orders_with_items FROM d_items)"""),
    ),
    "temporal_summary": Plan(
        retail(kpis.temporal_summary),
        sql("""SELECT (SELECT CAST(min(ts) AS DATE) FROM d_orders) AS first_date,
            (SELECT CAST(max(ts) AS DATE) FROM d_orders) AS last_date,
            (SELECT date_sub('day', min(ts), max(ts)) FROM d_orders) AS span_days, count(*) AS months,
            round(avg(orders), 6) AS avg_per_month,
            (SELECT month FROM m ORDER BY orders DESC, month LIMIT 1) AS max_month, max(orders) AS max_orders,
            (SELECT month FROM m ORDER BY orders, month LIMIT 1) AS min_month, min(orders) AS min_orders FROM m""",
            m="SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS orders FROM d_orders GROUP BY 1"),
    ),
    "seasonality": Plan(
        retail(kpis.seasonality),
        sql("""SELECT period, name, orders, CAST(row_number() OVER (PARTITION BY period ORDER BY orders DESC, name) AS INTEGER) AS rank
            FROM (SELECT 'month' AS period, monthname(ts) AS name, count(*) AS orders FROM d_orders GROUP BY 2
            UNION ALL SELECT 'weekday', dayname(ts), count(*) FROM d_orders GROUP BY 2)"""),
    ),
    "seasonality_events": Plan(
        _weekdays,
        """SELECT period, name, orders, CAST(row_number() OVER (PARTITION BY period ORDER BY orders DESC, name) AS INTEGER) AS rank
        FROM (SELECT 'month' AS period, monthname(ts) AS name, count(*) AS orders FROM events GROUP BY 2
        UNION ALL SELECT 'weekday', dayname(ts), count(*) FROM events GROUP BY 2)""",
    ),
    "describe_numeric": Plan(_describe, describe_sql("lineitem", LINE_NUMBERS)),
    "correlations": Plan(_correlations, _corr_sql()),
    "missing_values": Plan(
        retail(_missing),
        sql(missing_sql(TABLE_COLUMNS, {"orders": "m_orders", "order_items": "m_items"}),
            m_orders="SELECT order_id, customer_id, order_status, ts AS order_purchase_timestamp FROM d_orders",
            m_items="SELECT order_id, product_id, price, freight AS freight_value FROM d_items"),
    ),
    "dataset_report": Plan(
        retail(kpis.dataset_report),
        sql("""SELECT (SELECT count(*) FROM d_orders) AS orders_rows, (SELECT count(*) FROM d_items) AS order_items_rows,
            (SELECT count(*) FROM d_products) AS products_rows, (SELECT count(*) FROM d_customers) AS customers_rows,
            (SELECT round(100.0 * count(*) FILTER (WHERE orders > 1) / count(*), 6) FROM per_person) AS repeat_rate,
            total_missing, CASE WHEN total_missing < 1000 THEN 'Good' ELSE 'Needs attention' END AS status FROM (SELECT
            (SELECT 4 * count(*) - count(order_id) - count(customer_id) - count(order_status) - count(ts) FROM d_orders)
            + (SELECT 4 * count(*) - count(order_id) - count(product_id) - count(price) - count(freight) FROM d_items)
            + (SELECT 4 * count(*) - count(product_id) - count(category) - count(product_size) - count(product_retail_price)
               FROM d_products) AS total_missing)""", per_person=PER_PERSON),
    ),
}
