"""Profiling, quality and cleaning of several whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.scalars import text_columns
from basketlens.functions.shared_tables import new_path
from basketlens.operators import cleaning, profiling, sketches
from basketlens.operators.kpis import describe_numeric
from basketlens.plans.base import Plan, rounded
from basketlens.plans.kpi_plans import describe_sql
from basketlens.sources.star_schema import read_table
from basketlens.sources.versioned_table import VersionedTable

# Tables to profile: SQL, numeric columns, text columns, other columns.
SOURCES = {
    "lineitem": (
        "SELECT * FROM lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        ["l_returnflag", "l_linestatus"],
        ["l_shipdate"],
    ),
    "documents": ("SELECT * FROM documents", ["doc_id", "n_chars"], ["text", "lang", "source"], []),
    "document_texts": ("SELECT text, lang, source FROM documents", [], ["text", "lang", "source"], []),
    "events": ("SELECT * FROM events", ["event_id", "user_id", "value"], ["event_type", "props"], ["ts"]),
    # nulls for orders without items, numbers and dates as text, a constant
    "order_sums": (
        """SELECT o_orderstatus AS status, CAST(o_orderkey AS VARCHAR) AS order_code, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
        AS date_text, CAST(1 AS INTEGER) AS version, items, amount FROM orders LEFT JOIN (SELECT l_orderkey AS o_orderkey,
        count(*) AS items, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM lineitem GROUP BY 1)
        USING (o_orderkey)""",
        ["version", "items", "amount"],
        ["status", "order_code", "date_text"],
        [],
    ),
}
NUMBER = profiling.NUMBER_PATTERN.replace("'", "''")


def source(spark, folder: str, name: str) -> DataFrame:
    if name == "document_texts":
        return read_table(spark, folder, "documents").select("text", "lang", "source")
    if name == "order_sums":
        sums = read_table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.count("*").alias("items"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amount")
        )
        return read_table(spark, folder, "orders").join(sums, "o_orderkey", "left").select(
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderkey").cast("string").alias("order_code"),
            F.col("o_orderdate").cast("date").cast("string").alias("date_text"),
            F.lit(1).alias("version"),
            "items",
            "amount",
        )
    return read_table(spark, folder, name)


def on_tables(operator, names=tuple(SOURCES), digits: int = 4):
    """One result for several tables, with the table's name."""

    def run(spark, folder):
        parts = [operator(source(spark, folder, n)).select(F.lit(n).alias("table"), "*") for n in names]
        return rounded(reduce(DataFrame.unionByName, parts), digits)

    return run


def on_table(operator, name: str, digits: int = 4):
    return lambda spark, folder: rounded(operator(source(spark, folder, name)), digits)


def each(make, names=tuple(SOURCES)) -> str:
    """SQL over several tables; ``make(name, sql, numbers, texts, others)``."""
    return " UNION ALL ".join(make(n, *SOURCES[n]) for n in names)


def _types(name: str) -> dict[str, str]:
    """Spark's names of the column types."""
    kinds = {
        "lineitem": ["bigint"] * 3 + ["int"] + ["double"] * 4 + ["string"] * 2 + ["timestamp_ntz"],
        "documents": ["bigint", "string", "string", "string", "bigint"],
        "document_texts": ["string"] * 3,
        "events": ["bigint", "timestamp_ntz", "bigint", "string", "double", "string"],
        "order_sums": ["string", "string", "string", "int", "bigint", "double"],
    }[name]
    columns = {
        "lineitem": SOURCES["lineitem"][1] + SOURCES["lineitem"][2] + ["l_shipdate"],
        "documents": ["doc_id", "text", "lang", "source", "n_chars"],
        "document_texts": ["text", "lang", "source"],
        "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
        "order_sums": ["status", "order_code", "date_text", "version", "items", "amount"],
    }[name]
    return dict(zip(columns, kinds))


def _profile_sql(name, text, numbers, texts, others) -> str:
    types = _types(name)
    parts = []
    for c, kind in types.items():
        number, is_text = c in numbers, c in texts
        listed = (
            f"""(SELECT CASE WHEN count(*) <= 10 THEN coalesce(string_agg(v, '|' ORDER BY v), '') END FROM
            (SELECT DISTINCT {c} AS v FROM ({text}) WHERE {c} IS NOT NULL))"""
            if is_text
            else "CAST(NULL AS VARCHAR)"
        )
        parts.append(
            f"""SELECT '{name}' AS "table", '{c}' AS "column", '{kind}' AS type, {list(types.values()).count(kind)} AS columns_of_type,
            count(*) AS "rows", count({c}) AS non_null, count(*) - count({c}) AS missing,
            round(100.0 * (count(*) - count({c})) / count(*), 4) AS missing_pct,
            {f'count(DISTINCT {c})' if is_text else 'CAST(NULL AS BIGINT)'} AS n_distinct, {listed} AS listed_values,
            {f'round(CAST(min({c}) AS DOUBLE), 4)' if number else 'CAST(NULL AS DOUBLE)'} AS min_value,
            {f'round(CAST(max({c}) AS DOUBLE), 4)' if number else 'CAST(NULL AS DOUBLE)'} AS max_value,
            {f'round(avg({c}), 4)' if number else 'CAST(NULL AS DOUBLE)'} AS mean_value FROM ({text})"""
        )
    return " UNION ALL ".join(parts)


def _approx_profile(df):
    """The profile by sketches, and whether its distinct counts are close."""
    exact = profiling.distinct_counts(df, text_columns(df)).withColumnRenamed("n_distinct", "_exact")
    close = F.abs(F.col("n_distinct") - F.col("_exact")) <= sketches.ERROR_BOUND * F.col("_exact")
    found = profiling.profile_columns(df, approx=True).join(exact, "column", "left")
    return found.withColumn("close", F.coalesce(close, F.lit(True))).drop("n_distinct", "_exact")


def _outlier_sql(name, text, numbers, texts, others) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", '{c}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(lo, 4) AS lower,
        round(hi, 4) AS upper, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers,
        round(100.0 * count(*) FILTER (WHERE {c} < lo OR {c} > hi) / count(*), 4) AS outlier_pct,
        round(CAST(min({c}) FILTER (WHERE {c} < lo OR {c} > hi) AS DOUBLE), 4) AS min_outlier,
        round(CAST(max({c}) FILTER (WHERE {c} < lo OR {c} > hi) AS DOUBLE), 4) AS max_outlier
        FROM ({text}), (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT
        quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM ({text})))
        GROUP BY q1, q3, lo, hi"""
        for c in numbers
    )


NUMERIC_SOURCES = tuple(n for n in SOURCES if SOURCES[n][1])


def _categorical_sql(name, text, numbers, texts, others) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", '{c}' AS "column", n_distinct, CAST(rank AS INTEGER) AS rank, value, n,
        round(100.0 * n / (SELECT count(*) FROM ({text})), 4) AS pct FROM (SELECT count(DISTINCT {c}) AS n_distinct FROM ({text}))
        LEFT JOIN (SELECT {c} AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rank FROM ({text})
        WHERE {c} IS NOT NULL GROUP BY {c}) ON n_distinct <= 20 AND rank <= 10"""
        for c in texts
    )


def _duplicates(df):
    return profiling.duplicate_rows(df)


def _duplicate_sql(name, text, numbers, texts, others) -> str:
    return f"""SELECT '{name}' AS "table", n AS "rows", n - d AS duplicates, round(100.0 * (n - d) / n, 4) AS duplicate_pct FROM
        (SELECT (SELECT count(*) FROM ({text})) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM ({text}))) AS d)"""


def _severity(pct: str, high: int, medium: int) -> str:
    return f"CASE WHEN {pct} > {high} THEN 'HIGH' WHEN {pct} > {medium} THEN 'MEDIUM' ELSE 'LOW' END"


def _raw_issue_sql(name, text, numbers, texts, others) -> str:
    columns = [*numbers, *texts, *others]
    missing = " + ".join(f"count(*) - count({c})" for c in columns)
    parts = [
        f"""SELECT 'Missing Values' AS issue, CAST(NULL AS VARCHAR) AS column_name, {_severity('pct', 20, 5)} AS severity,
        pct AS detail_value, -least(pct, 30) AS impact FROM (SELECT 100.0 * ({missing}) / (count(*) * {len(columns)}) AS pct
        FROM ({text})) WHERE pct > 0""",
        f"""SELECT 'Duplicate Rows', NULL, {_severity('pct', 10, 1)}, pct, -least(2 * pct, 20) FROM (SELECT 100.0 * ((SELECT count(*)
        FROM ({text})) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({text})))) / (SELECT count(*) FROM ({text})) AS pct)
        WHERE pct > 0""",
    ]
    for c in texts:
        parts.append(
            f"""SELECT 'Incorrect Data Type', '{c}', 'MEDIUM', NULL, -5 FROM (SELECT bool_and({c} IS NULL OR
            regexp_matches({c}, '{NUMBER}')) AS yes FROM ({text})) WHERE yes"""
        )
        if "date" in c or "time" in c:
            parts.append(
                f"""SELECT 'Incorrect Data Type', '{c}', 'MEDIUM', NULL, -5 FROM (SELECT bool_and({c} IS NULL OR
                TRY_CAST({c} AS TIMESTAMP) IS NOT NULL) AS yes FROM ({text})) WHERE yes"""
            )
        parts.append(
            f"""SELECT 'High Cardinality', '{c}', 'LOW', 100.0 * d / n, -5 FROM (SELECT count(DISTINCT {c}) AS d, count(*) AS n
            FROM ({text})) WHERE d > 0.5 * n AND d > 100"""
        )
    if numbers:
        parts.append(
            f"""SELECT 'Outliers Detected', NULL, {_severity('pct', 5, 1)}, pct, -least(2 * pct, 15) FROM (SELECT 100.0 * sum(outliers)
            / ((SELECT count(*) FROM ({text})) * {len(columns)}) AS pct FROM ({_outlier_sql(name, text, numbers, texts, others)}))
            WHERE pct > 0"""
        )
    for c in numbers:
        parts.append(
            f"""SELECT 'Zero Variance', '{c}', 'MEDIUM', v, -10 FROM (SELECT CAST(min({c}) AS DOUBLE) AS v, count(DISTINCT {c}) AS d
            FROM ({text})) WHERE d = 1"""
        )
    return " UNION ALL ".join(parts)


def _issues_sql(name, *about) -> str:
    return f"""SELECT '{name}' AS "table", issue, column_name, severity, round(CAST(detail_value AS DOUBLE), 4) AS detail_value,
        round(CAST(impact AS DOUBLE), 4) AS impact FROM ({_raw_issue_sql(name, *about)})"""


def _score_sql(name, *about) -> str:
    return f"""SELECT '{name}' AS "table", round(score, 4) AS score, CASE WHEN score >= 90 THEN 'EXCELLENT' WHEN score >= 75 THEN 'GOOD'
        WHEN score >= 60 THEN 'FAIR' WHEN score >= 40 THEN 'POOR' ELSE 'CRITICAL' END AS rating, n_issues FROM (SELECT
        greatest(0.0, 100 + coalesce(sum(CAST(impact AS DOUBLE)), 0)) AS score, count(*) AS n_issues FROM ({_raw_issue_sql(name, *about)}))"""


def _plan_sql(name, text, numbers, texts, others) -> str:
    parts = []
    for c in [*numbers, *texts, *others]:
        fill = "impute: Unknown" if c in texts else "impute: median"
        parts.append(
            f"""SELECT '{c}' AS column_name, 'missing values' AS problem, CASE WHEN m > 0.5 * n THEN 'drop_sparse_columns'
            ELSE '{fill}' END AS action FROM (SELECT count(*) AS n, count(*) - count({c}) AS m FROM ({text})) WHERE m > 0"""
        )
        if "date" in c or "time" in c:
            parts.append(f"SELECT '{c}', 'date parts', 'date_features'")
    for c in texts:
        if "date" in c or "time" in c:
            parts.append(f"SELECT '{c}', 'text holds dates', 'cast_datetimes'")
        parts.append(
            f"""SELECT '{c}', 'few distinct values', 'label_encode: category' FROM (SELECT count(DISTINCT {c}) AS d, count(*) AS n
            FROM ({text})) WHERE d < 0.05 * n"""
        )
        parts.append(
            f"""SELECT '{c}', 'categorical encoding', CASE WHEN count(DISTINCT {c}) <= 10 THEN 'one_hot' ELSE 'label_encode' END
            FROM ({text})"""
        )
    for c in numbers:
        parts.append(f"SELECT '{c}', 'scaling', 'standard_scale or minmax_scale'")
    if numbers:
        parts.append(
            f"""SELECT "column", 'outliers', 'winsorize or remove_outliers' FROM ({_outlier_sql(name, text, numbers, texts, others)})
            WHERE outliers > 0"""
        )
    parts.append(
        f"""SELECT NULL, 'duplicate rows', 'dedupe' FROM (SELECT (SELECT count(*) FROM ({text})) AS n, (SELECT count(*) FROM
        (SELECT DISTINCT * FROM ({text}))) AS d) WHERE n > d"""
    )
    return f"""SELECT '{name}' AS "table", column_name, problem, action FROM ({' UNION ALL '.join(parts)})"""


ORDER_SUMS = SOURCES["order_sums"][0]
LINE_VALUES = ["l_quantity", "l_extendedprice", "l_tax"]


def _bounds(c: str, table: str) -> str:
    return f"""(SELECT q1 - 1.5 * (q3 - q1) AS lo_{c}, q3 + 1.5 * (q3 - q1) AS hi_{c} FROM (SELECT
        quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {table}))"""


def _scale(operator):
    def run(df):
        keys = ["l_orderkey", "l_linenumber", "l_partkey"]
        return operator(df.select(*keys, *LINE_VALUES), LINE_VALUES)

    return run


def _dates(df):
    typed = cleaning.cast_datetimes(df.select("order_code", "date_text"), ["date_text"])
    return cleaning.date_features(typed, "date_text").drop("date_text")


def _versions(spark, folder):
    """Orders written in three steps: all but one status, that one with wrong
    totals, and its partition again."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    table = VersionedTable(spark, new_path(spark, "versions"))
    table.overwrite(orders.filter("o_orderstatus <> 'F'"), ["o_orderstatus"])
    open_ = orders.filter("o_orderstatus = 'F'")
    table.append(open_.withColumn("o_totalprice", -F.col("o_totalprice")))
    table.replace_partitions(open_)
    return rounded(table.read())


PLANS = {
    "versioned_table": Plan(_versions, "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders"),
    "profile_columns": Plan(on_tables(profiling.profile_columns), each(_profile_sql)),
    "profile_columns_approx": Plan(
        on_tables(_approx_profile), f"SELECT * EXCLUDE (n_distinct), true AS close FROM ({each(_profile_sql)})"
    ),
    "table_shape": Plan(
        on_tables(profiling.table_shape),
        each(lambda n, text, *kinds: f"""SELECT '{n}' AS "table", count(*) AS "rows", {sum(map(len, kinds))} AS "columns" FROM ({text})"""),
    ),
    "sample_rows": Plan(
        on_table(lambda df: profiling.sample_rows(df, ["event_id"]).drop("ts"), "events"),
        """SELECT event_id, user_id, event_type, round("value", 4) AS "value", props FROM events ORDER BY event_id LIMIT 3""",
    ),
    "numeric_summary": Plan(
        on_table(lambda df: describe_numeric(df, ["event_id", "user_id", "value"]), "events"),
        describe_sql("events", ["event_id", "user_id", "value"]).replace(" value)", ' "value")').replace("(value", '("value"'),
    ),
    "iqr_outliers": Plan(on_tables(profiling.iqr_outliers, NUMERIC_SOURCES), each(_outlier_sql, NUMERIC_SOURCES)),
    "categorical_summary": Plan(on_tables(profiling.categorical_summary), each(_categorical_sql)),
    "duplicate_rows": Plan(on_tables(profiling.duplicate_rows), each(_duplicate_sql)),
    "quality_issues": Plan(on_tables(profiling.quality_issues), each(_issues_sql)),
    "quality_score": Plan(on_tables(profiling.quality_score), each(_score_sql)),
    "improvement_plan": Plan(on_tables(profiling.improvement_plan), each(_plan_sql)),
    "impute": Plan(
        on_table(cleaning.impute, "order_sums"),
        f"""SELECT status, order_code, date_text, 1.0::DOUBLE AS version, round(coalesce(items, mi), 4) AS items,
        round(coalesce(amount, ma), 4) AS amount FROM ({ORDER_SUMS}), (SELECT quantile_cont(CAST(items AS DOUBLE), 0.5) AS mi,
        quantile_cont(amount, 0.5) AS ma FROM ({ORDER_SUMS}))""",
    ),
    "drop_sparse_columns": Plan(
        on_table(lambda df: cleaning.drop_sparse_columns(df.withColumn("rare", F.when(F.col("items") > 9, F.col("items")))), "order_sums"),
        f"SELECT status, order_code, date_text, version, items, round(amount, 4) AS amount FROM ({ORDER_SUMS})",
    ),
    "winsorize": Plan(
        on_table(lambda df: cleaning.winsorize(df.select("order_code", "items", "amount"), ["items", "amount"]), "order_sums"),
        f"""SELECT order_code, CASE WHEN items IS NOT NULL THEN round(least(greatest(items, lo_items), hi_items), 4) END AS items,
        CASE WHEN amount IS NOT NULL THEN round(least(greatest(amount, lo_amount), hi_amount), 4) END AS amount
        FROM ({ORDER_SUMS}), {_bounds('items', f'({ORDER_SUMS})')}, {_bounds('amount', f'({ORDER_SUMS})')}""",
    ),
    "remove_outliers": Plan(
        on_table(lambda df: cleaning.remove_outliers(df.select("order_code", "items", "amount"), ["items", "amount"]), "order_sums"),
        f"""SELECT order_code, items, round(amount, 4) AS amount FROM ({ORDER_SUMS}), {_bounds('items', f'({ORDER_SUMS})')},
        {_bounds('amount', f'({ORDER_SUMS})')} WHERE items BETWEEN lo_items AND hi_items AND amount BETWEEN lo_amount AND hi_amount""",
    ),
    "date_features": Plan(
        on_table(_dates, "order_sums"),
        f"""SELECT order_code, CAST(year(d) AS INTEGER) AS date_text_year, CAST(month(d) AS INTEGER) AS date_text_month,
        CAST(day(d) AS INTEGER) AS date_text_day, CAST(hour(d) AS INTEGER) AS date_text_hour,
        CAST(isodow(d) - 1 AS INTEGER) AS date_text_day_of_week, isodow(d) >= 6 AS date_text_is_weekend
        FROM (SELECT order_code, CAST(date_text AS TIMESTAMP) AS d FROM ({ORDER_SUMS}))""",
    ),
    "cast_datetimes": Plan(
        on_table(lambda df: cleaning.cast_datetimes(df, ["date_text"]).select("order_code", F.col("date_text").cast("date").alias("day")), "order_sums"),
        f"SELECT order_code, CAST(date_text AS DATE) AS day FROM ({ORDER_SUMS})",
    ),
    "one_hot": Plan(
        on_table(lambda df: cleaning.one_hot(df.select("event_id", "event_type"), "event_type"), "events"),
        "SELECT event_id, event_type, "
        + ", ".join(f"CAST(event_type = '{v}' AS INTEGER) AS event_type_{v}" for v in ("click", "error", "purchase", "signup", "view"))
        + " FROM events",
    ),
    "label_encode": Plan(
        on_table(lambda df: cleaning.label_encode(df.select("event_id", "props"), "props"), "events"),
        "SELECT event_id, props, dense_rank() OVER (ORDER BY props) - 1 AS props_encoded FROM events",
    ),
    "standard_scale": Plan(
        on_table(_scale(cleaning.standard_scale), "lineitem"),
        "SELECT l_orderkey, l_linenumber, l_partkey, "
        + ", ".join(f"round(({c} - m_{c}) / s_{c}, 4) + 0.0 AS {c}" for c in LINE_VALUES)
        + " FROM lineitem, (SELECT "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in LINE_VALUES)
        + " FROM lineitem)",
    ),
    "minmax_scale": Plan(
        on_table(_scale(cleaning.minmax_scale), "lineitem"),
        "SELECT l_orderkey, l_linenumber, l_partkey, "
        + ", ".join(f"round(({c} - a_{c}) / (b_{c} - a_{c}), 4) AS {c}" for c in LINE_VALUES)
        + " FROM lineitem, (SELECT "
        + ", ".join(f"min({c}) AS a_{c}, max({c}) AS b_{c}" for c in LINE_VALUES)
        + " FROM lineitem)",
    ),
    "dedupe": Plan(on_table(cleaning.dedupe, "document_texts"), "SELECT DISTINCT text, lang, source FROM documents"),
}
