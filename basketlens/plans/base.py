"""A registered query: the Spark job and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.dataset import Dataset
from basketlens.sources.star_schema import load_star_schema

# The retail tables in SQL over the test tables.
TABLES = {
    "d_orders": "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status, "
    "o_orderdate AS ts FROM orders",
    "d_items": "SELECT l_orderkey AS order_id, l_partkey AS product_id, "
    "CAST(l_extendedprice AS DECIMAL(18,2)) AS price, "
    "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS freight "
    "FROM lineitem",
    "d_products": "SELECT p_partkey AS product_id, p_brand AS category, CAST(p_size AS DOUBLE) AS product_size, "
    "p_retailprice AS product_retail_price FROM part",
    "d_customers": "SELECT c_custkey AS customer_id, c_custkey AS person, n_name AS customer_state, "
    "c_mktsegment AS customer_city FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "d_reviews": "SELECT o_orderkey AS order_id, CAST(1 + o_orderkey % 5 AS INTEGER) AS review_score FROM orders",
    "d_translation": "SELECT DISTINCT p_brand AS category, replace(p_brand, 'Brand#', 'Category ') AS english FROM part",
}


@dataclass(frozen=True)
class Plan:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def retail(operator: Callable[[Dataset], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Run an operator on the retail view of the test tables."""
    return lambda spark, folder: rounded(operator(load_star_schema(spark, folder)))


def rounded(df: DataFrame, digits: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round doubles for a comparison between engines; -0.0 becomes 0.0.
    Columns to ``keep`` are the same in both to the last bit."""
    return df.select(
        *[
            (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in keep
            else f.name
            for f in df.schema.fields
        ]
    )


def sql(body: str, **ctes: str) -> str:
    """A query over the retail tables it names, ``ctes`` in order."""
    text = " ".join([*ctes.values(), body])
    used = {name: select for name, select in TABLES.items() if name in text}
    parts = [f"{name} AS ({select})" for name, select in {**used, **ctes}.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
