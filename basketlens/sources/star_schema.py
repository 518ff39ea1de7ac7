"""The retail data set on top of a customer/orders/lineitem/part schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.dataset import Dataset
from basketlens.functions.scalars import MONEY


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_star_schema(spark: SparkSession, folder: str) -> Dataset:
    def table(name: str) -> DataFrame:
        return read_table(spark, folder, name)

    orders = table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )
    items = table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.round(F.col("l_extendedprice").cast(MONEY) * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY).alias("freight_value"),
    )
    products = table("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("product_category_name"),
        F.col("p_size").cast("double").alias("product_size"),
        F.col("p_retailprice").alias("product_retail_price"),
    )
    # a map of the 25 nation names: customers stay one scan of one table
    names = F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_name")))
    customers = table("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_custkey").alias("customer_unique_id"),
        F.try_element_at(table("nation").agg(names).scalar(), F.col("c_nationkey")).alias("customer_state"),
        F.col("c_mktsegment").alias("customer_city"),
    )
    reviews = table("orders").select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_orderkey") % 5 + 1).cast("int").alias("review_score")
    )
    sellers = table("supplier").select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_city"))
    translation = (
        table("part")
        .select(F.col("p_brand").alias("product_category_name"))
        .distinct()
        .withColumn("product_category_name_english", F.replace("product_category_name", F.lit("Brand#"), F.lit("Category ")))
    )
    return Dataset(
        orders=orders,
        order_items=items,
        products=products,
        customers=customers,
        reviews=reviews,
        sellers=sellers,
        category_translation=translation,
        delivered_status="F",
    )
