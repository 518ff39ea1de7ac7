"""Joins of the retail tables that other operators start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.dataset import Dataset
from basketlens.functions.joins import lookup


def person_of_customer(ds: Dataset) -> DataFrame:
    return ds.customers.select("customer_id", "customer_unique_id")


def category_of_product(ds: Dataset, translated: bool = False) -> DataFrame:
    """(product_id, category), the category in English where asked and known."""
    products = ds.products.select("product_id", "product_category_name")
    if translated and ds.category_translation is not None:
        names = ds.category_translation.select("product_category_name", "product_category_name_english")
        return lookup(products, names, "product_category_name").select(
            "product_id", F.col("product_category_name_english").alias("category")
        )
    return products.withColumnRenamed("product_category_name", "category")


def order_values(ds: Dataset) -> DataFrame:
    """(order_id, order_value): the item prices of each order."""
    return ds.order_items.groupBy("order_id").agg(F.sum("price").alias("order_value"))


def orders_with_person(ds: Dataset) -> DataFrame:
    return lookup(ds.orders, person_of_customer(ds), "customer_id")


def items_with_person(ds: Dataset) -> DataFrame:
    """Item rows with the person who ordered; rows without a person dropped.
    Persons meet orders first, which are fewer, so items move once."""
    known = person_of_customer(ds).filter(F.col("customer_unique_id").isNotNull())
    who = lookup(ds.orders.select("order_id", "customer_id"), known, "customer_id", "inner")
    items = lookup(ds.order_items, who, "order_id", "inner")
    others = [c for c in ds.order_items.columns if c != "order_id"]
    return items.select("customer_id", "order_id", *others, "customer_unique_id")


def purchases(ds: Dataset) -> DataFrame:
    """(customer_unique_id, product_id, n): item rows per person and product."""
    return items_with_person(ds).groupBy("customer_unique_id", "product_id").agg(F.count("*").alias("n"))


def merged_order_facts(ds: Dataset) -> DataFrame:
    """Items with product, order, customer and translated category columns."""
    ds.require("orders", "order_items", "products", "customers")
    merged = lookup(ds.order_items, ds.products, "product_id")
    merged = lookup(merged, ds.orders, "order_id")
    merged = lookup(merged, ds.customers, "customer_id")
    if ds.category_translation is not None:
        merged = lookup(merged, ds.category_translation, "product_category_name")
    return merged


def orders_with_reviews(ds: Dataset) -> DataFrame:
    """Orders with their review scores: one row per review of an order."""
    ds.require("orders", "reviews")
    return ds.orders.join(ds.reviews.select("order_id", "review_score"), "order_id", "left")


def customer_purchase_history(ds: Dataset, customers: DataFrame) -> DataFrame:
    """Items with category of every customer id in ``customers``."""
    wanted = customers.select("customer_id").distinct()
    orders = lookup(ds.orders.select("order_id", "customer_id"), wanted, "customer_id", "inner")
    items = lookup(ds.order_items, orders, "order_id", "inner")
    return lookup(items, ds.products.select("product_id", "product_category_name"), "product_id")
