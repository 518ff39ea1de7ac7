"""Splits of rows into parts: by time, and stratified by class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.dataset import Dataset
from basketlens.functions.ordering import global_rank, rank_in_group
from basketlens.functions.scalars import total_of


def time_split(ds: Dataset, test_size: float = 0.2) -> DataFrame:
    """(order_id, split): the most recent share of orders is "test"."""
    orders = ds.orders.select("order_id", "order_purchase_timestamp")
    ranked = global_rank(orders, [F.asc_nulls_last("order_purchase_timestamp"), F.asc("order_id")])
    cut = F.floor(total_of(ranked, F.count("*")) * (1 - test_size))
    return ranked.select("order_id", F.when(F.col("rank") <= cut, "train").otherwise("test").alias("split"))


def train_and_test(ds: Dataset, test_size: float = 0.2) -> tuple[Dataset, DataFrame]:
    """The data set as known at the cut, and the orders after it.  Items are
    cut along with the orders, so nothing of the future leaks back."""
    split = time_split(ds, test_size)
    train = split.filter(F.col("split") == "train").select("order_id")
    test = split.filter(F.col("split") == "test").select("order_id")
    known = ds.with_tables(
        orders=ds.orders.join(train, "order_id", "left_semi"),
        order_items=ds.order_items.join(train, "order_id", "left_semi"),
    )
    return known, ds.orders.join(test, "order_id", "left_semi")


def seeded_order(key: str, seed: int) -> Column:
    """A reproducible random order of keys, the same on every cluster."""
    return F.md5(F.concat_ws("_", F.col(key).cast("string"), F.lit(str(seed))))


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add "train" or "test" with the same class mix in both; exact, and the
    same for the same seed."""
    shuffled = df.withColumn("_order", seeded_order(key, seed))
    ranked = rank_in_group(shuffled, label, [F.col("_order"), F.col(key)], "_rank")
    sizes = ranked.groupBy(label).agg(F.count("*").alias("_size"))
    sized = ranked.join(F.broadcast(sizes), label)
    return sized.withColumn(
        "split", F.when(F.col("_rank") <= F.round(F.col("_size") * test_size), "test").otherwise("train")
    ).drop("_order", "_rank", "_size")


def stratified_folds(df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Add a fold number 0..folds-1 with the same class mix in each fold."""
    shuffled = df.withColumn("_order", seeded_order(key, seed))
    ranked = rank_in_group(shuffled, label, [F.col("_order"), F.col(key)], "_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_order", "_rank")
