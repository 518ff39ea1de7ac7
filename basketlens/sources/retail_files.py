"""Readers and writers for the retail tables and for results."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from basketlens.dataset import Dataset
from basketlens.functions.scalars import MONEY

log = logging.getLogger(__name__)

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()
_TS = T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SCHEMAS: dict[str, T.StructType] = {
    "orders": _struct(
        order_id=_S, customer_id=_S, order_status=_S, order_purchase_timestamp=_TS, order_approved_at=_TS,
        order_delivered_carrier_date=_TS, order_delivered_customer_date=_TS, order_estimated_delivery_date=_TS,
    ),
    "order_items": _struct(
        order_id=_S, order_item_id=_I, product_id=_S, seller_id=_S, shipping_limit_date=_TS, price=MONEY,
        freight_value=MONEY,
    ),
    "products": _struct(
        product_id=_S, product_category_name=_S, product_name_lenght=_I, product_description_lenght=_I,
        product_photos_qty=_I, product_weight_g=_D, product_length_cm=_D, product_height_cm=_D, product_width_cm=_D,
    ),
    "customers": _struct(
        customer_id=_S, customer_unique_id=_S, customer_zip_code_prefix=_S, customer_city=_S, customer_state=_S
    ),
    "payments": _struct(
        order_id=_S, payment_sequential=_I, payment_type=_S, payment_installments=_I, payment_value=MONEY
    ),
    "reviews": _struct(
        review_id=_S, order_id=_S, review_score=_I, review_comment_title=_S, review_comment_message=_S,
        review_creation_date=_TS, review_answer_timestamp=_TS,
    ),
    "sellers": _struct(seller_id=_S, seller_zip_code_prefix=_S, seller_city=_S, seller_state=_S),
    "category_translation": _struct(product_category_name=_S, product_category_name_english=_S),
}

# The file names of the published data set.
FILES = {
    "orders": "olist_orders_dataset",
    "order_items": "olist_order_items_dataset",
    "products": "olist_products_dataset",
    "customers": "olist_customers_dataset",
    "payments": "olist_order_payments_dataset",
    "reviews": "olist_order_reviews_dataset",
    "sellers": "olist_sellers_dataset",
    "category_translation": "product_category_name_translation",
}


def load_dataset(spark: SparkSession, path: str, fmt: str = "csv") -> Dataset:
    """Read the tables found under ``path``; a table without file is ``None``."""
    tables = {name: _read(spark, f"{path.rstrip('/')}/{stem}.{fmt}", SCHEMAS[name], fmt) for name, stem in FILES.items()}
    return Dataset(**tables)


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame | None:
    reader = spark.read.schema(schema)
    try:
        if fmt == "csv":
            # quoted review texts span lines and double their quotes
            return reader.csv(path, header=True, enforceSchema=False, multiLine="reviews" in path.rsplit("/", 1)[-1], escape='"')
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no table at %s", path)
        return None


def write_result(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a result as parquet or CSV, one file per task."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.csv(path, header=True)
    else:
        writer.format(fmt).save(path)


def save_model(tables: dict[str, DataFrame], path: str) -> None:
    """Save a fitted recommender, which is a set of tables."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_model(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in names}


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
