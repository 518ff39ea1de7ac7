"""Profiles from mergeable sketches: one scan a batch of rows, none again.

A sketch has a row per column: counts, sum, range, a distinct-count sketch
and a sketch of the most frequent values.  Sketches of parts of a table add
up to the sketch of the table, so new files are profiled alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.scalars import numeric_columns, percent, quoted, ratio, text_columns, without_nan
from basketlens.operators.profiling import LISTED_VALUES

#: 2 ** LOG_BUCKETS registers for distinct values: a standard error of 0.8 %.
LOG_BUCKETS = 14
#: Estimates stay within this share of the truth but for one in some hundred.
ERROR_BOUND = 0.025
#: Values counted exactly, while no column has more; sketches hold these only.
TRACKED = 64
#: Longer values are counted as distinct but never listed.
LISTED_LENGTH = 1_000

FIGURES = ["position", "column", "type", "rows", "non_null", "n_numbers", "total", "low", "high", "longest"]


def profile_sketch(df: DataFrame) -> DataFrame:
    """The sketch of a table, in one aggregate over one scan.  NaN counts as
    missing; columns that are neither text nor numbers have counts only."""
    df = without_nan(df)
    texts, numbers = set(text_columns(df)), set(numeric_columns(df))

    def cell(position: int, name: str, kind: str) -> Column:
        value = quoted(name)
        number = value.cast("double") if name in numbers else F.lit(None).cast("double")
        text = value.cast("string") if name in texts else F.lit(None).cast("string")
        short = F.when(F.length(text) <= LISTED_LENGTH, text)
        frequent = F.call_function("approx_top_k_accumulate", short, F.lit(TRACKED))
        figures = {
            "position": F.lit(position),
            "column": F.lit(name),
            "type": F.lit(kind),
            "rows": F.count(F.lit(1)),
            "non_null": F.count(value),
            "n_numbers": F.count(number),
            "total": F.sum(number),
            "low": F.min(number),
            "high": F.max(number),
            "longest": F.max(F.length(text)),
            "distinct": F.hll_sketch_agg(text, F.lit(LOG_BUCKETS)),
            "frequent": frequent,
        }
        return F.struct(*[c.alias(n) for n, c in figures.items()])

    cells = [cell(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """The sketch of all rows behind the given sketches, a row per column
    (and type: a column that changes its type has two)."""
    return sketches.groupBy("position", "column", "type").agg(
        *[F.sum(c).alias(c) for c in ("rows", "non_null", "n_numbers", "total")],
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.max("longest").alias("longest"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(TRACKED)).alias("frequent"),
    ).select(*FIGURES, "distinct", "frequent")


def profile_of(sketch: DataFrame) -> DataFrame:
    """The columns of ``profile_columns`` from a sketch, with an estimate as
    ``n_distinct``.  Values are listed if at most ``LISTED_VALUES`` are
    found, none of them longer than ``LISTED_LENGTH``."""
    is_text = F.col("type").rlike("^(string|char|varchar)")
    missing = F.col("rows") - F.col("non_null")
    estimate = F.when(is_text, F.least(F.hll_sketch_estimate("distinct"), F.col("non_null")))
    top = F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(LISTED_VALUES + 1))
    values = F.array_sort(F.transform(top, lambda x: x["item"]))
    few = is_text & (F.size(top).between(1, LISTED_VALUES)) & (F.col("longest") <= LISTED_LENGTH) & (estimate <= LISTED_VALUES)
    kinds = sketch.groupBy("type").agg(F.count("*").alias("columns_of_type"))  # a row per type
    return sketch.join(F.broadcast(kinds), "type").select(
        "column",
        "type",
        F.col("columns_of_type").cast("int").alias("columns_of_type"),
        "rows",
        "non_null",
        missing.alias("missing"),
        F.coalesce(percent(missing, F.col("rows")), F.lit(0.0)).alias("missing_pct"),
        estimate.alias("n_distinct"),
        F.when(few, F.array_join(values, "|")).alias("listed_values"),
        F.col("low").alias("min_value"),
        F.col("high").alias("max_value"),
        ratio(F.col("total"), F.col("n_numbers")).alias("mean_value"),
    )


def add_to_profile(df: DataFrame, path: str, batch: str) -> None:
    """Scan a batch of rows once and keep its sketch in the table at
    ``path``.  A batch that comes again replaces its earlier sketch."""
    kept = profile_sketch(df).withColumn("batch", F.lit(batch))
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def kept_profile(spark: SparkSession, path: str) -> DataFrame:
    """The profile of all batches kept at ``path``; no batch is read again."""
    return profile_of(merged_sketches(spark.read.parquet(path)))
