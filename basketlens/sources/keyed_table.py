"""Tables from which the rows of a few keys are read without a scan.

Rows lie in buckets by the hash of their key, a folder each, sorted, with
small row groups and Bloom filters.  A lookup opens the buckets of its keys
and skips the row groups that hold none of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.scalars import quoted

BUCKET = "_bucket"
BUCKETS = 64
ROW_GROUP_BYTES = 1 << 20
#: Keys that are pushed down to the files one by one; more are joined.
PUSHED_KEYS = 1_000


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_keyed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write ``df`` for lookups by ``key``.  A key with many rows spans row
    groups of its bucket; rows without key are kept in a bucket of theirs.
    Choose ``buckets`` so that one is some hundred MB."""
    placed = df.withColumn(BUCKET, F.coalesce(_bucket(quoted(key), buckets), F.lit(-1)))
    sorted_ = placed.repartition(buckets, BUCKET).sortWithinPartitions(BUCKET, quoted(key))
    writer = sorted_.write.mode("overwrite").partitionBy(BUCKET).option("parquet.block.size", row_group_bytes)
    writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.enable.dictionary", "false")
    writer.option("parquet.block.size.row.check.min", "100").option("parquet.page.size.row.check.min", "100").parquet(path)


def read_keyed(spark: SparkSession, path: str, key: str, keys: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows of the given keys (a table with a column ``key``; repeated
    and null ones do no harm).  Unknown keys give no row.

    Up to ``PUSHED_KEYS`` keys become conditions on buckets and row groups,
    so nothing is moved; more meet their buckets in a join."""
    table = spark.read.parquet(path)
    asked = keys.select(quoted(key)).filter(quoted(key).isNotNull()).distinct()
    asked = asked.withColumn(BUCKET, _bucket(quoted(key).cast(table.schema[key].dataType), buckets))
    some = asked.limit(PUSHED_KEYS + 1).collect()
    if len(some) > PUSHED_KEYS:
        return table.join(asked, [BUCKET, key], "left_semi").drop(BUCKET)
    if not some:
        return table.limit(0).drop(BUCKET)
    # As equal-to conditions, which Bloom filters can answer; a list cannot be pushed down when it is long.
    conditions = [quoted(key) == F.lit(r[key]) for r in some]
    while len(conditions) > 1:
        conditions = [reduce(Column.__or__, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
    return table.filter(F.col(BUCKET).isin(sorted({r[BUCKET] for r in some})) & conditions[0]).drop(BUCKET)
