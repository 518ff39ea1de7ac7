"""Key lookups that stay balanced when one key holds much of the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.shared_tables import written_table

# A key is hot when it holds at least 1/HOT_KEYS of the rows, so there can
# never be more than HOT_KEYS hot keys, whatever the size of the table.
HOT_KEYS = 20_000


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own bound on broadcast tables, in bytes (-1: none)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    units = {"kb": 1 << 10, "mb": 1 << 20, "gb": 1 << 30, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    lowered = text.lower()
    for suffix, scale in units.items():
        if lowered.endswith(suffix):
            return int(float(lowered[: -len(suffix)]) * scale)
    return int(lowered)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, from file sizes and kept columns."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)


def _present(keys: list[str]) -> Column:
    """All key columns are set."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def hot_keys(facts: DataFrame, keys: list[str], limit: int = HOT_KEYS) -> DataFrame:
    """Keys that hold at least ``1/limit`` of all rows, so at most ``limit`` of
    them, and in how many pieces to cut each so that none is hot."""
    counts = facts.select(*keys).filter(_present(keys)).groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_t")).scalar()
    share = F.col("_n") * limit / total
    return counts.filter(share >= 1).select(*keys, F.ceil(share).alias("_pieces"))


def lookup(facts: DataFrame, dim: DataFrame, key: str | list[str], how: str = "left", hot_limit: int = HOT_KEYS, counted: DataFrame | None = None) -> DataFrame:
    """Join ``facts`` to ``dim``, which has few rows per key, on ``key``.

    A table within the broadcast bound is broadcast.  A larger one is joined
    by shuffle.  Then a single product, order or customer may hold a third of
    all rows: hot keys are cut into pieces by a salt, in proportion to their
    size, and their few dimension rows are repeated for each piece - at most
    ``2 * hot_limit`` pieces in all.  Rows without a key match nothing and
    are spread as well.  The hot keys are found from the key columns alone
    and written, so that lookups after lookups add to the plan, and do not
    multiply it.  ``counted`` is a table that holds the same keys about as
    often as ``facts`` and is cheaper to read: hot keys are found there.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    keys = [key] if isinstance(key, str) else list(key)
    if fits_broadcast(dim):
        return facts.join(F.broadcast(dim), keys, how)

    if how == "inner":
        facts = facts.filter(_present(keys))
    hot = F.broadcast(written_table(hot_keys(facts if counted is None else counted, keys, hot_limit), "hot-keys"))
    # By partition: a task that is run again cuts alike, no column is read
    # for it, and a piece gets no more than partitions at a time.
    spread = F.xxhash64(F.spark_partition_id())
    salt = F.when(_present(keys), F.pmod(spread, F.coalesce("_pieces", F.lit(1)))).otherwise(spread)
    cut = facts.join(hot, keys, "left").withColumn("_salt", salt).drop("_pieces")
    pieces = F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)) - 1)
    repeated = dim.join(hot, keys, "left").withColumn("_salt", F.explode(pieces)).drop("_pieces")
    return cut.join(repeated, [*keys, "_salt"], how).drop("_salt")
