"""Ranks, running totals and exact quantiles over whole tables, without a
task that sees the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.functions.joins import estimated_bytes
from basketlens.functions.scalars import quoted
from basketlens.functions.shared_tables import written_table

_POSITION_MASK = (1 << 33) - 1  # low bits of monotonically_increasing_id
BUCKETS = 4096
PASS_BYTES = (1 << 20, 256 << 20)  # sizes from which a narrowing pass pays


def _range_sorted(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``df`` range-partitioned and sorted, written once, with the partition
    number and the position in it."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written_table(
        cut.withColumn("_part", F.spark_partition_id()).withColumn(
            "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK))
        ),
        label,
    )


def _offsets(per_part: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Totals of the partitions before each one; one row per partition."""
    before = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return per_part.select("_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in columns])


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position of each row in ``order`` (must be total)."""
    table = _range_sorted(df, order, "rank")
    offsets = _offsets(table.groupBy("_part").agg(F.count("*").alias("_n")), ["_n"])
    return (
        table.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_n_before") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_n_before")
    )


def rank_in_group(df: DataFrame, group: str, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based position within ``group``; a group may span many tasks.

    Each partition and group has a row that says where the group starts
    there and how much of it came before, so rows meet it by partition and
    group, never by group alone.
    """
    table = _range_sorted(df, [F.col(group), *order], "rank")
    parts = table.groupBy("_part", F.col(group).alias("_group")).agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
    # at most one row per partition
    before = W.partitionBy("_group").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select(F.col("_part").alias("_of"), "_group", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (
        table.join(starts, (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
        .withColumn(name, F.col("_pos") + F.col("_shift") + 1)
        .drop("_part", "_pos", "_of", "_group", "_shift")
    )


def running_totals(df: DataFrame, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_before``: the total over all earlier rows in ``order``."""
    table = _range_sorted(df, order, "running")
    offsets = _offsets(table.groupBy("_part").agg(*[F.sum(c).alias(c) for c in columns]), columns)
    inside = W.partitionBy("_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, -1)
    local = table.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_{c}_local") for c in columns])
    joined = local.join(F.broadcast(offsets), "_part")
    for c in columns:
        joined = joined.withColumn(f"{c}_before", F.col(f"{c}_before") + F.col(f"_{c}_local"))
    return joined.drop("_part", "_pos", *[f"_{c}_local" for c in columns])


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group.  Spark keeps at most ``k`` rows per
    group in each task before it shuffles, so a large group is no hot spot."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(F.col(name) <= k)


def unpivot_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, value) of the numeric columns, without nulls and NaN."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def _bucket(value: Column, low: Column, high: Column) -> Column:
    share = F.coalesce((value - low) / F.when(high > low, high - low), F.lit(0.0))
    return F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], passes: int | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation: (column, n, quantiles).

    Finds order statistics by counting.  Each of ``passes`` counts the values
    in up to BUCKETS equal-width buckets of the interval known to hold a
    wanted position, then narrows to one bucket; a last one counts the
    distinct values of that bucket.  Every pass is a scan with a partial
    aggregate: no sort of the data, no list of the values.  By default two
    passes narrow the interval 16-million-fold, fewer for a table known to
    be small.
    """
    if passes is None:
        size = estimated_bytes(df.select(*[quoted(c) for c in columns]))
        passes = sum(size > limit for limit in PASS_BYTES)
    long = unpivot_numbers(df, columns)
    span = long.groupBy("column").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    exact = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    wanted = span.select(
        "column", F.explode(F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in exact])))).alias("pos")
    )

    def narrow(brackets: DataFrame, targets: DataFrame, bucket: Column) -> DataFrame:
        """Pick, for each wanted position, the cell of a bracket that holds it."""
        inside = long.join(F.broadcast(brackets), "column").filter(F.col("value").between(F.col("low"), F.col("high")))
        cells = inside.groupBy("column", "base", bucket.alias("cell")).agg(
            F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        upto = W.partitionBy("column", "base").orderBy("cell")
        counted = cells.withColumn("end", F.col("base") + F.sum("n").over(upto)).withColumn("start", F.col("end") - F.col("n"))
        held = (F.col("t.column") == F.col("c.column")) & (F.col("t.pos") >= F.col("c.start")) & (F.col("t.pos") < F.col("c.end"))
        return counted.alias("c").join(F.broadcast(targets.alias("t")), held).select(
            "c.column", "t.pos", F.col("c.start").alias("base"), "c.low", "c.high"
        )

    brackets = span.select("column", F.lit(0).cast("long").alias("base"), "low", "high")
    for _ in range(passes):
        held = narrow(brackets, wanted, _bucket(F.col("value"), F.col("low"), F.col("high")))
        brackets = held.select("column", "base", "low", "high").distinct()
    last = narrow(brackets, wanted, F.col("value"))

    at = last.groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("pos", "low"))).alias("at"))
    low_value = [F.element_at("at", F.floor(p)) for p in exact]
    high_value = [F.element_at("at", F.ceil(p)) for p in exact]
    steps = [lo + (hi - lo) * (p - F.floor(p)) for lo, hi, p in zip(low_value, high_value, exact)]
    return span.join(at, "column").select("column", "n", F.array(*steps).alias("quantiles"))


def quantile_columns(df: DataFrame, column: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row with the quantiles of one column, under ``names``; null values
    when the column is empty."""
    found = exact_quantiles(df, [column], probs)
    return found.agg(F.first("quantiles").alias("q")).select(
        *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )
