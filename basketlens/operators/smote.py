"""Synthetic rows of the smaller classes, between a row and one of its
nearest neighbours of the same class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.ordering import rank_in_group
from basketlens.functions.scalars import quoted
from basketlens.functions.shared_tables import written_table
from basketlens.operators.neighbours import finite_point, nearest_in_group
from basketlens.operators.splits import seeded_order

SEED = 42
NEIGHBOURS = 5


def hashed_number(*parts: Column) -> Column:
    """32 bits of the MD5 of the parts, the same in every engine and run."""
    text = F.concat_ws("_", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def smote_rows(df: DataFrame, key: str, label: str, columns: Sequence[str], k: int = NEIGHBOURS, seed: int = SEED) -> DataFrame:
    """(key, label, copy, neighbour, share, *columns): the rows that the
    smaller classes lack to be as many as the largest.

    Each complete row of a class is the base of equally many synthetic ones
    (some have one more, chosen by hash).  A synthetic row lies at ``share``
    of the way from its base to one of the base's ``k`` nearest neighbours
    in the class; which one and how far follow from a hash of key, copy and
    seed, so a rerun gives the same rows.  A row without neighbours is its
    own; a class without complete rows gets none.  Only ``df`` is looked at:
    pass the training part, and no test row is a base or neighbour.

    ``key`` must be unique.  Rows with a null or non-finite column count for
    the size of their class but are neither base nor neighbour; rows without
    label are left out.  Classes of equal size give an empty result.
    """
    used = written_table(df.filter(quoted(label).isNotNull() & quoted(key).isNotNull()).select(quoted(key), quoted(label), *map(quoted, columns)), "smote-rows")
    sizes = {r[label]: r["n"] for r in used.groupBy(label).agg(F.count("*").alias("n")).collect()}  # a row per class
    most = max(sizes.values(), default=0)
    small = [name for name, n in sizes.items() if n < most]
    minority = used.filter(quoted(label).isin(small))
    near = nearest_in_group(minority, key, label, columns, k)
    near = rank_in_group(near.withColumn("_o", seeded_order(key, seed)), label, [F.col("_o"), F.col(key)], "_r")
    near = written_table(near, "smote-bases")
    bases = {r[label]: r["n"] for r in near.groupBy(label).agg(F.count("*").alias("n")).collect()}

    def by_class(numbers: dict) -> Column:
        """A number of the row's class; 0 without one."""
        value = F.lit(0)
        for name, n in numbers.items():
            value = F.when(quoted(label) == F.lit(name), F.lit(n)).otherwise(value)
        return value

    lacking = {name: most - sizes[name] for name in bases}
    times = by_class({n: lacking[n] // bases[n] for n in bases}) + (F.col("_r") <= by_class({n: lacking[n] % bases[n] for n in bases})).cast("int")
    copies = near.withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(1), times.cast("int"))).otherwise(F.array().cast("array<int>"))))
    many = F.size("neighbours")
    picked = F.get("neighbours", F.pmod(hashed_number(F.col(key), F.col("copy"), F.lit(seed), F.lit("neighbour")), F.greatest(many, F.lit(1))).cast("int"))
    share = hashed_number(F.col(key), F.col("copy"), F.lit(seed), F.lit("share")) / F.lit(2.0**32)
    made = copies.withColumn("_to", picked).withColumn("share", share)
    values = []
    for j, column in enumerate(columns):
        own, other = F.get("point", F.lit(j)), F.get(F.col("_to.point"), F.lit(j))
        values.append((own + F.col("share") * (F.coalesce(other, own) - own)).alias(column))
    return made.select(quoted(key), quoted(label), "copy", F.coalesce("_to.key", F.col(key)).alias("neighbour"), "share", *values)


def smote(df: DataFrame, key: str, label: str, columns: Sequence[str], k: int = NEIGHBOURS, seed: int = SEED) -> DataFrame:
    """(key, label, synthetic, *columns): the complete rows of ``df`` and the
    synthetic ones, so that complete classes are equally large."""
    _, finite = finite_point(columns)
    numbers = [quoted(c).cast("double").alias(c) for c in columns]
    own = df.filter(quoted(label).isNotNull() & finite).select(quoted(key), quoted(label), F.lit(False).alias("synthetic"), *numbers)
    made = smote_rows(df, key, label, columns, k, seed)
    return own.unionByName(made.select(quoted(key), quoted(label), F.lit(True).alias("synthetic"), *map(quoted, columns)))
