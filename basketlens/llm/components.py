"""Connected components of links between integer nodes, on Spark.

Large-star and small-star rounds: every node links its larger neighbours,
then its smaller ones, to the smallest it knows.  The links of a node are
reduced to a minimum before anything meets, so a hub is no heavy group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shared_tables import written_table


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links ``a`` - ``b`` reach,
    for every node with a link to another one.

    Null ends and self-links are dropped; repeated links and either order
    are fine; no link gives an empty table.  Each round is written to the
    shared folder, so lineage stays short and executors may be lost.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    links = written_table(links.distinct(), "links")
    before = None
    while (now := _digest(links)) != before:
        before = now
        links = written_table(_small_star(_large_star(links).filter("a <> b").distinct()).filter("a <> b").distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
