"""A/B results of a stream of events, per time window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.file_system import FileSystem
from basketlens.functions.shared_tables import new_path

KEYS = ["window_start", "experiment", "variant"]


def event_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet") -> DataFrame:
    """Event files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(path)


def windowed_results(conversions: DataFrame, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Tracked rows, conversions and value per window, experiment and variant.

    ``conversions`` is a stream of (event_id, ts, experiment, variant,
    converted, value).  An event delivered twice counts once in each experiment; events later
    than ``late`` are dropped with the state of their window.
    """
    unique = conversions.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id", "experiment"])
    return unique.groupBy(F.window("ts", window).alias("w"), "experiment", "variant").agg(
        F.count("*").alias("users"),
        F.count_if("converted").alias("conversions"),
        F.sum(F.col("value").cast("decimal(28,6)")).alias("total_value"),
    ).select(F.col("w.start").alias("window_start"), "experiment", "variant", "users", "conversions", "total_value")


def _batches(files: FileSystem, folder: str, prefix: str) -> list[int]:
    """Numbers of the folders that were written to an end."""
    names = [n for n in files.names(folder) if n.startswith(prefix)]
    return sorted(int(n[len(prefix) :]) for n in names if files.exists(f"{folder}/{n}/_SUCCESS"))


def _versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All versions of windows that count: the last base, and later batches."""
    files = FileSystem(spark, path)
    bases = _batches(files, f"{path}/base", "upto=")
    upto = bases[-1] if bases else -1
    later = [b for b in _batches(files, f"{path}/versions", "batch=") if b > upto]
    parts = [(upto, f"{path}/base/upto={upto}")] if bases else []
    parts += [(b, f"{path}/versions/batch={b}") for b in later]
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
    tables = [spark.read.schema(schema).parquet(p).withColumn("batch", F.lit(b).cast("long")) for b, p in parts]
    return reduce(DataFrame.unionByName, tables)


def _latest(versions: DataFrame) -> DataFrame:
    """The version with the largest batch number of every window."""
    latest = W.partitionBy(*KEYS).orderBy(F.desc("batch"))
    return versions.withColumn("_v", F.row_number().over(latest)).filter("_v = 1").drop("_v", "batch")


def compact(spark: SparkSession, path: str, schema: T.StructType) -> int | None:
    """Merge all versions so far into one base, and delete them.

    The new base counts from when it is complete; until then, and if the job
    is lost, the old base and its batches do.  Returns the last batch merged,
    None if there is nothing to merge."""
    files = FileSystem(spark, path)
    bases, batches = _batches(files, f"{path}/base", "upto="), _batches(files, f"{path}/versions", "batch=")
    upto = bases[-1] if bases else -1
    later = [b for b in batches if b > upto]
    if later:
        _latest(_versions(spark, path, schema)).write.mode("overwrite").parquet(f"{path}/base/upto={later[-1]}")
        bases, upto = [*bases, later[-1]], later[-1]
    for base in bases[:-1]:
        files.delete(f"{path}/base/upto={base}")
    for batch in batches:
        if batch <= upto:
            files.delete(f"{path}/versions/batch={batch}")
    return later[-1] if later else None


def run_to_table(results: DataFrame, path: str | None = None, compact_after: int = 16) -> DataFrame:
    """Process what is available and return the current results.

    Each trigger writes the windows that changed under its batch number, so
    a batch that is retried overwrites itself; reading keeps the latest
    version of a window.  When more than ``compact_after`` batches are kept
    they are merged into a base, so what is read stays within the windows
    and so many batches.  State and progress live in the shared folder.
    """
    spark = results.sparkSession
    path = path or new_path(spark, "conversions")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/versions/batch={number}")

    query = (
        results.writeStream.outputMode("update")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()
    if len(_batches(FileSystem(spark, path), f"{path}/versions", "batch=")) > compact_after:
        compact(spark, path, results.schema)
    current = _latest(_versions(spark, path, results.schema))
    return current.select(*KEYS, "users", "conversions", F.col("total_value").cast("double"))
