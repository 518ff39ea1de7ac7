"""Intermediate tables on the storage that all executors share.

Used where a result must be fixed before it is read twice (a range
partitioning is sampled, so recomputing it may cut elsewhere) and where
lineage should end.  The data survive the loss of executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or a temporary one for
    a local session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.basketlens.localFolder", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="basketlens-")
    spark.conf.set("spark.basketlens.localFolder", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/basketlens-{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def written_table(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.  ``compression``
    is a codec of Parquet, the session's own if None."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def delete_written_tables(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Remove the intermediate tables of this process once results are out:
    those written after the first ``since``, but for the last ``keep``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    end = max(since, len(_written) - keep)
    for name in _written[since:end]:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    del _written[since:end]


def written_so_far() -> int:
    """How many intermediate tables there are, for ``since``."""
    return len(_written)
