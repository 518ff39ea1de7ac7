"""Python workers that can import this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def find_package(spark: SparkSession) -> None:
    """Put the folder this package was imported from on the workers' path.
    Where executors lack that folder, ship the package with ``--py-files``;
    the entry then names nothing and does no harm."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, ROOT])
