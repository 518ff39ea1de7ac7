"""Tables that change as a whole or not at all.

Every write puts its files into a folder of its own.  A numbered manifest
names the folders that make up the table; it is written last, under its
final name, so a reader sees the table before or after a write, and a write
that is lost halfway leaves files that no manifest names.  One writer at a
time is meant: the second of two that start from one version fails.

::

    data/write=<id>/[column=value/]part-*.parquet
    manifests/000001.json
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from basketlens.functions.file_system import FileSystem


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = FileSystem(spark, self.path)

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.path}/manifests") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """What a version (by default the last) is made of."""
        known = self.versions()
        if not known:
            return {"version": 0, "schema": None, "partition_by": [], "folders": []}
        return json.loads(self.files.read_text(f"{self.path}/manifests/{version or known[-1]:06d}.json"))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version; earlier versions can be read until ``vacuum``."""
        held = self.manifest(version)
        if held["schema"] is None:
            raise FileNotFoundError(f"no version of a table at {self.path}")
        schema = T.StructType.fromJson(json.loads(held["schema"]))
        if not held["folders"]:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/data/{f}" for f in held["folders"]]
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*folders).select(*schema.names)

    def _staged(self, df: DataFrame, partition_by: Sequence[str]) -> list[str]:
        """Write the rows; the folders that hold them, one per partition."""
        name = f"write={uuid.uuid4().hex}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{self.path}/data/{name}")
        found = [name]
        for column in partition_by:
            found = [f"{f}/{n}" for f in found for n in self.files.names(f"{self.path}/data/{f}") if n.startswith(f"{column}=")]
        return found

    def _commit(self, before: dict, df: DataFrame, partition_by: Sequence[str], folders: list[str]) -> int:
        version = before["version"] + 1
        made = {"version": version, "schema": df.schema.json(), "partition_by": list(partition_by), "folders": folders}
        self.files.write_text(f"{self.path}/manifests/{version:06d}.json", json.dumps(made))
        return version

    def overwrite(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Replace all rows; returns the number of the new version."""
        return self._commit(self.manifest(), df, partition_by, self._staged(df, partition_by))

    def append(self, df: DataFrame) -> int:
        """Add rows, of the same columns and partitioned as the table is."""
        before, df = self._fitting(df)
        return self._commit(before, df, before["partition_by"], before["folders"] + self._staged(df, before["partition_by"]))

    def replace_partitions(self, df: DataFrame) -> int:
        """Replace the partitions that ``df`` has rows of, and leave others."""
        before, df = self._fitting(df)
        if not before["partition_by"]:
            raise ValueError("the table has no partitions")
        staged = self._staged(df, before["partition_by"])
        partition = lambda folder: folder.split("/", 1)[1]
        new = {partition(f) for f in staged}
        kept = [f for f in before["folders"] if partition(f) not in new]
        return self._commit(before, df, before["partition_by"], kept + staged)

    def _fitting(self, df: DataFrame) -> tuple[dict, DataFrame]:
        before = self.manifest()
        if before["schema"] is None:
            raise FileNotFoundError(f"no version of a table at {self.path}")
        fields = T.StructType.fromJson(json.loads(before["schema"])).fields
        if sorted(df.columns) != sorted(f.name for f in fields) or any(df.schema[f.name].dataType != f.dataType for f in fields):
            raise ValueError("columns differ from those of the table")
        return before, df.select(*[f.name for f in fields])

    def vacuum(self) -> None:
        """Delete what the last version does not name: earlier versions, and
        what lost writes left.  Not while somebody writes or reads them."""
        held = self.manifest()
        used = {f.split("/", 1)[0] for f in held["folders"]}
        for name in self.files.names(f"{self.path}/data"):
            if name not in used:
                self.files.delete(f"{self.path}/data/{name}")
        for version in self.versions()[:-1]:
            self.files.delete(f"{self.path}/manifests/{version:06d}.json")
