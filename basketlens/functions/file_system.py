"""Small files and folders on whatever store Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


class FileSystem:
    """The Hadoop file system that holds ``root``.  Names are listed and small
    texts read by the driver; data never are."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Write a whole file under another name and give it its name last."""
        hidden = self._path(f"{path}.part")
        stream = self._fs.create(hidden, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.exists(path) or not self._fs.rename(hidden, self._path(path)):
            raise FileExistsError(path)
