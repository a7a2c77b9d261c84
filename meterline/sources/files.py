"""Small files and folders beside a table, in whatever store its path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """Hadoop's file system of a path, for a handful of small files; rows are Spark's business."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.files = self._at(path).getFileSystem(self._conf)

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        """Names in a folder, none if it is not there."""
        at = self._at(path)
        return sorted(f.getPath().getName() for f in self.files.listStatus(at)) if self.files.exists(at) else []

    def exists(self, path: str) -> bool:
        return self.files.exists(self._at(path))

    def read(self, path: str) -> str:
        stream = self.files.open(self._at(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Write a new file that readers see whole or not at all; an existing one is an error."""
        if self.exists(path):
            raise FileExistsError(path)
        folder, name = path.rsplit("/", 1)
        hidden = f"{folder}/.{name}.tmp"
        stream = self.files.create(self._at(hidden), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.rename(hidden, path)

    def rename(self, path: str, to: str) -> None:
        if not self.files.rename(self._at(path), self._at(to)):
            raise FileExistsError(to)

    def remove(self, path: str) -> None:
        self.files.delete(self._at(path), True)
