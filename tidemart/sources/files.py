"""Small files on any file system that Spark reaches, read and written by the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder of small text files, such as records of what a table holds."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def names(self) -> list[str]:
        """Names in the folder, without hidden ones; none if there is no folder."""
        if not self._files.exists(self._root):
            return []
        found = [s.getPath().getName() for s in self._files.listStatus(self._root)]
        return sorted(n for n in found if not n.startswith((".", "_")))

    def partitions(self, column: str) -> list[str]:
        """Values of a partition column; they must need no escapes."""
        if not self._files.exists(self._root):
            return []
        found = [s.getPath().getName() for s in self._files.listStatus(self._root)]
        return [n.split("=", 1)[1] for n in found if n.startswith(f"{column}=")]

    def size(self, name: str) -> int:
        """Bytes of a file or of all files in a folder."""
        return self._files.getContentSummary(self._path(name)).getLength()

    def read(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a new file; it appears whole or not at all. An existing one is an error."""
        path, draft = self._path(name), self._path(f".{name}.draft")
        if self._files.exists(path):
            raise FileExistsError(path.toString())
        stream = self._files.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._files.rename(draft, path):
            raise FileExistsError(path.toString())

    def remove(self, name: str) -> None:
        """Delete a file or a whole folder."""
        self._files.delete(self._path(name), True)

    def rename(self, name: str, new: str) -> None:
        """Give a file or folder a name that is free."""
        if not self._files.rename(self._path(name), self._path(new)):
            raise FileExistsError(self._path(new).toString())
