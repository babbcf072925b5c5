"""Files of any store that Spark reads, on the driver: small manifests and what lies in a folder."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Hadoop's file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root, self._fs = path.rstrip("/"), self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        if not self._fs.exists(self._at(folder)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(folder)))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file whole; False if another writer was first. It appears by a rename."""
        from uuid import uuid4

        hidden = f"{name.rpartition('/')[0]}/.{uuid4().hex}".lstrip("/")
        stream = self._fs.create(self._at(hidden), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._fs.exists(self._at(name)) and self._fs.rename(self._at(hidden), self._at(name)):
            return True
        self._fs.delete(self._at(hidden), False)
        return False

    def rename(self, old: str, new: str) -> None:
        self._fs.mkdirs(self._at(new.rpartition("/")[0]))
        if not (self._fs.exists(self._at(old)) and self._fs.rename(self._at(old), self._at(new))):
            raise FileNotFoundError(f"{old} can't become {new}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
