"""Moving finished folders, the one step that a table's readers see."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folders:
    """Renames, lists and deletes folders through the file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        """Names of the folders inside ``path`` that are neither hidden nor files, sorted."""
        if not self.exists(path):
            return []
        found = (s for s in self._files.listStatus(self._path(path)) if s.isDirectory())
        names = [s.getPath().getName() for s in found]
        return sorted(n for n in names if n[0] not in "._")

    def move(self, source: str, target: str) -> None:
        parent = self._path(target).getParent()
        self._files.mkdirs(parent)
        if not self._files.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} cannot be moved to {target}")

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)


def beside(path: str, what: str) -> str:
    """A new name beside ``path`` that readers of its parent folder pass over."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{what}-{name}-{uuid.uuid4().hex}".replace("=", "-")
