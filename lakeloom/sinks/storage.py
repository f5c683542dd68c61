"""Moves, deletions and small text files in whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """A file system, with moves that fail loudly: ``rename`` of many systems answers false
    instead of raising, and the caller must not go on as if the data had moved."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._utils = spark._jvm.org.apache.commons.io.IOUtils
        self._system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def folders(self, path: str) -> dict[str, str]:
        """Path by name of the folders directly below."""
        if not self.exists(path):
            return {}
        found = [status.getPath() for status in self._system.listStatus(self._path(path)) if status.isDirectory()]
        return {p.getName(): p.toString() for p in found}

    def move(self, source: str, target: str) -> None:
        """``target`` must not exist."""
        if self.exists(target):
            raise FileExistsError(target)
        if not self._rename(source, target):
            raise OSError(f"{source} was not moved to {target}")

    def _rename(self, source: str, target: str) -> bool:
        return self._system.rename(self._path(source), self._path(target))

    def replace(self, source: str, target: str, aside: str) -> None:
        """Put ``source`` in the place of ``target``. The old folder is moved aside first and
        deleted last, so one of the two is there at any time, and a move that fails puts
        the old one back."""
        if self.exists(target):
            self.delete(aside)
            self.move(target, aside)
        try:
            self.move(source, target)
        except Exception:
            if self.exists(aside) and not self.exists(target):
                self._rename(aside, target)
            raise
        self.delete(aside)

    def delete(self, path: str) -> None:
        if self.exists(path) and not self._system.delete(self._path(path), True):
            raise OSError(f"{path} was not deleted")

    def make(self, path: str) -> None:
        self._system.mkdirs(self._path(path))

    def read_text(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return self._utils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        out = self._system.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
