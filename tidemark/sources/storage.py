"""Folder and file names through the Hadoop file system of a URI: metadata only, no data."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        """Names of the entries directly below ``path``."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def folders(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(
            s.getPath().getName() for s in self._fs.listStatus(self._path(path)) if s.isDirectory()
        )

    def newest(self, path: str) -> int:
        """When the newest file below ``path`` was written, in ms; 0 if there is none."""
        found, last = self._fs.listFiles(self._path(path), True), 0
        while found.hasNext():
            last = max(last, found.next().getModificationTime())
        return last

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def move_all(self, pairs: Iterable[tuple[str, str]]) -> None:
        """Many moves at once; each is one metadata call."""
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda pair: self.move(*pair), pairs))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def qualified(self, path: str) -> str:
        return self._fs.makeQualified(self._path(path)).toString()
