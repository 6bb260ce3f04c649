"""Folders of the lakehouse, through the file system that Spark itself uses for the path."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """List, delete and write small files under any path that Spark can open."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self._conf), at

    def children(self, path: str) -> list[tuple[str, int]]:
        """(folder, time of change in ms) of the folders directly below ``path``; none if it is missing."""
        fs, at = self._open(path)
        found = fs.listStatus(at) if fs.exists(at) else []
        return [(f"{path}/{f.getPath().getName()}", f.getModificationTime()) for f in found if f.isDirectory()]

    def exists(self, path: str) -> bool:
        fs, at = self._open(path)
        return fs.exists(at)

    def mounted(self, path: str) -> str | None:
        """The path for Python's own file functions, if it lies on a file system that the machines mount (``file:``)."""
        fs, at = self._open(path)
        return fs.makeQualified(at).toUri().getPath() if fs.getUri().getScheme() == "file" else None

    def delete(self, path: str) -> None:
        """Delete a folder with all below it, or a file; nothing happens if it is missing."""
        fs, at = self._open(path)
        fs.delete(at, True)

    def write_text(self, path: str, text: str) -> None:
        """Write (or replace) a small file."""
        fs, at = self._open(path)
        out = fs.create(at, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
