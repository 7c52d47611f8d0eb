"""File operations on whatever file system a path names, by Hadoop's classes in the driver.

Only names and whole-file moves go through here, never content.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def size(self, path: str) -> int:
        """Bytes of all files below a folder."""
        fs, p = self._at(path)
        return fs.getContentSummary(p).getLength()

    def delete(self, path: str) -> None:
        """A file or a folder; a missing one is no error."""
        fs, p = self._at(path)
        fs.delete(p, True)

    def move(self, source: str, target: str) -> None:
        """A file to a name that is not taken; folders above the target are made."""
        fs, p = self._at(source)
        to = self._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(to.getParent())
        if not fs.rename(p, to):
            raise OSError(f"could not move {source} to {target}")

    def touch(self, path: str) -> None:
        fs, p = self._at(path)
        fs.create(p, True).close()

    def children(self, path: str) -> list[str]:
        """Names directly below a folder; none if it is missing."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def below(self, path: str) -> Iterator[str]:
        """Data files below a folder, as paths relative to it."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return
        root = fs.makeQualified(p).toString().rstrip("/")
        found = fs.listFiles(p, True)
        while found.hasNext():
            name = found.next().getPath().toString()[len(root) + 1 :]
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                yield name

    def plain(self, uri: str) -> str:
        """The path that `_metadata.file_path` or `inputFiles` names, which are escaped."""
        return self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(uri)).toString()

    def qualified(self, path: str) -> str:
        fs, p = self._at(path)
        return fs.makeQualified(p).toString().rstrip("/")
