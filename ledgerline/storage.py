"""Small files on whatever file system a path names (Hadoop API): run
records, listings. Table data never goes through here."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """Names under a folder, sorted; none if it does not exist."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def files(self, path: str) -> list[tuple[str, int, int]]:
        """(path below the folder, bytes, time of change) of every data file
        under a folder, sorted. Hidden files and folders are left out."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        root, out, found = p.getFileSystem(self._conf).makeQualified(p).toString().rstrip("/"), [], fs.listFiles(p, True)
        while found.hasNext():
            s = found.next()
            name = s.getPath().toString()[len(root) + 1:]
            if not any(part[:1] in "._" for part in name.split("/")):
                out.append((name, s.getLen(), s.getModificationTime()))
        return sorted(out)

    def read_text(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Whole or not at all: written beside and renamed."""
        fs, p = self._at(path)
        beside = self._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
        out = fs.create(beside, True)
        try:
            out.write(text.encode())
        finally:
            out.close()
        fs.delete(p, False)
        if not fs.rename(beside, p):
            raise OSError(f"cannot write {path}")

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
