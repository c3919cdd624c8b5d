"""Driver-side file operations through Hadoop's FileSystem, so that any store Spark reads will do."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.conf)

    def qualified(self, path: str) -> str:
        p = self._path(path)
        return p.makeQualified(self._fs(path).getUri(), self._fs(path).getWorkingDirectory()).toString()

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def list(self, path: str) -> list[tuple[str, int, bool, int]]:
        """``name, bytes, is a folder, modified (ms)`` of the entries of a folder, by name; empty if there is none."""
        if not self.exists(path):
            return []
        found = self._fs(path).listStatus(self._path(path))
        return sorted((s.getPath().getName(), s.getLen(), s.isDirectory(), s.getModificationTime()) for s in found)

    def mkdirs(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def read(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str, replace: bool = False) -> bool:
        """Writes a file in one go; False if it exists already and is not to be replaced.

        The content goes to a temporary name first and is renamed, which fails where the target exists, so readers see
        a whole file or none.
        """
        fs, target = self._fs(path), self._path(path)
        if not replace and fs.exists(target):
            return False
        temporary = self._path(f"{target.getParent()}/.{target.getName()}.{uuid.uuid4().hex}")
        stream = fs.create(temporary, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if replace:
            fs.delete(target, False)
            return fs.rename(temporary, target)
        # an empty claim, created exclusively, decides between two writers; the content then replaces it
        claim = self._path(f"{target.getParent()}/.{target.getName()}.claim")
        if fs.exists(target):
            fs.delete(temporary, False)
            return False
        if fs.exists(claim) and not fs.exists(target) and time.time() * 1000 - fs.getFileStatus(claim).getModificationTime() > 300_000:
            fs.delete(claim, False)  # its writer died five minutes ago
        try:
            fs.create(claim, False).close()
        except Exception:  # py4j wraps FileAlreadyExistsException
            fs.delete(temporary, False)
            return False
        # the last holder of the claim may have finished between the first look and the claim: a rename may overwrite
        done = not fs.exists(target) and fs.rename(temporary, target)
        if not done:
            fs.delete(temporary, False)
        fs.delete(claim, False)
        return done

    def rename(self, source: str, target: str) -> None:
        if not self._fs(source).rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)
