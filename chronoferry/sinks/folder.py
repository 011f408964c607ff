"""A shared folder of small files and published outputs, in any file system that Spark reaches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


class SharedFolder:
    """Names are relative to the folder. A file appears under its name as a whole or not at all."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def names(self, folder: str) -> list[str]:
        """What lies directly in a folder; nothing if there is no such folder."""
        path = self._path(folder)
        if not self._files.exists(path):
            return []
        return sorted(entry.getPath().getName() for entry in self._files.listStatus(path))

    def read(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, lines: Iterable[str]) -> None:
        """A text file, complete when it appears; one of that name is replaced."""
        draft = self._path(f"_draft-{uuid.uuid4().hex}")
        stream = self._files.create(draft, True)
        try:
            for line in lines:
                stream.write(bytearray(f"{line}\n", "utf-8"))
        finally:
            stream.close()
        self._publish(draft, self._path(name))

    def publish(self, name: str, as_name: str) -> None:
        """Rename a folder that a job has finished; one that stands there without being known to anyone goes."""
        self._publish(self._path(name), self._path(as_name))

    def _publish(self, source, target) -> None:
        self._files.mkdirs(target.getParent())
        if self._files.exists(target):
            self._files.delete(target, True)
        if not self._files.rename(source, target):
            raise OSError(f"could not rename {source} to {target}")

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.at(name))
