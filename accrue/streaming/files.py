"""Small JSON records next to the data, through the cluster's own file system."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


KEPT = 1000  # records a folder keeps, so listing it stays cheap


class Records:
    """A folder of numbered JSON records; a record appears whole or not at all."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._folder = self._path(path)
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self._read = jvm.org.apache.commons.io.IOUtils.toString

    def _file(self, name: str):
        return self._path(self._folder, name)

    def names(self) -> list[str]:
        if not self._fs.exists(self._folder):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._folder)]

    def last(self) -> int | None:
        return max((int(name[:-5]) for name in self.names() if name.endswith(".json")), default=None)

    def get(self, number: int) -> dict | None:
        file = self._file(f"{number:012d}.json")
        if not self._fs.exists(file):
            return None
        stream = self._fs.open(file)
        try:
            return json.loads(self._read(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, number: int, record: dict) -> None:
        draft = self._file(f".{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(record).encode()))
        finally:
            stream.close()
        if not self._fs.rename(draft, self._file(f"{number:012d}.json")):
            raise OSError(f"record {number} exists already in {self._folder}")
        self.delete(f"{number - KEPT:012d}.json")

    def make(self, path: str) -> None:
        """A folder, if it is not there."""
        self._fs.mkdirs(self._path(path))

    def move(self, path: str, to: str) -> None:
        """Show a written folder at its place, as a whole."""
        place = self._path(to)
        self._fs.mkdirs(place.getParent())
        if not self._fs.rename(self._path(path), place):
            raise OSError(f"{to} exists already, or cannot be written")

    def delete(self, name: str) -> None:
        self._fs.delete(self._file(name), True)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))
