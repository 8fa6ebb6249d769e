"""Numbered states of a folder, of which the last complete one holds.

A state is a small JSON file. Its number is claimed by creating the file, which fails where another job was first, and
it counts once its last line is there; so readers see the state before or the state after, and of two jobs that began at
the same state one fails. Works on any file system that Hadoop reaches whose creation of files is exclusive.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

# Last line of a complete state.
END = "end"


class Conflict(RuntimeError):
    """Another job has added a state meanwhile."""


class Snapshots:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """All claimed numbers, rising."""
        if not self._files.exists(self._path(self.folder)):
            return []
        names = (str(f.getPath().getName()) for f in self._files.listStatus(self._path(self.folder)))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def read(self, number: int) -> dict | None:
        """One state; None where it was claimed and never completed."""
        stream = self._files.open(self._path(f"{self.folder}/{number}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        lines = text.split("\n")
        return json.loads(lines[0]) if lines[-1] == END else None

    def latest(self) -> tuple[int, dict]:
        """Number and content of the last complete state; 0 and nothing before the first."""
        for number in reversed(self.numbers()):
            content = self.read(number)
            if content is not None:
                return number, content
        return 0, {}

    def commit(self, after: int, content: dict) -> int:
        """Add a state that was made from state `after`; returns its number."""
        claimed = self.numbers()
        if any(n > after and self.read(n) is not None for n in claimed):
            raise Conflict(f"{self.folder} has states after {after}")
        number = max([after, *claimed]) + 1
        try:
            stream = self._files.create(self._path(f"{self.folder}/{number}.json"), False)
        except Exception as error:
            raise Conflict(f"{self.folder} got a state {number} meanwhile") from error
        stream.write(bytearray(f"{json.dumps(content)}\n{END}".encode()))
        stream.close()
        return number
