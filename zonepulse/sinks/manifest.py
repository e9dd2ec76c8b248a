"""Small files in numbered versions, each published whole or not at all.

A sink keeps in one what its readers may see.  Data files are written first, under names no reader
knows; publishing the next version makes them visible in one step.  A version is a new file that is
moved into place and never replaces another, so of two writers one comes second and starts again
from what the first one published.  The file system must refuse to move a file onto another one, as
it must for Spark's own checkpoints.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Versions that stay, for readers that are still planning from an older one.
KEPT_VERSIONS = 10


class Folder:
    """The few file system calls the sinks need, on whatever store the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._gateway = spark.sparkContext._gateway
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._fs = self._hadoop.Path(self.path).getFileSystem(self._conf)

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """What lies in the folder, or in one below it; nothing if it does not exist."""
        if not self._fs.exists(self._at(name)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def matching(self, pattern: str) -> list[str]:
        """Full paths that match a pattern below the folder."""
        return sorted(s.getPath().toString() for s in self._fs.globStatus(self._at(pattern)) or [])

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def move(self, name: str, to: str) -> bool:
        """Move what is there to a path on the same store; false if that failed, or if it does not
        exist any more."""
        target = self._hadoop.Path(to)
        if not self._fs.exists(self._at(name)):
            return False
        self._fs.mkdirs(target.getParent())
        return self._fs.rename(self._at(name), target)

    def read(self, name: str) -> str | None:
        """A small file's text; null if it does not exist any more."""
        try:
            stream = self._fs.open(self._at(name))
        except Py4JJavaError as error:
            if "FileNotFound" in error.java_exception.getClass().getName():
                return None
            raise
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Make a small file in one step; false if there is one of that name."""
        hidden = f".{name}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(hidden), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self._hadoop, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.valueOf("NONE")
        context = self._hadoop.FileContext.getFileContext(self._at("").toUri(), self._conf)
        try:
            context.rename(context.makeQualified(self._at(hidden)),
                           context.makeQualified(self._at(name)), options)
            return True
        except Py4JJavaError as error:
            self._fs.delete(self._at(hidden), False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise


class Manifest:
    """A JSON object in numbered versions below ``path``."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    @staticmethod
    def _name(version: int) -> str:
        return f"{version:020d}.json"

    def read(self, spark: SparkSession) -> tuple[int, dict]:
        """The newest version and its number; an empty object and -1 before the first."""
        folder = Folder(spark, self.path)
        while True:
            names = [n for n in folder.names() if n.endswith(".json") and not n.startswith(".")]
            if not names:
                return -1, {}
            text = folder.read(names[-1])
            if text is not None:  # else it was trimmed, so there are newer ones
                return int(names[-1].removesuffix(".json")), json.loads(text)

    def update(self, spark: SparkSession, change: Callable[[dict], dict | None]) -> dict:
        """Publish what ``change`` makes of the newest version; null leaves it as it is.

        ``change`` is called again with the newer version if another writer was first.
        """
        folder = Folder(spark, self.path)
        while True:
            version, now = self.read(spark)
            new = change(json.loads(json.dumps(now)))
            if new is None:
                return now
            if folder.create(self._name(version + 1), json.dumps(new, sort_keys=True)):
                self._trim(folder, version + 1)
                return new

    def _trim(self, folder: Folder, newest: int) -> None:
        for name in folder.names():
            number = name.removesuffix(".json")
            if number.isdigit() and int(number) <= newest - KEPT_VERSIONS:
                folder.delete(name)


def newest_versions(spark: SparkSession, root: str) -> dict[str, str]:
    """Path of the newest version of every manifest below ``root``, by the manifest's name."""
    found = Folder(spark, root).matching("*/*.json")
    return {p.rsplit("/", 2)[1]: p for p in found}  # sorted, so the last one stays
