"""Versioned manifests: small JSON documents that change by compare-and-set, on any Hadoop file system."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession

KEPT = 8  # versions that stay beside the current one


class Conflict(RuntimeError):
    """Another writer published this version first."""


class Manifest:
    """Version n is the file n of a folder. It is written aside and renamed to its place, which fails if it is taken."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        at = self._hadoop(self.path)
        names = [x.getPath().getName() for x in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def _file(self, version: int):
        return self._hadoop(f"{self.path}/{version:012d}.json")

    def read(self) -> tuple[int, dict[str, Any] | None]:
        """The current version and what it says; (0, None) before the first."""
        versions = self._versions()
        if not versions:
            return 0, None
        stream = self._fs.open(self._file(versions[-1]))
        try:
            return versions[-1], json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, after: int, said: dict[str, Any]) -> int:
        """Makes `said` the version that follows `after`; Conflict if there is one already."""
        aside = self._hadoop(f"{self.path}/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(said).encode()))
        out.close()
        files = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._hadoop(self.path).toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(aside, self._file(after + 1), none)
        except Exception as e:
            self._fs.delete(aside, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"{self.path}: version {after + 1} exists") from None
            raise
        for old in self._versions():
            if old <= after + 1 - KEPT:
                self._fs.delete(self._file(old), False)
        return after + 1
