"""Small records in shared storage, each written once: the base of commits, ledgers and manifests."""

from __future__ import annotations

import json
import uuid

from pyspark.errors.exceptions.captured import CapturedException
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Records:
    """JSON records in a folder under names of their own.

    A record is written under a hidden name and renamed, so a reader sees all of it or nothing.
    Of several writers of one name one succeeds, as far as the file system's rename is atomic.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def files(self):
        return self.path("x").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        """Names of all records, sorted."""
        found = self.files().globStatus(self.path("*.json")) or []
        return sorted(str(status.getPath().getName()).removesuffix(".json") for status in found)

    def put(self, name: str, record: dict) -> bool:
        """Write a record; False if there is one of that name already."""
        jvm, files = self.spark.sparkContext._jvm, self.files()
        hidden, final = self.path(f".{uuid.uuid4().hex}"), self.path(f"{name}.json")
        stream = files.create(hidden, False)
        stream.write(json.dumps(record | {"name": name}).encode())
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(files.makeQualified(hidden), files.makeQualified(final), options)
        except (Py4JJavaError, CapturedException):
            if not files.exists(final):
                raise
            files.delete(hidden, False)
            return False
        return True

    def all(self) -> dict[str, dict]:
        """All records by name, read in one job."""
        if not self.names():
            return {}
        rows = self.spark.read.text(self.folder, wholetext=True, pathGlobFilter="*.json").collect()
        found = (json.loads(r["value"]) for r in rows)
        return {r["name"]: r for r in sorted(found, key=lambda r: r["name"])}

    def remove(self, path: str) -> None:
        """Delete a folder below this one's parent that no record names any more."""
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        self.files().delete(target, True)
