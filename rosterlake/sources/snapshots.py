"""Snapshots in key buckets: a batch of changes rewrites the buckets of its keys only."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .records import Records

BUCKET = "_bucket"


class ConcurrentChange(RuntimeError):
    """Another batch has rewritten a bucket that this one was made from."""


class BucketedSnapshot:
    """A table of unique keys below ``base``, stored by bucket of its key.

    A numbered manifest names, for every bucket that has rows, the folder with its newest copy.
    Readers keep to the manifest that they began with. A batch writes new copies of the
    buckets that its keys fall into, then the next manifest: before that nothing of it is seen.
    If another batch was quicker and touched other buckets, its manifest is built on; if it
    touched one of the same, ``ConcurrentChange`` is raised and the batch can be repeated.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self.manifests = Records(spark, f"{self.base}/manifests")

    @classmethod
    def create(cls, df: DataFrame, base: str, key: str, buckets: int) -> "BucketedSnapshot":
        """Store ``df``; choose ``buckets`` so that one of them is about as large as a file should be."""
        made = cls(df.sparkSession, base)
        manifest = {"key": key, "count": buckets, "schema": json.loads(df.schema.json()), "buckets": {}, "rewritten": []}
        if not made.manifests.put(f"{0:010d}", made._next(manifest, df, None)):
            raise ValueError(f"there is a snapshot below {base} already")
        return made

    @property
    def version(self) -> int:
        names = self.manifests.names()
        if not names:
            raise ValueError(f"no snapshot below {self.base}")
        return int(names[-1])

    def manifest(self, version: int | None = None) -> dict:
        name = f"{self.version if version is None else version:010d}"
        text = self.spark.read.text(f"{self.manifests.folder}/{name}.json", wholetext=True).first()["value"]
        return json.loads(text)

    @staticmethod
    def bucket_of(key: str, count: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(count)).cast("int")

    def _next(self, manifest: dict, rows: DataFrame, touched: Iterable[int] | None) -> dict:
        """The manifest after ``rows`` have been written as new copies of the touched buckets."""
        folder = f"copy-{uuid.uuid4().hex}"
        bucket = self.bucket_of(manifest["key"], manifest["count"])
        # one task and one file per bucket
        placed = rows.withColumn(BUCKET, bucket).repartition(BUCKET)
        placed.write.partitionBy(BUCKET).parquet(f"{self.base}/{folder}")
        written = Records(self.spark, f"{self.base}/{folder}")
        found = written.files().globStatus(written.path(f"{BUCKET}=*")) or []
        filled = {str(status.getPath().getName()).split("=")[1] for status in found}
        rewritten = sorted(filled if touched is None else {str(b) for b in touched}, key=int)
        buckets = {b: f for b, f in manifest["buckets"].items() if b not in rewritten}
        buckets |= {b: folder for b in filled}
        return manifest | {"buckets": buckets, "rewritten": rewritten}

    def read(self, buckets: Iterable[int] | None = None, version: int | None = None) -> DataFrame:
        """The rows of the newest or a given version, of all or some buckets."""
        return self._rows(self.manifest(version), buckets)

    def _rows(self, manifest: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        wanted = None if buckets is None else {str(b) for b in buckets}
        paths = [f"{self.base}/{f}/{BUCKET}={b}" for b, f in manifest["buckets"].items() if wanted is None or b in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def change(self, changes: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Rewrite the buckets of the keys of ``changes`` and return their numbers.

        ``apply`` gets the rows of those buckets and the changes and returns the rows after them;
        it may add and delete rows of those keys. ``changes`` has the key under its name;
        changes without a key have no bucket and change nothing.
        """
        version = self.version
        manifest = self.manifest(version)
        key, count = manifest["key"], manifest["count"]
        keyed = changes.filter(F.col(key).isNotNull())
        # at most one row per bucket
        touched = sorted(r["b"] for r in keyed.select(self.bucket_of(key, count).alias("b")).distinct().collect())
        if not touched:
            return []
        made = self._next(manifest, apply(self._rows(manifest, touched), keyed).select(*self._rows(manifest).columns), touched)
        new = {b: f for b, f in made["buckets"].items() if int(b) in touched}
        while not self.manifests.put(f"{version + 1:010d}", made):
            version += 1
            other = self.manifest(version)
            if set(other["rewritten"]) & set(made["rewritten"]):
                raise ConcurrentChange(f"version {version} of {self.base} has changed the same buckets")
            kept = {b: f for b, f in other["buckets"].items() if int(b) not in touched}
            made = made | {"buckets": kept | new}
        return touched

    def forget(self, keep: int = 2) -> int:
        """Delete copies that none of the last ``keep`` manifests names; returns how many.

        Readers of older versions must be done, and no batch may be on its way.
        """
        last = self.manifests.names()[-keep:]
        named = {f for n in last for f in self.manifest(int(n))["buckets"].values()}
        folder = Records(self.spark, self.base)
        found = folder.files().globStatus(folder.path("copy-*")) or []
        old = [str(s.getPath().toString()) for s in found if str(s.getPath().getName()) not in named]
        for path in old:
            folder.remove(path)
        return len(old)
