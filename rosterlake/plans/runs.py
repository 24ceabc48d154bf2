"""Runs of several steps: each is stored once, and a run that was stopped goes on behind the last."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.records import Records

STEP_COLUMNS = "step string, rows bigint, position int"


class Run:
    """The steps of one run below ``base``.

    A step's rows are written to a folder of their own, then its record with their number: a
    step without a record is made again, one with a record is read. Steps are named once per run.
    """

    def __init__(self, spark: SparkSession, base: str, run_id: str | None = None) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self.run_id = run_id or uuid.uuid4().hex
        self.records = Records(spark, f"{self.base}/runs/{self.run_id}")
        self.done = self.records.all()

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stored rows of a step; ``make`` is only called if the run does not have them yet."""
        if name not in self.done:
            rows = make()
            folder = f"{self.base}/data/{self.run_id}/{name}-{uuid.uuid4().hex}"
            rows.write.parquet(folder)
            schema = json.loads(rows.schema.json())
            count = self.spark.read.schema(rows.schema).parquet(folder).count()
            record = {"folder": folder, "rows": count, "position": len(self.done), "schema": schema}
            self.records.put(name, record)
            self.done = self.records.all()
        record = self.done[name]
        return self.spark.read.schema(StructType.fromJson(record["schema"])).parquet(record["folder"])

    def steps(self) -> DataFrame:
        """step, rows, position: the finished steps."""
        rows = [(name, r["rows"], r["position"]) for name, r in self.done.items()]
        return self.spark.createDataFrame(rows, STEP_COLUMNS).orderBy("position")


def runs_of(spark: SparkSession, base: str) -> list[str]:
    """The names of all runs below ``base`` that have a finished step, the newest last."""
    folder = Records(spark, f"{base.rstrip('/')}/runs")
    found = folder.files().globStatus(folder.path("*")) or []
    ordered = sorted((int(s.getModificationTime()), str(s.getPath().getName())) for s in found)
    return [name for _, name in ordered]


def remove_old_runs(spark: SparkSession, base: str, keep: int) -> list[str]:
    """Remove the rows and records of all runs but the last ``keep``; returns their names.

    Nobody may read those runs any more.
    """
    old = runs_of(spark, base)[: -keep or None]
    folder = Records(spark, base)
    for name in old:
        folder.remove(f"{folder.folder}/data/{name}")
        folder.remove(f"{folder.folder}/runs/{name}")
    return old
