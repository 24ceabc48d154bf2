"""Several tables that grow batch by batch, all of a batch's rows at once."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from .records import Records


class CommitLog:
    """Tables below ``base`` whose batches appear whole or not at all.

    The rows of an attempt go to folders of its own, table by table; the batch counts when its
    commit record, written last, names that attempt. What a failed attempt left is never read.
    A batch that is repeated after its commit writes nothing.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self.records = Records(spark, f"{self.base}/commits")

    def committed(self) -> list[str]:
        """The committed batches, sorted by name."""
        return self.records.names()

    def commit(self, batch: str | int, tables: Mapping[str, DataFrame]) -> bool:
        """Write one batch of all ``tables``; False if the batch was committed before."""
        if str(batch) in self.records.names():
            return False
        attempt = uuid.uuid4().hex
        for name, rows in tables.items():
            rows.write.parquet(f"{self.base}/{name}/batch_id={batch}/attempt={attempt}")
        schemas = {name: json.loads(rows.schema.json()) for name, rows in tables.items()}
        return self.records.put(str(batch), {"batch": str(batch), "attempt": attempt, "tables": schemas})

    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        """All committed rows of a table, with their ``batch_id`` (text).

        Without ``schema`` it is that of the last batch that has the table.
        """
        records = [r for r in self.records.all().values() if table in r["tables"]]
        if schema is None:
            if not records:
                raise ValueError(f"no batch of {table} is committed below {self.base}")
            schema = StructType.fromJson(records[-1]["tables"][table])
        if not records:
            return self.spark.createDataFrame([], StructType([*schema.fields]).add("batch_id", StringType()))
        paths = [f"{self.base}/{table}/batch_id={r['batch']}/attempt={r['attempt']}" for r in records]
        whole = StructType([*schema.fields]).add("batch_id", StringType()).add("attempt", StringType())
        return self.spark.read.schema(whole).option("basePath", f"{self.base}/{table}").parquet(*paths).drop("attempt")
