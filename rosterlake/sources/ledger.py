"""Surrogate keys across batches: ranges that are reserved once per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.ordered import assign_keys
from .records import Records
from .schemas import KEY_START


class KeyLedger:
    """Ranges of keys per sequence, one after the other without a gap.

    A batch that asks again gets the range that it has; two writers that ask at once get ranges
    one after the other. There is one small record per batch.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")

    def reserve(self, sequence: str, batch: str | int, count: int, start: int | None = None) -> int:
        """The first of ``count`` keys for a batch. The first batch begins at ``start``, by
        default at the declared start of the table that ``sequence`` names."""
        if count < 0:
            raise ValueError("a range has no negative size")
        records = Records(self.spark, f"{self.base}/{sequence}")
        while True:
            known = list(records.all().values())
            for r in known:
                if r["batch"] == str(batch):
                    if r["count"] != count:
                        raise ValueError(f"batch {batch} of {sequence} has {r['count']} keys, not {count}")
                    return r["first"]
            first = known[-1]["first"] + known[-1]["count"] if known else KEY_START[sequence] if start is None else start
            if records.put(f"{len(known):010d}", {"batch": str(batch), "first": first, "count": count}):
                return first

    def assign(self, rows: DataFrame, order_by: Sequence[str], key: str, sequence: str, batch: str | int) -> DataFrame:
        """``rows`` with keys from the batch's range in the given order, which must be unique.

        The rows are counted while the plan is built: write them first if they are costly.
        """
        return assign_keys(rows, order_by, key, self.reserve(sequence, batch, rows.count()))
