"""Validate arriving payroll and leave rows batch by batch.

Each micro-batch runs the same set-based check as a batch job. Its outputs are committed
together under the batch id (see ``sources.commits``): readers see all tables of a batch or none,
and a batch that is repeated after a failure is stored once. Audit rows get ids from a ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import AsOf
from ..operators.changes import audit_rows, validate_leave, validate_payroll
from ..session import materialize
from ..sources.commits import CommitLog
from ..sources.ledger import KeyLedger

BatchCheck = Callable[[DataFrame, int], Mapping[str, DataFrame]]


def _run(stream: DataFrame, check: BatchCheck, out: str, checkpoint: str) -> StreamingQuery:
    def store(batch: DataFrame, batch_id: int) -> None:
        log = CommitLog(batch.sparkSession, out)
        if str(batch_id) in log.committed():
            return
        batch.persist()
        try:
            log.commit(batch_id, check(batch, batch_id))
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_committed(spark: SparkSession, out: str, table: str) -> DataFrame:
    """The rows of one output of a stream, whole batches only, with their ``batch_id``."""
    return CommitLog(spark, out).read(table)


def stream_validate_payroll(
    stream: DataFrame,
    employee: DataFrame,
    salary_bonus: DataFrame,
    out: str,
    checkpoint: str,
    as_of: AsOf = None,
) -> StreamingQuery:
    """Store arriving payroll rows under ``accepted`` and variance warnings under ``audit``.

    Audit rows have ids from a ledger below ``out``, in the order of payroll_id within a batch.
    """
    keys = KeyLedger(stream.sparkSession, f"{out}/keys")

    def check(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        outcome = validate_payroll(batch, employee, salary_bonus, as_of)
        warnings = materialize(outcome.audit, "warnings")
        first = keys.reserve("payroll_audit", batch_id, warnings.count())
        return {"accepted": outcome.rows, "audit": audit_rows(warnings, "payroll_audit", ["payroll_id"], first=first)}

    return _run(stream, check, out, checkpoint)


def stream_validate_leave(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Store arriving leave rows under ``accepted`` or, with bad dates, ``rejected``."""

    def check(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        outcome = validate_leave(batch)
        return {"accepted": outcome.rows, "rejected": outcome.rejected}

    return _run(stream, check, out, checkpoint)
