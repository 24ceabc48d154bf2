"""Change jobs: a snapshot and a batch of changes give a new snapshot, audit rows and rejects.

What triggers and one-row procedures do per row is one set-based job per batch here.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import labels
from ..functions.dates import AsOf, day, days_between
from ..functions.money import deduct, ratio
from ..functions.text import full_name, joined, number_text
from ..session import BROADCAST_ROWS, tasks_for
from ..sources.loading import conform
from ..sources.schemas import KEY_START, declared_schema
from .joins import flag_existing, matching, without
from .ordered import assign_keys, largest_before, over_order
from .quality import check_rows, checks_of

# names of our own for refusals that have no code
EMAIL_EXISTS = "EMAIL_EXISTS"
SALARY_UNKNOWN = "SALARY_NOT_FOUND"
AMOUNT_MISSING = "AMOUNT_MISSING"
SUPERSEDED = "SUPERSEDED"
LEAVE_UNKNOWN = "LEAVE_NOT_FOUND"
DIRECTORY_COLUMNS = ("first_name", "last_name", "email", "phone")


class Outcome(NamedTuple):
    """New snapshot or accepted rows, audit rows, rejected rows."""

    rows: DataFrame
    audit: DataFrame | None
    rejected: DataFrame | None


def _user(name: str | None) -> Column:
    return F.current_user() if name is None else F.lit(name)


def latest_change(
    changes: DataFrame, key: str, order_by: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Last change per key, combined before the shuffle so that a hot key is one row per task."""
    newest = F.max_by(F.struct(*columns), F.struct(*order_by)).alias("_new")
    return changes.groupBy(key).agg(newest).select(key, "_new.*")


def apply_updates(
    current: DataFrame,
    changes: DataFrame,
    key: str,
    columns: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Snapshot with ``columns`` replaced where ``changes`` has the row.

    Of several changes of a row the last one in ``order_by`` counts, and among equals the
    largest, so the snapshot never gets more rows.
    """
    last = latest_change(changes, key, [*order_by, *columns], columns)
    new = last.select(
        F.col(key), F.lit(True).alias("_hit"), *[F.col(n).alias(f"_to_{n}") for n in columns]
    )
    updated = {
        n: F.when(F.col("_hit"), F.col(f"_to_{n}")).otherwise(F.col(n)) for n in columns
    }
    return current.join(new, key, "left").withColumns(updated).select(*current.columns)


def audit_rows(
    rows: DataFrame, table: str, order_by: Sequence[str], log: DataFrame | None = None, first: int | None = None
) -> DataFrame:
    """Audit rows as the log declares them, with ids in the given order, which must be unique.

    The ids follow those of ``log``, or begin at ``first``, a key that a ledger has reserved for
    as many rows (see ``sources.ledger``). Without either they begin at the declared start.
    """
    start: int | Column = KEY_START[table] if first is None else first
    if log is not None:
        start = log.agg((F.coalesce(F.max("audit_id"), F.lit(start - 1)) + 1).alias("k")).scalar()
    return conform(assign_keys(rows, order_by, "audit_id", start), declared_schema(table))


def with_age(changes: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Each change with its ``_age``: 1 is the last of its key, the others are superseded by it.

    Of rows that are equal in ``order_by`` the largest is the last; of repeated rows all but one
    are superseded.
    """
    newest = [F.col(n).desc_nulls_last() for n in (*order_by, *changes.columns)]
    return changes.withColumn("_age", F.row_number().over(Window.partitionBy(key).orderBy(*newest)))


def _dealt(current: DataFrame, changes: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Snapshot and batch dealt alike by key to tasks of bounded size, where the batch is large.

    All that follows by this key stays in those tasks; the rows of one key meet in one of them,
    where sorts can spill. A small batch is left as it is, so that it may be broadcast and the
    snapshot is not shuffled.
    """
    if changes.count() <= BROADCAST_ROWS:
        return current, changes
    tasks = tasks_for(current, changes)
    return current.repartition(tasks, key), changes.repartition(tasks, key)


# --- pay ----------------------------------------------------------------------------------


def salary_steps(current: DataFrame, changes: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Each proposed amount with the amount it meets (``old_amount``) and the difference.

    A batch may propose several amounts for one pay row. Cuts are refused, so the amount a
    proposal meets is the largest of the current one and all earlier proposals.
    """
    seen = over_order(changes, order_by, {"_highest": largest_before("new_amount")}, ["salary_id"])
    known = seen.join(current.select("salary_id", "amount"), "salary_id")
    old = F.greatest(F.col("amount"), F.col("_highest"))
    return known.select(
        *changes.columns,
        old.alias("old_amount"),
        (F.col("new_amount") - old).alias("change_amount"),
    )


def guard_no_decrease(
    current: DataFrame,
    changes: DataFrame,
    order_by: Sequence[str],
    as_of: AsOf = None,
    changed_by: str | None = None,
) -> Outcome:
    """Refuse lower amounts, log increases; equal amounts pass without a log row.

    Proposals for unknown pay rows and those without an amount are refused too, so each
    proposal is logged, refused, or equal to what it meets. Refusals carry ``reject_code``.
    """
    steps = salary_steps(current, changes, order_by)
    highest = changes.groupBy("salary_id").agg(F.max("new_amount").alias("_top"))
    amount = F.greatest(F.col("amount"), F.col("_top")).cast(current.schema["amount"].dataType)
    snapshot = (
        current.join(highest, "salary_id", "left")
        .withColumn("amount", amount)
        .select(*current.columns)
    )
    audit = steps.where("change_amount > 0").select(
        "salary_id",
        "old_amount",
        "new_amount",
        "change_amount",
        _user(changed_by).alias("changed_by"),
        day(as_of).alias("changed_date"),
        F.lit(labels.RAISE_REASON).alias("reason"),
    )
    refused = steps.where("change_amount < 0")
    message = joined(
        F.lit(labels.CUT_BLOCKED),
        number_text("old_amount"),
        F.lit(labels.CUT_ATTEMPTED),
        number_text("new_amount"),
        F.lit(labels.CUT_DECREASE),
        number_text(F.abs("change_amount")),
        F.lit(labels.CUT_ADVICE),
    )
    columns = ["salary_id", "old_amount", "new_amount"]
    cuts = refused.select(
        *columns, message.alias("message"), F.lit(labels.CUT_REFUSED).alias("reject_code")
    )
    missing = matching(changes.where("new_amount IS NULL"), current, "salary_id")
    unknown = unknown_keys(current, changes, "salary_id")
    rejected = cuts
    for rows, code in ((missing, AMOUNT_MISSING), (unknown, SALARY_UNKNOWN)):
        rejected = rejected.unionByName(
            rows.select("salary_id", "new_amount", F.lit(code).alias("reject_code")),
            allowMissingColumns=True,
        )
    return Outcome(snapshot, audit, rejected)


def unknown_keys(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Changes for keys that the snapshot does not have."""
    return without(changes, current, key)


def expected_pay(employee: DataFrame, salary_bonus: DataFrame) -> DataFrame:
    """(emp_id, expected): the salary assigned to each employee."""
    return employee.select("emp_id", "salary_id").join(
        salary_bonus.select("salary_id", F.col("amount").alias("expected")), "salary_id"
    ).select("emp_id", "expected")


def check_variance(batch: DataFrame, expected: DataFrame) -> DataFrame:
    """Payroll rows with ``expected`` and ``net_amount`` filled in where a salary is known."""
    known = F.col("expected").isNotNull()
    missing_net = known & F.col("net_amount").isNull()
    net = F.when(
        missing_net, F.col("gross_amount") - F.coalesce(F.col("deductions"), F.lit(0))
    ).otherwise(F.col("net_amount"))
    return batch.join(expected, "emp_id", "left").withColumn(
        "net_amount", net.cast(batch.schema["net_amount"].dataType)
    )


def variance_above(limit: int | str) -> Column:
    """Is the gross amount off the expected pay by more than ``limit`` percent? Exact."""
    gap = F.abs(F.col("gross_amount") - F.col("expected"))
    allowed = F.col("expected") * F.lit(str(limit)).cast("decimal(7,2)")
    return (F.col("expected") > 0) & (gap * 100 > allowed)


def variance_warnings_of(checked: DataFrame, as_of: AsOf = None, limit: int = labels.VARIANCE_LIMIT) -> DataFrame:
    """A warning per row of ``check_variance`` whose gross amount is unusual."""
    variance = ratio(F.abs(F.col("gross_amount") - F.col("expected")) * 100, "expected")
    message = joined(
        F.lit(labels.VARIANCE_TEXT),
        number_text(variance),
        F.lit(labels.VARIANCE_EXPECTED),
        number_text("expected"),
        F.lit(labels.VARIANCE_ACTUAL),
        number_text("gross_amount"),
        F.lit(")"),
    )
    return checked.where(variance_above(limit)).select(
        "payroll_id",
        "emp_id",
        F.lit(labels.VARIANCE_WARNING).alias("audit_type"),
        message.alias("message"),
        day(as_of).alias("audit_date"),
    )


def validate_payroll(
    batch: DataFrame,
    employee: DataFrame,
    salary_bonus: DataFrame,
    as_of: AsOf = None,
    limit: int = labels.VARIANCE_LIMIT,
) -> Outcome:
    """Fill missing net amounts and warn about unusual gross amounts; the payment is kept."""
    checked = check_variance(batch, expected_pay(employee, salary_bonus))
    return Outcome(checked.select(*batch.columns), variance_warnings_of(checked, as_of, limit), None)


def payroll_notices(batch: DataFrame, employee: DataFrame) -> DataFrame:
    """A notice per payroll row; rows of unknown employees give none."""
    names = employee.select("emp_id", full_name().alias("_name"))
    text = joined(
        F.lit(labels.NOTICE_TEXT),
        F.col("_name"),
        F.lit(labels.NOTICE_NET),
        number_text("net_amount"),
    )
    return batch.join(names, "emp_id").select("payroll_id", "emp_id", text.alias("notice"))


def process_payroll(batch: DataFrame) -> DataFrame:
    """Payroll rows from (emp_id, payroll_date, gross_amount, ...) at the processing rate."""
    deductions, net = deduct("gross_amount", labels.PROCESS_RATE)
    return batch.withColumns(
        {
            "deductions": deductions.cast("decimal(12,2)"),
            "net_amount": net.cast("decimal(12,2)"),
            "payment_status": F.lit(labels.PROCESSED),
        }
    )


def bulk_payroll(pay_rows: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Payroll rows for all (emp_id, job_id, salary_id, gross) in one insert."""
    deductions, net = deduct("gross", labels.BULK_RATE)
    return pay_rows.select(
        day(as_of).alias("payroll_date"),
        F.col("gross").alias("gross_amount"),
        deductions.cast("decimal(12,2)").alias("deductions"),
        net.cast("decimal(12,2)").alias("net_amount"),
        "emp_id",
        "job_id",
        "salary_id",
        F.lit(labels.PROCESSED).alias("payment_status"),
    )


# --- employees ------------------------------------------------------------------------------


def archive_deleted(
    current: DataFrame, keys: DataFrame, as_of: AsOf = None, archived_by: str | None = None
) -> Outcome:
    """(remaining employees, archive rows of the deleted ones)."""
    archive = matching(current, keys, "emp_id").withColumns(
        {
            "archived_date": day(as_of),
            "archived_by": _user(archived_by),
            "archive_reason": F.lit(labels.ARCHIVE_REASON),
        }
    )
    return Outcome(without(current, keys, "emp_id"), archive, None)


def update_directory(
    employee: DataFrame, changes: DataFrame, order_by: Sequence[str] = ()
) -> DataFrame:
    """Directory changes reach only the name, e-mail and phone columns; the last one counts."""
    return apply_updates(employee, changes, "emp_id", DIRECTORY_COLUMNS, order_by)


def hire_verdicts(current: DataFrame, batch: DataFrame, order: str) -> DataFrame:
    """Batch rows with the code of the first failed rule, NULL when the row is accepted.

    ``order`` is a unique column; of rows with the same new e-mail the first valid one wins.
    """
    code = (
        F.when(F.col("first_name").isNull() | F.col("last_name").isNull(), labels.NAMES_REQUIRED)
        .when(~F.col("gender").isin("M", "F"), labels.GENDER_INVALID)
        .when((F.col("age") < 18) | (F.col("age") > 75), labels.AGE_INVALID)
    )
    coded = batch.withColumn("_code", code)
    valid = coded.where("_code IS NULL AND email IS NOT NULL")
    first = valid.groupBy("email").agg(F.min(order).alias("_first"))
    used = matching(first, current, "email").select("email", F.lit(True).alias("_used"))
    first = first.join(used, "email", "left")
    taken = F.col("_code").isNull() & (F.col("_used") | (F.col(order) != F.col("_first")))
    return (
        coded.join(first, "email", "left")
        .withColumn("reject_code", F.when(taken, F.lit(EMAIL_EXISTS)).otherwise(F.col("_code")))
        .select(*batch.columns, "reject_code")
    )


def add_employees(
    current: DataFrame,
    batch: DataFrame,
    order: str,
    as_of: AsOf = None,
    first_key: int | Column | None = None,
) -> Outcome:
    """Employees after the hires, the new rows with their ids, and the rejected rows."""
    verdicts = hire_verdicts(current, batch, order)
    if first_key is None:
        first_key = current.agg((F.coalesce(F.max("emp_id"), F.lit(999)) + 1).alias("k")).scalar()
    accepted = verdicts.where("reject_code IS NULL").withColumn("hire_date", day(as_of))
    hired = assign_keys(accepted, [order], "emp_id", first_key)
    hired = hired.select(*[F.col(n) for n in current.columns if n in hired.columns])
    rejected = verdicts.where("reject_code IS NOT NULL")
    return Outcome(current.unionByName(hired, allowMissingColumns=True), hired, rejected)


def add_qualifications(
    batch: DataFrame, employee: DataFrame, as_of: AsOf = None
) -> Outcome:
    """(new qualifications granted today, -, rows of unknown employees)."""
    known = matching(batch, employee, "emp_id").withColumn("grant_date", day(as_of))
    return Outcome(known, None, without(batch, employee, "emp_id"))


# --- leave -----------------------------------------------------------------------------------


def validate_leave(batch: DataFrame) -> Outcome:
    """Reject leaves that end before they start; a missing status becomes PENDING."""
    status = F.coalesce(F.col("status"), F.lit(labels.PENDING))
    valid, rejected = check_rows(
        batch.withColumn("status", status),
        {labels.DATES_INVALID: F.col("leave_start") <= F.col("leave_end")},
    )
    return Outcome(valid, None, rejected)


def status_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Leaves whose status differs between two snapshots."""
    before = old.select("leave_id", F.col("status").alias("old_status"))
    return (
        new.select("leave_id", "emp_id", F.col("status").alias("new_status"))
        .join(before, "leave_id")
        .where(F.col("old_status") != F.col("new_status"))
    )


def decide_leave(
    current: DataFrame, decisions: DataFrame, order_by: Sequence[str] = ()
) -> Outcome:
    """Approve or reject leaves by (leave_id, status, approved_by).

    A NULL status passes the check, as it is not outside the list, and becomes PENDING. Of
    several valid decisions for a leave the last one in ``order_by`` counts (see
    ``with_age``); the others are rejected as superseded. Rejected rows come from one pass over
    the dealt batch, where each decision gets its age and whether its leave is known; those
    without a leave are not dealt, as they would meet in one task.
    """
    allowed = F.coalesce(F.col("status").isin(labels.APPROVED, labels.REJECTED), F.lit(True))
    status = F.coalesce(F.col("status"), F.lit(labels.PENDING))
    nowhere = F.col("leave_id").isNull()
    at_once = F.when(~allowed, labels.STATUS_INVALID).otherwise(LEAVE_UNKNOWN)
    invalid = decisions.where(~allowed | nowhere).withColumns({"status": status, "reject_code": at_once})
    valid = decisions.where(allowed & ~nowhere).withColumn("status", status)
    current, valid = _dealt(current, valid, "leave_id")
    aged = with_age(valid, "leave_id", order_by)
    last = aged.where("_age = 1").drop("_age")
    snapshot = apply_updates(current, last, "leave_id", ["status", "approved_by"])
    code = F.when(~F.col("_known"), LEAVE_UNKNOWN).when(F.col("_age") > 1, SUPERSEDED)
    coded = flag_existing(aged, current, "leave_id", "_known").withColumn("reject_code", code)
    refused = coded.where("reject_code IS NOT NULL").drop("_age", "_known")
    return Outcome(snapshot, None, invalid.unionByName(refused))


def request_leave(batch: DataFrame) -> Outcome:
    """Leave requests from (emp_id, leave_type, leave_start, leave_end, reason).

    The routine refuses a negative length; a length of zero passes it and then fails the
    table's date rule. Both are rejected here with the reason of the stage that refuses.
    """
    asked = batch.withColumns(
        {
            "days": days_between("leave_start", "leave_end") + 1,
            "status": F.lit(labels.PENDING),
        }
    )
    refused = F.coalesce(F.col("days") < 0, F.lit(False))
    text = joined(
        F.lit(labels.LEAVE_SUBMITTED), F.col("days"), F.lit(labels.LEAVE_SUBMITTED_DAYS)
    )
    valid, failed = check_rows(asked.where(~refused), checks_of("leave"))
    rejected = asked.where(refused).withColumn("result", F.lit(labels.LEAVE_END_ERROR))
    failed = failed.drop("failed_rules").withColumn("result", F.lit("ERROR: leave_dates"))
    return Outcome(valid.withColumn("result", text), None, rejected.unionByName(failed))
