"""Audit counts, job-log reports and the payroll run."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions.dates import AsOf, add_months, day, month_start
from ..functions.money import percent, ratio
from ..operators.changes import (
    audit_rows,
    check_variance,
    expected_pay,
    process_payroll,
    variance_above,
    variance_warnings_of,
)
from ..operators.joins import without
from ..operators.sorting import top
from ..sources.loading import Tables, row_count_inventory
from .runs import Run
from .views import monthly_payroll, refresh


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def missing_payroll(t: Tables, as_of: AsOf = None) -> DataFrame:
    """Employees without a payroll row in the month of the report date."""
    first = month_start(day(as_of))
    paid = t.payroll.where(
        (F.col("payroll_date") >= first) & (F.col("payroll_date") < F.add_months(first, 1))
    )
    return without(t.employee, paid, "emp_id").agg(
        F.count_distinct("emp_id").alias("missing_payroll")
    )


def unusual_payroll(t: Tables, as_of: AsOf = None, limit: int = labels.AUDIT_LIMIT) -> DataFrame:
    """Payroll rows of the day that differ from the assigned pay by more than the limit."""
    # the rows of one day are joined step by step: they are few against the joined tables
    today = t.payroll.where(F.col("payroll_date") == day(as_of)).select("emp_id", "gross_amount")
    checked = today.join(t.employee.select("emp_id", "salary_id"), "emp_id").join(
        t.salary_bonus.select("salary_id", F.col("amount").alias("expected")), "salary_id"
    )
    return _count(checked.where(variance_above(limit)), "variance_warnings")


def figures(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """How many rows meet each condition, from one scan that reads rows of any of them only."""
    return df.where(reduce(or_, conditions.values())).agg(
        *[F.count_if(condition).alias(name) for name, condition in conditions.items()]
    )


def _upcoming(as_of: AsOf, days: int) -> Column:
    start = F.col("leave_start")
    return _approved_from(as_of) & (start < F.date_add(day(as_of), days))


def _approved_from(as_of: AsOf) -> Column:
    return (F.col("status") == labels.APPROVED) & (F.col("leave_start") >= day(as_of))


def _overdue(as_of: AsOf) -> Column:
    return (F.col("status") == labels.PENDING) & (F.col("leave_start") <= day(as_of))


def _old_rejected(as_of: AsOf, months: int) -> Column:
    return (F.col("status") == labels.REJECTED) & (F.col("leave_start") < add_months(day(as_of), -months))


def leave_figures(t: Tables, as_of: AsOf = None, days: int = 7, months: int = 6) -> DataFrame:
    """The four counters of leaves in one row and one scan: approved for the next days, overdue,
    rejected long ago, approved from now on."""
    return figures(
        t.leave,
        {
            "approved_leaves": _upcoming(as_of, days),
            "pending_leaves": _overdue(as_of),
            "rejected_leaves": _old_rejected(as_of, months),
            "upcoming_approved": _approved_from(as_of),
        },
    )


def upcoming_leave(t: Tables, as_of: AsOf = None, days: int = 7) -> DataFrame:
    return _count(t.leave.where(_upcoming(as_of, days)), "approved_leaves")


def overdue_leave(t: Tables, as_of: AsOf = None) -> DataFrame:
    return _count(t.leave.where(_overdue(as_of)), "pending_leaves")


def old_rejected_leave(t: Tables, as_of: AsOf = None, months: int = 6) -> DataFrame:
    return _count(t.leave.where(_old_rejected(as_of, months)), "rejected_leaves")


def variance_warnings(payroll_audit: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _count(
        payroll_audit.where(
            (F.col("audit_date") == day(as_of)) & (F.col("audit_type") == labels.VARIANCE_WARNING)
        ),
        "validation_errors",
    )


def approved_from(t: Tables, as_of: AsOf = None) -> DataFrame:
    return _count(t.leave.where(_approved_from(as_of)), "upcoming_approved")


def daily_audit(t: Tables, as_of: AsOf = None) -> DataFrame:
    """Both daily counters and the job status that follows from them."""
    missing = missing_payroll(t, as_of).scalar()
    warnings = unusual_payroll(t, as_of).scalar()
    status = (
        F.when((F.col("missing") == 0) & (F.col("warnings") == 0), labels.SUCCESS)
        .when(F.col("missing") > 0, labels.FAILED)
        .otherwise(labels.WARNING)
    )
    return (
        t.employee.sparkSession.range(1)
        .select(missing.alias("missing"), warnings.alias("warnings"))
        .withColumns({"status": status, "records_affected": F.col("missing") + F.col("warnings")})
    )


# --- job log --------------------------------------------------------------------------------


def recent_executions(log: DataFrame, n: int = 10) -> DataFrame:
    return top(log, n, "-execution_start", "-log_id").select(
        "job_name", "status", "records_affected", "execution_time_sec"
    )


def _hits(status: str):
    return F.sum(F.when(F.col("status") == status, 1).otherwise(0))


def execution_summary(log: DataFrame) -> DataFrame:
    seconds = F.col("execution_time_sec")
    return log.agg(
        F.count("*").alias("total_executions"),
        _hits(labels.SUCCESS).alias("successful"),
        _hits(labels.FAILED).alias("failed"),
        _hits(labels.WARNING).alias("warnings"),
        ratio(F.sum(seconds), F.count(seconds)).alias("avg_execution_time"),
    )


def success_rate(log: DataFrame) -> DataFrame:
    return log.agg(percent(_hits(labels.SUCCESS), F.count("*")).alias("success_rate"))


def audit_counts(
    salary_audit: DataFrame, payroll_audit: DataFrame, archive: DataFrame
) -> DataFrame:
    return row_count_inventory(
        {
            labels.SALARY_CHANGES: salary_audit,
            labels.PAYROLL_ISSUES: payroll_audit,
            labels.ARCHIVED_EMPLOYEES: archive,
        },
        label="audit_type",
    )


# --- payroll run ----------------------------------------------------------------------------


class PayrollRun(NamedTuple):
    processed: DataFrame
    audit: DataFrame
    checks: DataFrame
    report: DataFrame
    steps: DataFrame


def payroll_run(t: Tables, batch: DataFrame, as_of: AsOf, base: str, run_id: str | None = None) -> PayrollRun:
    """Validate, process, audit, report: the four steps of the payroll chain in order.

    ``batch`` has payroll columns; the processed rows join the snapshot that the audit and
    the refreshed monthly report below ``base`` read. Every step is stored once under ``run_id``;
    the validated rows are read by the two steps after them. A run that is called again by its
    name goes on behind its last finished step.
    """
    run = Run(batch.sparkSession, f"{base}-runs", run_id)
    validated = run.step("validated", lambda: check_variance(batch, expected_pay(t.employee, t.salary_bonus)))
    processed = run.step("processed", lambda: process_payroll(validated.select(*batch.columns)))
    audit = run.step("audit", lambda: audit_rows(variance_warnings_of(validated, as_of), "payroll_audit", ["payroll_id"]))
    after = t.replacing(payroll=t.payroll.unionByName(processed.select(*t.payroll.columns)))
    checks = run.step("checks", lambda: daily_audit(after, as_of))
    report = run.step("report", lambda: refresh(monthly_payroll(after, as_of), base, ("payroll_month",)))
    return PayrollRun(processed, audit, checks, report, run.steps())
