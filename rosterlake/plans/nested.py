"""Reports built from subqueries and chained intermediate results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions.dates import AsOf, day
from ..functions.money import deduct, percent, ratio, wide
from ..functions.text import indent, joined
from ..operators.grouping import with_total
from ..operators.hierarchy import approval_levels
from ..operators.joins import flag_existing, matching, without
from ..operators.ordered import rank_rows
from ..operators.sorting import sort_by
from ..operators.subqueries import average_of
from ..session import small_side
from ..sources.loading import Tables
from .base import (
    all_departments_pay,
    departments,
    paid_staff,
    pay_rows,
    payroll_per_employee,
    staff,
)


def pay_against_department(t: Tables) -> DataFrame:
    """Pay, department average and difference: the correlated average is one group join."""
    mean_pay = F.col("total") / F.nullif("paid", F.lit(0))
    places = all_departments_pay(t).select("job_id", "dept_name", mean_pay.alias("mean_pay"))
    compared = (
        staff(t)
        .join(small_side(places), "job_id")
        .join(pay_rows(t), "salary_id")
        .withColumn("difference_from_avg", F.round(F.col("amount") - F.col("mean_pay"), 2))
    )
    return sort_by(compared, "dept_name", "-difference_from_avg", "emp_id").select(
        "employee_name",
        "dept_name",
        F.col("amount").alias("employee_salary"),
        F.round("mean_pay", 2).alias("dept_avg_salary"),
        "difference_from_avg",
    )


def above_company_average(t: Tables) -> DataFrame:
    average = average_of(t.salary_bonus, "amount")
    high = paid_staff(t).where(F.col("amount") > average)
    return sort_by(high, "-amount", "emp_id").select(
        "emp_id", "employee_name", "dept_name", "amount", F.round(average, 2).alias("company_avg")
    )


def leave_counts(t: Tables) -> DataFrame:
    """Three correlated counts per employee from one conditional aggregate; 0 without leave."""
    per = t.leave.groupBy("emp_id").agg(
        F.count("*").alias("total_leaves"),
        F.count_if(F.col("status") == labels.APPROVED).alias("approved_leaves"),
        F.count_if(F.col("status") == labels.PENDING).alias("pending_leaves"),
    )
    counts = ("total_leaves", "approved_leaves", "pending_leaves")
    counted = (
        staff(t)
        .join(departments(t), "job_id")
        .join(per, "emp_id", "left")
        .withColumns({n: F.coalesce(n, F.lit(0)) for n in counts})
    )
    return sort_by(counted, "-total_leaves", "first_name", "emp_id").select(
        "emp_id", "employee_name", "dept_name", *counts
    )


def existence_flags(t: Tables) -> DataFrame:
    people = staff(t).join(departments(t), "job_id")
    approved = t.leave.where(F.col("status") == labels.APPROVED)
    flagged = flag_existing(people, t.qualification, "emp_id", "_qualified")
    flagged = flag_existing(flagged, approved, "emp_id", "_approved")
    yes_no = {
        "has_qualifications": F.when(F.col("_qualified"), labels.YES).otherwise(labels.NO),
        "has_approved_leave": F.when(F.col("_approved"), labels.YES).otherwise(labels.NO),
    }
    return sort_by(flagged.withColumns(yes_no), "first_name", "emp_id").select(
        "emp_id", "employee_name", "dept_name", *yes_no
    )


def department_share_of_pay(t: Tables) -> DataFrame:
    """Department totals against the total of all pay rows, assigned or not."""
    per = (
        all_departments_pay(t)
        .groupBy("dept_name")
        .agg(
            F.sum("headcount").alias("emp_count"),
            F.sum("total").alias("total_salary"),
            ratio(wide(F.sum("total")), F.sum("paid")).alias("avg_salary"),
        )
    )
    all_pay = t.salary_bonus.agg(F.sum("amount").alias("s")).scalar()
    shared = per.withColumn("pct_of_total", percent("total_salary", all_pay))
    return sort_by(shared, "-total_salary", "dept_name")


def pay_ranks_with_department(t: Tables) -> DataFrame:
    stats = all_departments_pay(t).select(
        "job_id", F.col("headcount").alias("dept_size"), ratio("total", "paid").alias("avg_salary")
    )
    rows = paid_staff(t).select("emp_id", "job_id", "employee_name", "dept_name", "amount")
    ranked = rank_rows(rows, "amount", {"rank": "salary_rank"}, ["dept_name"])
    joined_rows = ranked.join(small_side(stats), "job_id")
    return sort_by(joined_rows, "dept_name", "salary_rank", "emp_id").select(
        "employee_name",
        "dept_name",
        "amount",
        "salary_rank",
        F.round(F.col("amount") - F.col("avg_salary"), 2).alias("variance_from_avg"),
        "dept_size",
    )


def payroll_report(t: Tables) -> DataFrame:
    base = paid_staff(t, "bonus_amount")
    totals = base.join(payroll_per_employee(t), "emp_id", "left")
    return sort_by(totals, "dept_name", "employee_name", "emp_id").select(
        "employee_name",
        "dept_name",
        F.col("amount").alias("base_salary"),
        "bonus_amount",
        F.coalesce("payroll_records", F.lit(0)).alias("payroll_count"),
        "total_gross",
        "total_deductions",
        "total_net",
        percent("total_deductions", "total_gross").alias("deduction_pct"),
    )


def approval_chain(t: Tables, depth: int = 5) -> DataFrame:
    """Who approves for whom, from those who approve nobody, down to ``depth`` levels.

    Rows that the recursive form repeats per path are one row with their number in ``paths``.
    """
    seeds = without(t.employee, t.leave, "emp_id", "approved_by").select(
        F.col("emp_id").alias("node")
    )
    links = matching(t.leave, t.employee, "approved_by", "emp_id").select(
        F.col("emp_id").alias("child"), F.col("approved_by").alias("parent")
    )
    names = staff(t).select(F.col("emp_id").alias("node"), "employee_name")
    walked = approval_levels(seeds, links, depth).join(names, "node")
    role = F.when(F.col("lvl") == 1, labels.CONTRIBUTOR).otherwise(labels.APPROVER)
    return sort_by(walked, "lvl", "employee_name", "node").select(
        joined(indent("lvl"), F.col("employee_name")).alias("hierarchy"),
        role.alias("role"),
        "lvl",
        "paths",
    )


def payroll_of_high_pay(t: Tables, as_of: AsOf = None) -> DataFrame:
    """New payroll rows for employees above the average amount of all pay rows."""
    deductions, net = deduct("amount", labels.INSERT_RATE)
    high = t.employee.select("emp_id", "job_id", "salary_id").join(pay_rows(t), "salary_id").where(
        F.col("amount") > average_of(t.salary_bonus, "amount")
    )
    return high.select(
        day(as_of).alias("payroll_date"),
        F.col("amount").alias("gross_amount"),
        deductions.alias("deductions"),
        net.alias("net_amount"),
        "emp_id",
        "job_id",
        "salary_id",
        F.lit(labels.PROCESSED).alias("payment_status"),
    )


def leave_summary(t: Tables) -> DataFrame:
    per = t.leave.groupBy("emp_id").agg(F.count("*").alias("_n"))
    return staff(t).join(per, "emp_id", "left").select(
        "emp_id", "employee_name", F.coalesce("_n", F.lit(0)).alias("leaves")
    )


def share_of_all(t: Tables) -> DataFrame:
    """Each department's share of the gross payroll, as a window over an aggregate."""
    per = t.payroll.groupBy("job_id").agg(F.sum("gross_amount").alias("gross"))
    return with_total(per, "gross", "company_gross")
