"""Matched and unmatched staff, pay, leave and qualification rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions.dates import AsOf, day, month_boundaries
from ..functions.money import ratio, wide
from ..functions.text import full_name, joined, name_or
from ..operators.grouping import with_total
from ..operators.joins import full_outer_to_many, outer_to_many, without
from ..operators.sorting import sort_by
from ..sources.loading import Tables
from .base import departments, paid_staff, pay_rows, payroll_per_employee, staff


def staff_with_department(t: Tables) -> DataFrame:
    matched = staff(t).join(departments(t, "salary_range"), "job_id")
    return sort_by(matched, "dept_name", "first_name", "emp_id").select(
        "emp_id", "employee_name", "gender", "dept_name", "salary_range"
    )


def departments_with_example(t: Tables, default: str = labels.NO_STAFF) -> DataFrame:
    """Employees per department and name; a department without staff has one row with 0."""
    per = t.employee.groupBy(
        F.col("job_id").alias("emp_job_id"), "first_name", "last_name"
    ).agg(F.count("emp_id").alias("n"))
    kept = outer_to_many(departments(t, "dept_description"), per, "job_id", "emp_job_id")
    return sort_by(kept, "dept_name", "job_id", "first_name", "last_name").select(
        "job_id",
        "dept_name",
        "dept_description",
        F.coalesce("n", F.lit(0)).alias("employee_count"),
        name_or("n", default, "first_name", "last_name").alias("example_employee"),
    )


def pay_rows_of_staff(t: Tables, default: str = labels.NO_STAFF_ASSIGNED) -> DataFrame:
    """All employees with their pay row, if any, counted per pay row, department and name.

    The employee is the kept side, so the rows are those of a left join from it.
    """
    pay = t.salary_bonus.select(
        F.col("salary_id").alias("pay_id"), "amount", "bonus_amount"
    )
    kept = t.employee.join(pay, F.col("salary_id") == F.col("pay_id"), "left").join(
        departments(t), "job_id", "left"
    )
    grouped = kept.groupBy(
        "pay_id", "amount", "bonus_amount", "dept_name", "first_name", "last_name"
    ).agg(F.count("emp_id").alias("employees_with_this_salary"))
    label = name_or(F.nullif("employees_with_this_salary", F.lit(0)), default, "first_name", "last_name")
    return sort_by(grouped, "-amount", "pay_id", "dept_name", "first_name", "last_name").select(
        F.col("pay_id").alias("salary_id"),
        "amount",
        "bonus_amount",
        "dept_name",
        "employees_with_this_salary",
        label.alias("example_employee"),
    )


def staff_and_leave(t: Tables) -> DataFrame:
    """Every employee and every leave, matched where possible."""
    people = staff(t).join(departments(t), "job_id", "left").select(
        "emp_id", "employee_name", "dept_name"
    )
    leaves = t.leave.select(
        F.col("emp_id").alias("leave_emp_id"), "leave_id", "leave_type", "leave_start"
    )
    full = full_outer_to_many(people, leaves, "emp_id", "leave_emp_id").select(
        F.coalesce("emp_id", "leave_emp_id").alias("emp_id"),
        F.when(F.col("emp_id").isNull(), F.lit(labels.ORPHANED_LEAVE))
        .otherwise(F.col("employee_name"))
        .alias("employee_name"),
        F.coalesce("dept_name", F.lit(labels.UNASSIGNED)).alias("department"),
        F.coalesce("leave_id", F.lit(0)).alias("recent_leave_count"),
        F.coalesce("leave_type", F.lit(labels.NO_LEAVE_TYPE)).alias("leave_type"),
        F.coalesce(F.date_format("leave_start", "yyyy-MM-dd"), F.lit(labels.NEVER)).alias(
            "last_leave_start"
        ),
    )
    return sort_by(full, "emp_id", "recent_leave_count")


def staff_pay_totals(t: Tables) -> DataFrame:
    """Pay and payroll totals per employee; payroll is totalled before the join."""
    joined_rows = paid_staff(t, "bonus_amount").join(payroll_per_employee(t), "emp_id", "left")
    return sort_by(joined_rows, "dept_name", "first_name", "emp_id").select(
        "emp_id",
        "employee_name",
        "gender",
        "age",
        "dept_name",
        F.col("amount").alias("monthly_salary"),
        "bonus_amount",
        F.coalesce("payroll_records", F.lit(0)).alias("payroll_records"),
        F.col("total_gross").alias("total_gross_paid"),
        "total_deductions",
        F.col("total_net").alias("total_net_paid"),
    )


def department_payroll(t: Tables, per_payroll_row: bool = True) -> DataFrame:
    """Pay statistics and net payroll per department.

    The catalogued query averages pay over the employee x payroll rows of its join, so an
    employee counts once per payroll row (once without any). ``per_payroll_row=False`` gives
    the average over employees. Both come from one row per employee.
    """
    weight = F.greatest(F.coalesce(F.col("payroll_records"), F.lit(0)), F.lit(1))
    people = (
        t.employee.select("emp_id", "job_id", "salary_id")
        .join(pay_rows(t).withColumnRenamed("salary_id", "pay_id"), F.col("salary_id") == F.col("pay_id"), "left")
        .join(payroll_per_employee(t), "emp_id", "left")
        .withColumn("weight", weight if per_payroll_row else F.lit(1).cast("bigint"))
    )
    per = people.groupBy("job_id").agg(
        F.count("emp_id").alias("headcount"),  # one row per employee
        F.count_distinct("pay_id").alias("distinct_salary_levels"),
        F.sum(F.col("amount") * F.col("weight")).alias("weighted"),
        F.sum(F.when(F.col("amount").isNotNull(), F.col("weight"))).alias("weights"),
        F.min("amount").alias("min_salary"),
        F.max("amount").alias("max_salary"),
        F.sum("total_net").alias("net"),
    )
    kept = departments(t, "salary_range").join(per, "job_id", "left")
    totalled = with_total(kept, "net", "dept_net_payroll", ["dept_name"])
    return sort_by(totalled, "-dept_net_payroll", "job_id").select(
        "dept_name",
        "salary_range",
        F.coalesce("headcount", F.lit(0)).alias("headcount"),
        F.coalesce("distinct_salary_levels", F.lit(0)).alias("distinct_salary_levels"),
        ratio(wide("weighted"), "weights").alias("avg_salary"),
        "min_salary",
        "max_salary",
        "dept_net_payroll",
    )


def leave_approvers(t: Tables) -> DataFrame:
    requester = staff(t).select("emp_id", F.col("employee_name").alias("employee_requesting"))
    approver = staff(t).select(
        F.col("emp_id").alias("mgr_id"), F.col("employee_name").alias("approving_manager")
    )
    found = (
        t.leave.join(requester, "emp_id")
        .join(approver, F.col("approved_by") == F.col("mgr_id"))
        .select(
            "leave_id",
            "employee_requesting",
            F.col("emp_id").alias("emp_requesting"),
            "approving_manager",
            "mgr_id",
            "leave_type",
            "leave_start",
            "status",
        )
        .distinct()
    )
    return sort_by(found, "status", "-leave_start", "leave_id")


def staff_qualifications(t: Tables, as_of: AsOf = None) -> DataFrame:
    people = staff(t).join(departments(t), "job_id").select(
        "emp_id", "employee_name", "first_name", "dept_name"
    )
    earned = t.qualification.withColumnRenamed("emp_id", "qual_emp_id")
    kept = outer_to_many(people, earned, "emp_id", "qual_emp_id")
    return sort_by(kept, "dept_name", "first_name", "emp_id", "-grant_date", "qual_id").select(
        "emp_id",
        "employee_name",
        "dept_name",
        "qual_title",
        "qual_type",
        F.date_format("grant_date", "yyyy-MM-dd").alias("grant_date"),
        month_boundaries("grant_date", day(as_of)).alias("months_since_certification"),
    )


def department_pay_pairs(t: Tables) -> DataFrame:
    """Department and pay row pairs that belong together, with a combined label.

    The catalogued query pairs every department with every pay row; an all-pairs result is
    not built here, so the pairs are those linked by the department key.
    """
    pairs = departments(t).join(
        t.salary_bonus.select("salary_id", "amount", "bonus_amount", "job_id"), "job_id"
    )
    label = joined(
        F.lit(labels.PAIR_PREFIX), F.col("job_id"), F.lit("-"), F.col("salary_id")
    )
    return sort_by(pairs, "dept_name", "-amount", "salary_id").select(
        "dept_name", F.col("amount").alias("monthly_salary"), "bonus_amount", label.alias("combination_id")
    )


def staff_without_leave(t: Tables) -> DataFrame:
    idle = without(staff(t).join(departments(t), "job_id"), t.leave, "emp_id")
    return sort_by(idle, "hire_date", "emp_id").select(
        "emp_id",
        "employee_name",
        "dept_name",
        "hire_date",
        F.lit(labels.NO_LEAVE).alias("status"),
    )


def staff_without_qualification(t: Tables) -> DataFrame:
    plain = without(staff(t).join(departments(t), "job_id"), t.qualification, "emp_id")
    return sort_by(plain, "first_name", "emp_id").select(
        "emp_id", "employee_name", "dept_name", F.lit(labels.NO_QUALIFICATION).alias("qual_status")
    )


def assignment_counts(t: Tables) -> DataFrame:
    """Employees with and without a pay row and a department, in one pass over employees."""
    pay = t.salary_bonus.select(F.col("salary_id").alias("pay_id"))
    dept = t.job_department.select(F.col("job_id").alias("dept_id"))
    flagged = t.employee.join(pay, F.col("salary_id") == F.col("pay_id"), "left").join(
        dept, F.col("job_id") == F.col("dept_id"), "left"
    )
    return flagged.agg(
        F.count("pay_id").alias("with_salary"),
        F.count_if(F.col("salary_id").isNull()).alias("without_salary"),
        F.count("dept_id").alias("with_department"),
        F.count_if(F.col("job_id").isNull()).alias("without_department"),
    )


def approver_names(t: Tables) -> DataFrame:
    """(mgr_id, approver) of all employees, for leave views."""
    return t.employee.select(F.col("emp_id").alias("mgr_id"), full_name().alias("approver"))
