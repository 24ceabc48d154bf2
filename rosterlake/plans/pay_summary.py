"""Grouped, multi-level and ordered pay reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions.dates import leave_days
from ..functions.money import mean, ratio, wide
from ..operators.grouping import margin, with_share
from ..operators.joins import matching
from ..operators.ordered import (
    following,
    moving_mean,
    over_order,
    position,
    previous,
    rank_rows,
    running_sum,
    top_ranked,
)
from ..operators.sorting import sort_by
from ..sources.loading import Tables
from .base import all_departments_pay, departments, paid_staff, pay_rows, staff


def salary_budget(t: Tables) -> DataFrame:
    report = all_departments_pay(t).select(
        "job_id",
        "dept_name",
        F.col("headcount").alias("employee_count"),
        F.col("total").alias("total_salary"),
        ratio("total", "paid").alias("avg_salary"),
        F.col("low").alias("min_salary"),
        F.col("high").alias("max_salary"),
    )
    return sort_by(report, "-total_salary", "job_id").drop("job_id")


def budget_with_total(t: Tables) -> DataFrame:
    """Department rows and a grand total; the detail is aggregated before the ROLLUP."""
    return sort_by(
        all_departments_pay(t)
        .rollup("dept_name")
        .agg(
            F.sum("headcount").alias("headcount"),
            F.sum("total").alias("salary_budget"),
            ratio(wide(F.sum("total")), F.sum("paid")).alias("avg_salary"),
            margin("dept_name", labels.GRAND_TOTAL).alias("department"),
            F.when(F.grouping("dept_name") == 1, labels.COMPANY_LEVEL)
            .otherwise(labels.DEPARTMENT_LEVEL)
            .alias("level_type"),
        )
        .select("department", "headcount", "salary_budget", "avg_salary", "level_type"),
        "department",
    )


def pay_by_department_and_gender(t: Tables) -> DataFrame:
    """All margins of department and gender. The CUBE works on one row per combination."""
    detail = (
        t.employee.join(pay_rows(t), "salary_id", "left")
        .groupBy("job_id", "gender")
        .agg(
            F.count("emp_id").alias("n"),
            F.count("amount").alias("paid"),
            F.sum("amount").alias("total"),
        )
    )
    cubed = (
        departments(t)
        .join(detail, "job_id", "left")
        .cube("dept_name", "gender")
        .agg(
            margin("dept_name", labels.ALL_DEPARTMENTS).alias("department"),
            margin("gender", labels.ALL_GENDERS).alias("gender_label"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("employee_count"),
            F.sum("total").alias("total_salary"),
            ratio(wide(F.sum("total")), F.sum("paid")).alias("avg_salary"),
        )
    )
    return sort_by(cubed, "department", "gender_label").select(
        "department", F.col("gender_label").alias("gender"), "employee_count", "total_salary", "avg_salary"
    )


def department_pay_ranks(t: Tables) -> DataFrame:
    rows = paid_staff(t).select("emp_id", "dept_name", "employee_name", "amount")
    ranked = rank_rows(
        rows,
        "amount",
        {"dense_rank": "salary_rank"},
        ["dept_name"],
        share="pct_of_dept_salary",
    )
    return sort_by(ranked, "dept_name", "salary_rank", "emp_id").select(
        "dept_name", "employee_name", "amount", "salary_rank", "pct_of_dept_salary"
    )


def top_paid(t: Tables, k: int = 5) -> DataFrame:
    """Staff with one of the k largest amounts, numbered and ranked with and without gaps."""
    rows = paid_staff(t).select("emp_id", "employee_name", "dept_name", "amount")
    best = top_ranked(rows, "amount", k, {"rank": "rank_no", "dense_rank": "dense_rank_no"})
    numbered = over_order(best, ["-amount", "emp_id"], {"row_num": position()})
    return sort_by(numbered, "row_num").select(
        "employee_name", "dept_name", "amount", "row_num", "rank_no", "dense_rank_no"
    )


def pay_gaps(t: Tables) -> DataFrame:
    rows = paid_staff(t).select("emp_id", "employee_name", "dept_name", "amount")
    placed = over_order(
        rows,
        ["-amount", "emp_id"],
        {"prev_higher": previous("amount"), "next_lower": following("amount")},
    )
    return sort_by(placed, "-amount", "emp_id").select(
        "emp_id",
        "employee_name",
        "dept_name",
        "amount",
        "prev_higher",
        "next_lower",
        (F.col("amount") - F.col("prev_higher")).alias("gap_from_higher"),
        (F.col("next_lower") - F.col("amount")).alias("gap_to_lower"),
    )


def pay_running_totals(t: Tables) -> DataFrame:
    rows = staff(t).join(pay_rows(t), "salary_id").select("emp_id", "employee_name", "amount")
    framed = over_order(
        rows,
        ["-amount", "emp_id"],
        {
            "running_total": running_sum("amount"),
            "moving_avg": moving_mean("amount", 2, 2),
            "cumulative_count": position(),
        },
    )
    return sort_by(framed, "cumulative_count")


def payroll_expense(t: Tables) -> DataFrame:
    """Payroll totals per department with the share of the company total.

    Payroll is aggregated by its department key before the department is joined, so the
    join sees one row per department, whatever the size of payroll.
    """
    per = t.payroll.groupBy("job_id").agg(
        F.count_distinct("emp_id").alias("employees_paid"),
        F.count("payroll_id").alias("payroll_records"),
        F.sum("gross_amount").alias("total_gross"),
        F.sum("deductions").alias("total_deductions"),
        F.sum("net_amount").alias("total_net"),
        mean("net_amount").alias("avg_net_payment"),
    )
    named = per.join(departments(t), "job_id")
    shared = with_share(named, "total_gross", "pct_of_total_payroll")
    return sort_by(shared, "-total_gross", "job_id").select(
        "dept_name",
        "employees_paid",
        "payroll_records",
        "total_gross",
        "total_deductions",
        "total_net",
        "pct_of_total_payroll",
        "avg_net_payment",
    )


def leave_by_department_and_type(t: Tables) -> DataFrame:
    """Leave counts and lengths per department and type, with subtotals and a total.

    First one row per department, type and employee, then the ROLLUP: the distinct count of
    employees needs no finer grain.
    """
    places = t.employee.select("emp_id", "job_id").join(departments(t), "job_id")
    days = leave_days("leave_start", "leave_end", inclusive=False, when_open=0)
    per = (
        t.leave.groupBy("emp_id", "leave_type")
        .agg(F.count("*").alias("n"), F.sum(days).alias("days"))
        .join(places, "emp_id")
    )
    rolled = per.rollup("dept_name", "leave_type").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("n").alias("leave_count"),
        F.count_distinct("emp_id").alias("employees_on_leave"),
        F.round(F.sum("days").cast("decimal(20,0)") / F.sum("n"), 1).alias("avg_duration_days"),
    )
    return sort_by(rolled, "dept_name", "leave_type", "level")


def qualification_spread(t: Tables) -> DataFrame:
    """Qualifications per department and type, combined per employee before the join."""
    places = t.employee.select("emp_id", "job_id").join(departments(t), "job_id")
    per = t.qualification.groupBy("emp_id", "qual_type").agg(F.count("*").alias("n"))
    spread = (
        per.join(places, "emp_id")
        .groupBy("dept_name", "qual_type")
        .agg(
            F.sum("n").alias("qualifications"),
            F.count_distinct("emp_id").alias("unique_employees"),
        )
    )
    return sort_by(spread, "dept_name", "qual_type")


def key_metrics(t: Tables) -> DataFrame:
    """Company totals. Pay and payroll are totalled apart, so neither multiplies the other."""
    pay = (
        t.employee.select("emp_id", "salary_id")
        .join(pay_rows(t), "salary_id")
        .select("emp_id", "amount")
    )
    totals = t.payroll.agg(
        F.struct(
            F.sum("gross_amount").alias("gross"), F.sum("deductions").alias("deductions")
        ).alias("totals")
    ).scalar()
    return pay.agg(
        F.count("emp_id").alias("total_employees"),  # one row per employee
        F.sum("amount").alias("total_salary"),
        mean("amount").alias("avg_salary"),
        F.max("amount").alias("max_salary"),
    ).withColumns({"total_payroll": totals["gross"], "total_deductions": totals["deductions"]})


def top_paid_per_department(t: Tables, k: int = 5) -> DataFrame:
    """Staff ranked 1 to k by pay within the department, ties included."""
    rows = (
        staff(t)
        .join(pay_rows(t), "salary_id")
        .where(F.col("job_id").isNotNull())
        .select("job_id", "emp_id", "employee_name", "amount")
    )
    known = matching(rows, t.job_department, "job_id")
    best = top_ranked(known, "amount", k, {"rank": "rank_no"}, ["job_id"], by="rank")
    return sort_by(best, "job_id", "rank_no", "emp_id").select(
        "job_id", "emp_id", "employee_name", "amount", "rank_no"
    )
