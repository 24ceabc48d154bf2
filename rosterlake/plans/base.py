"""Joins shared by the payroll reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import full_name
from ..sources.loading import Tables


def departments(t: Tables, *extra: str) -> DataFrame:
    return t.job_department.select("job_id", "dept_name", *extra)


def pay_rows(t: Tables, *extra: str) -> DataFrame:
    return t.salary_bonus.select("salary_id", "amount", *extra)


def staff(t: Tables) -> DataFrame:
    return t.employee.withColumn("employee_name", full_name())


def paid_staff(t: Tables, *extra: str) -> DataFrame:
    """Employees with a department and a pay row."""
    return staff(t).join(departments(t), "job_id").join(pay_rows(t, *extra), "salary_id")


def department_pay(t: Tables) -> DataFrame:
    """Per department key: head count and count, sum, min and max of the assigned pay.

    The grain that all department reports share; averages come from sum and count.
    """
    return (
        t.employee.join(pay_rows(t), "salary_id", "left")
        .groupBy("job_id")
        .agg(
            F.count("emp_id").alias("headcount"),
            F.count("amount").alias("paid"),
            F.sum("amount").alias("total"),
            F.min("amount").alias("low"),
            F.max("amount").alias("high"),
        )
    )


def all_departments_pay(t: Tables, *extra: str) -> DataFrame:
    """Every department with its pay figures; an empty one has a count of 0 and NULL figures."""
    joined = departments(t, *extra).join(department_pay(t), "job_id", "left")
    return joined.withColumns(
        {n: F.coalesce(n, F.lit(0)) for n in ("headcount", "paid")}
    )


def payroll_per_employee(t: Tables) -> DataFrame:
    return t.payroll.groupBy("emp_id").agg(
        F.count("payroll_id").alias("payroll_records"),
        F.sum("gross_amount").alias("total_gross"),
        F.sum("deductions").alias("total_deductions"),
        F.sum("net_amount").alias("total_net"),
    )
