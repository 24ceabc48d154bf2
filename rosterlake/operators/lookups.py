"""Figures for keys that are asked for; the routines' one-row functions as joins.

``asked`` is a table with the key column; keys may repeat and may be unknown. Every asked row
gives one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions.dates import AsOf, day, days_between
from ..functions.money import bonus_of, net_of_bonus, net_of_total
from ..functions.text import full_name
from .changes import Outcome

UNKNOWN_NAME = "Unknown"


def _found(asked: DataFrame, key: str, table: DataFrame, value: Column, default) -> DataFrame:
    """(key, value): the table's value, which may be NULL, or the default for unknown keys."""
    known = table.select(F.col(key), value.alias("_value"), F.lit(True).alias("_known"))
    chosen = F.when(F.col("_known"), F.col("_value")).otherwise(F.lit(default))
    return asked.select(key).join(known, key, "left").select(key, chosen.alias("value"))


def _with_pay(employee: DataFrame, salary_bonus: DataFrame) -> DataFrame:
    pay = salary_bonus.select("salary_id", "amount", "bonus_amount")
    return employee.select("emp_id", "salary_id").join(pay, "salary_id")


def net_salary(asked: DataFrame, employee: DataFrame, salary_bonus: DataFrame) -> Outcome:
    """(emp_id, net) of employees with a pay row; the others are rejected with a code."""
    pay = _with_pay(employee, salary_bonus)
    net = net_of_total("amount", "bonus_amount")
    known = pay.select("emp_id", net.alias("net"), F.lit(True).alias("_known"))
    joined = asked.select("emp_id").join(known, "emp_id", "left")
    rejected = joined.where("_known IS NULL").select("emp_id", F.lit(labels.SALARY_MISSING).alias("reject_code"))
    return Outcome(joined.where("_known").select("emp_id", "net"), None, rejected)


def net_salary_pkg(asked: DataFrame, employee: DataFrame, salary_bonus: DataFrame) -> DataFrame:
    """(emp_id, net) by the variant's formula; 0 without a pay row."""
    pay = _with_pay(employee, salary_bonus)
    return _found(asked, "emp_id", pay, net_of_bonus("amount", "bonus_amount"), 0).withColumnRenamed("value", "net")


def days_employed(asked: DataFrame, employee: DataFrame, as_of: AsOf = None) -> DataFrame:
    """(emp_id, days) since the hire date; 0 for unknown employees."""
    days = days_between("hire_date", day(as_of)).cast("bigint")
    return _found(asked, "emp_id", employee, days, 0).withColumnRenamed("value", "days")


def dept_headcount(asked: DataFrame, employee: DataFrame) -> DataFrame:
    """(job_id, headcount): employees per asked department, counted before the join."""
    per = employee.groupBy("job_id").agg(F.count("*").alias("n"))
    return _found(asked, "job_id", per, F.col("n"), 0).withColumnRenamed("value", "headcount")


def employee_name(asked: DataFrame, employee: DataFrame) -> DataFrame:
    """(emp_id, employee_name), with a fixed text for unknown employees."""
    found = _found(asked, "emp_id", employee, full_name(), UNKNOWN_NAME)
    return found.withColumnRenamed("value", "employee_name")


def bonus(asked: DataFrame, salary_bonus: DataFrame, multiplier: str = "1") -> DataFrame:
    """(salary_id, bonus) times a factor; 0 for unknown pay rows."""
    found = _found(asked, "salary_id", salary_bonus, bonus_of("bonus_amount", multiplier), 0)
    return found.withColumnRenamed("value", "bonus")
