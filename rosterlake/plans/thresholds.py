"""Staff selected by a subquery: averages, membership, ALL and ANY."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import mean
from ..operators.joins import matching
from ..operators.sorting import sort_by
from ..operators.subqueries import average_of, greater_than_all, greater_than_any
from ..sources.loading import Tables


def _of_department(t: Tables, department: int) -> DataFrame:
    return t.employees.where(F.col("department_id") == department)


def _paid(df: DataFrame) -> DataFrame:
    return sort_by(df, "-salary", "employee_id").select("first_name", "salary")


def above_average(t: Tables) -> DataFrame:
    return _paid(t.employees.where(F.col("salary") > average_of(t.employees, "salary")))


def departments_in_use(t: Tables) -> DataFrame:
    """Departments whose key is in the set of employees' department keys."""
    found = matching(t.departments, t.employees, "department_id")
    return sort_by(found, "department_name", "department_id").select("department_name")


def departments_with_staff(t: Tables) -> DataFrame:
    """The EXISTS form; one staff row is enough, so distinct keys suffice here too."""
    keys = t.employees.select("department_id").distinct()
    found = t.departments.join(keys, "department_id", "left_semi")
    return sort_by(found, "department_name", "department_id").select("department_name")


def in_shared_departments(t: Tables) -> DataFrame:
    shared = (
        t.employees.where(F.col("department_id").isNotNull())
        .groupBy("department_id")
        .count()
        .where("count > 1")
    )
    return matching(t.employees, shared, "department_id").select(*t.employees.columns)


def with_valid_department(t: Tables) -> DataFrame:
    return matching(t.employees, t.departments, "department_id").select(*t.employees.columns)


def same_salary_as(t: Tables, department: int = 50) -> DataFrame:
    return matching(t.employees, _of_department(t, department), "salary").select(*t.employees.columns)


def above_all_of(t: Tables, department: int = 90) -> DataFrame:
    return _paid(greater_than_all(t.employees, "salary", _of_department(t, department), "salary"))


def above_any_of(t: Tables, department: int = 90) -> DataFrame:
    return _paid(greater_than_any(t.employees, "salary", _of_department(t, department), "salary"))


def above_average_of(t: Tables, department: int = 90) -> DataFrame:
    limit = average_of(_of_department(t, department), "salary")
    return _paid(t.employees.where(F.col("salary") > limit))


def department_statistics(t: Tables, department: int = 90) -> DataFrame:
    return _of_department(t, department).agg(
        F.count("*").alias("employees"),
        F.min("salary").alias("min_salary"),
        mean("salary").alias("avg_salary"),
        F.max("salary").alias("max_salary"),
    )


def company_average(t: Tables) -> DataFrame:
    return t.employees.agg(mean("salary").alias("company_avg"))


def distinct_departments(t: Tables) -> DataFrame:
    return t.employees.where(F.col("department_id").isNotNull()).agg(
        F.count_distinct("department_id").alias("distinct_departments")
    )
