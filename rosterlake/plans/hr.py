"""Staff directory reports over employees, departments, jobs and places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions.text import full_name, money_text, name_or
from ..operators.joins import outer_to_many, without
from ..operators.sorting import sort_by
from ..sources.loading import Tables, row_count_inventory


def _staff(t: Tables) -> DataFrame:
    return t.employees.withColumn("full_name", full_name())


def _managers(t: Tables) -> DataFrame:
    return t.employees.select(
        F.col("employee_id").alias("mgr_id"),
        full_name().alias("manager"),
        F.col("last_name").alias("mgr_last_name"),
        F.col("salary").alias("mgr_salary"),
        F.col("department_id").alias("mgr_department_id"),
    )


def _sites(t: Tables) -> DataFrame:
    """Departments with city and country; joined first, so that staff is joined once."""
    return (
        t.departments.select("department_id", "department_name", "location_id")
        .join(t.locations, "location_id")
        .join(t.countries, "country_id")
    )


def table_counts(t: Tables) -> DataFrame:
    names = ("employees", "departments", "jobs", "locations", "countries", "regions")
    return row_count_inventory({n.upper(): t[n] for n in names})


def employee_departments(t: Tables) -> DataFrame:
    joined = _staff(t).join(t.departments.select("department_id", "department_name"), "department_id")
    return sort_by(joined.select("employee_id", "full_name", "department_name"), "employee_id")


def salary_report(t: Tables) -> DataFrame:
    joined = sort_by(_staff(t).join(t.jobs, "job_id"), "-salary", "employee_id")
    return joined.select("full_name", "job_title", money_text("salary").alias("salary_text"))


def employee_cities(t: Tables) -> DataFrame:
    sites = t.departments.select("department_id", "department_name", "location_id").join(
        t.locations, "location_id"
    )
    joined = sort_by(_staff(t).join(sites, "department_id"), "city", "department_name", "employee_id")
    return joined.select("full_name", "department_name", "city")


def employee_regions(t: Tables) -> DataFrame:
    sites = _sites(t).join(t.regions, "region_id")
    joined = _staff(t).join(sites, "department_id")
    return sort_by(joined, "region_name", "country_name", "employee_id").select(
        "full_name", "department_name", "country_name", "region_name"
    )


def employees_or_no_department(t: Tables, default: str = labels.NO_DEPARTMENT_ASSIGNED) -> DataFrame:
    joined = _staff(t).join(
        t.departments.select("department_id", "department_name"), "department_id", "left"
    )
    return sort_by(joined, "department_name", "last_name", "employee_id").select(
        "employee_id",
        "full_name",
        F.coalesce("department_name", F.lit(default)).alias("department"),
    )


def department_headcount(t: Tables) -> DataFrame:
    per = t.employees.groupBy("department_id").agg(F.count("employee_id").alias("_n"))
    counted = t.departments.join(per, "department_id", "left").select(
        "department_id",
        "department_name",
        F.coalesce("_n", F.lit(0)).alias("employee_count"),
    )
    return sort_by(counted, "-employee_count", "department_id")


def empty_departments(t: Tables) -> DataFrame:
    empty = without(t.departments, t.employees, "department_id")
    placed = empty.join(t.locations.select("location_id", "city"), "location_id", "left")
    return sort_by(
        placed.select("department_id", "department_name", "city"), "department_name", "department_id"
    )


def employee_managers(t: Tables) -> DataFrame:
    joined = _staff(t).join(_managers(t), F.col("manager_id") == F.col("mgr_id"))
    return sort_by(joined, "mgr_last_name", "last_name", "employee_id").select(
        "full_name", "manager"
    )


def top_of_hierarchy(t: Tables) -> DataFrame:
    return (
        _staff(t)
        .where(F.col("manager_id").isNull())
        .select(
            "employee_id",
            "full_name",
            "job_id",
            F.lit(labels.TOP_REASON).alias("reason"),
        )
    )


def earning_more_than_manager(t: Tables) -> DataFrame:
    joined = _staff(t).join(
        _managers(t),
        (F.col("manager_id") == F.col("mgr_id")) & (F.col("salary") > F.col("mgr_salary")),
    )
    made = joined.withColumn("difference", F.col("salary") - F.col("mgr_salary"))
    return sort_by(made, "-difference", "employee_id").select(
        "full_name", "salary", "manager", "mgr_salary", "difference"
    )


def managers_in_own_department(t: Tables) -> DataFrame:
    heads = t.departments.join(t.locations, "location_id").select(
        F.col("department_id").alias("dept_id"),
        "department_name",
        F.col("manager_id").alias("head_id"),
        "city",
    )
    joined = _staff(t).join(
        heads,
        (F.col("employee_id") == F.col("head_id")) & (F.col("department_id") == F.col("dept_id")),
    )
    return sort_by(joined, "department_name", "dept_id").select(
        "dept_id", "department_name", F.col("full_name").alias("manager_name"), "city"
    )


def employee_profiles(t: Tables) -> DataFrame:
    joined = _staff(t).join(t.jobs, "job_id").join(_sites(t), "department_id")
    return sort_by(joined, "country_name", "department_name", "last_name", "employee_id").select(
        "employee_id", "full_name", "job_title", "department_name", "city", "country_name"
    )


def department_managers(t: Tables, default: str = labels.NO_MANAGER) -> DataFrame:
    heads = t.employees.select(F.col("employee_id").alias("head_id"), "first_name", "last_name")
    sites = t.departments.join(t.locations, "location_id").join(t.countries, "country_id")
    joined = sites.join(heads, F.col("manager_id") == F.col("head_id"), "left")
    return sort_by(joined, "department_name", "department_id").select(
        "department_name",
        name_or("head_id", default, "first_name", "last_name").alias("manager"),
        "city",
        "country_name",
    )


def managers_in_same_department(t: Tables) -> DataFrame:
    sites = t.departments.select("department_id", "department_name", "location_id").join(
        t.locations, "location_id"
    )
    joined = (
        _staff(t)
        .join(
            _managers(t),
            (F.col("manager_id") == F.col("mgr_id"))
            & (F.col("department_id") == F.col("mgr_department_id")),
        )
        .join(sites, "department_id")
    )
    return sort_by(joined, "department_name", "last_name", "employee_id").select(
        "full_name", "department_name", "manager", "city"
    )


def managers_in_other_department(t: Tables) -> DataFrame:
    own = t.departments.select("department_id", "department_name")
    other = t.departments.select(
        F.col("department_id").alias("mgr_department_id"),
        F.col("department_name").alias("manager_department"),
    )
    joined = (
        _staff(t)
        .join(
            _managers(t),
            (F.col("manager_id") == F.col("mgr_id"))
            & (F.col("department_id") != F.col("mgr_department_id")),
        )
        .join(own, "department_id")
        .join(other, "mgr_department_id")
    )
    return sort_by(joined, "department_name", "last_name", "employee_id").select(
        "full_name", "department_name", "manager", "manager_department"
    )


def region_summary(t: Tables) -> DataFrame:
    """Departments and employees per country.

    Employees are counted per department first; the key is unique and an employee has one
    department, so the sum is the distinct count.
    """
    per = t.employees.groupBy("department_id").agg(F.count("employee_id").alias("_n"))
    sites = _sites(t).join(t.regions, "region_id").join(per, "department_id", "left")
    summary = sites.groupBy("region_name", "country_name").agg(
        F.count_distinct("department_id").alias("departments"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("employees"),
    )
    return sort_by(summary, "region_name", "country_name")


# --- corrected review queries -------------------------------------------------------------


def review_departments(t: Tables) -> DataFrame:
    joined = t.employees.join(
        t.departments.select("department_id", "department_name"), "department_id"
    )
    return sort_by(joined, "department_name", "last_name", "employee_id").select(
        "first_name", "last_name", "department_name"
    )


def review_jobs(t: Tables) -> DataFrame:
    joined = t.employees.join(t.jobs, "job_id")
    return sort_by(joined, "job_title", "last_name", "employee_id").select(
        "first_name", "last_name", "job_title", money_text("salary").alias("salary_text")
    )


def review_all_departments(t: Tables, default: str = labels.NO_DEPARTMENT) -> DataFrame:
    joined = t.employees.join(
        t.departments.select("department_id", "department_name"), "department_id", "left"
    )
    return sort_by(joined, "department_name", "last_name", "employee_id").select(
        "first_name", "last_name", F.coalesce("department_name", F.lit(default)).alias("department")
    )


def review_one_department(t: Tables, name: str = labels.SALES) -> DataFrame:
    one = t.departments.where(F.col("department_name") == name)
    joined = t.employees.join(one.select("department_id", "department_name"), "department_id")
    return sort_by(joined, "last_name", "employee_id").select(
        "first_name", "last_name", "department_name"
    )


def review_marked_department(
    t: Tables, name: str = labels.SALES, default: str = labels.NO_DEPARTMENT
) -> DataFrame:
    """All employees, with the department in question marked by its name."""
    joined = t.employees.join(
        t.departments.select("department_id", "department_name"), "department_id", "left"
    )
    label = F.when(F.col("department_name") == name, F.lit(name)).otherwise(
        F.coalesce("department_name", F.lit(default))
    )
    return sort_by(joined, "last_name", "employee_id").select(
        "first_name", "last_name", label.alias("department")
    )


def review_managers(t: Tables) -> DataFrame:
    joined = (
        _staff(t)
        .join(_managers(t), F.col("manager_id") == F.col("mgr_id"))
        .join(t.departments.select("department_id", "department_name"), "department_id")
    )
    return sort_by(joined, "department_name", "mgr_last_name", "last_name", "employee_id").select(
        "full_name", "salary", "manager", "department_name"
    )


# --- company projects -----------------------------------------------------------------------


def _workers(t: Tables) -> DataFrame:
    return t.company_employee.withColumn("employee", full_name("fname", "lname"))


def project_hours(t: Tables) -> DataFrame:
    workers = _workers(t).join(t.company_department, F.col("dno") == F.col("dnum"))
    named = t.project.select("pnumber", "pname")
    joined = t.works_on.join(workers, F.col("essn") == F.col("ssn")).join(
        named, F.col("pno") == F.col("pnumber")
    )
    return sort_by(joined, "dname", "lname", "pname", "ssn", "pno").select(
        "employee", "ssn", "dname", "pname", "hours"
    )


def employee_dependents(t: Tables) -> DataFrame:
    workers = _workers(t).join(t.company_department, F.col("dno") == F.col("dnum"))
    joined = outer_to_many(workers, t.dependent, "ssn", "essn")
    return sort_by(joined, "lname", "dependent_name", "ssn").select(
        "employee",
        "ssn",
        "dname",
        F.coalesce("dependent_name", F.lit(labels.NO_DEPENDENT)).alias("dependent_name"),
        F.coalesce("relationship", F.lit(labels.NO_RELATIONSHIP)).alias("relationship"),
    )


def projects_with_workers(t: Tables) -> DataFrame:
    """Every project of a department, with its work rows and their workers, if any.

    Two right joins keep projects without work rows and work rows without a known worker;
    the department key is on the kept side, so the inner join loses only projects without
    a department.
    """
    owned = t.project.join(
        t.company_department.select(F.col("dnum").alias("dno"), "dname"), "dno"
    ).select("pnumber", "pname", "dname")
    workers = _workers(t).select("ssn", "employee", "lname")
    work = t.works_on.join(workers, F.col("essn") == F.col("ssn"), "left")
    joined = outer_to_many(owned, work, "pnumber", "pno")
    return sort_by(joined, "pname", "lname", "pnumber", "essn").select(
        F.coalesce("employee", F.lit(" ")).alias("employee"),
        F.coalesce(F.col("ssn").cast("string"), F.lit(labels.NO_EMPLOYEE)).alias("ssn"),
        "dname",
        "pname",
        "pnumber",
        "hours",
    )


def supervisors(t: Tables) -> DataFrame:
    bosses = t.company_employee.select(
        F.col("ssn").alias("sup_ssn"), full_name("fname", "lname").alias("supervisor")
    )
    joined = (
        _workers(t)
        .join(bosses, F.col("super_ssn") == F.col("sup_ssn"))
        .join(t.company_department, F.col("dno") == F.col("dnum"))
    )
    return sort_by(joined, "dname", "lname", "ssn").select(
        "employee", "ssn", "supervisor", "sup_ssn", "dname"
    )
