"""Named views and full-refresh summary tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import labels
from ..functions.dates import AsOf, add_months, day, days_between, leave_days, month_start, started_years
from ..functions.money import mean, percent, ratio, wide
from ..operators.sorting import sort_by, top
from ..sources.loading import Tables
from .base import all_departments_pay, departments, pay_rows, payroll_per_employee, staff
from .matches import approver_names


def _label(column: str, texts: dict[str, str]) -> Column:
    known = [F.when(F.col(column) == value, text) for value, text in texts.items()]
    return F.coalesce(*known, F.lit(labels.UNKNOWN))


def employee_directory(t: Tables) -> DataFrame:
    """Contact columns only; pay columns stay out of reach."""
    return t.employee.join(departments(t), "job_id", "left").select(
        "emp_id", "first_name", "last_name", "email", "dept_name", "phone", "hire_date"
    )


def salary_info(t: Tables) -> DataFrame:
    joined = staff(t).join(departments(t), "job_id").join(
        pay_rows(t, "bonus_amount", "annual_increase"), "salary_id"
    )
    return joined.select(
        "emp_id",
        F.col("employee_name").alias("full_name"),
        "dept_name",
        "salary_id",
        F.col("amount").alias("base_salary"),
        "bonus_amount",
        F.col("annual_increase").alias("annual_increase_pct"),
        (F.col("amount") + F.col("bonus_amount")).alias("total_compensation"),
        "hire_date",
    )


def department_stats(t: Tables) -> DataFrame:
    return all_departments_pay(t, "dept_description").select(
        "job_id",
        "dept_name",
        "dept_description",
        "headcount",
        ratio("total", "paid").alias("avg_salary"),
        F.col("low").alias("min_salary"),
        F.col("high").alias("max_salary"),
        F.col("total").alias("total_salary_budget"),
    )


def employee_profile(t: Tables) -> DataFrame:
    """One row per employee with counts of three child tables.

    Each child is counted by its key before the join. Joining the children first would
    multiply them with each other. Keys of leave and payroll are unique and so are counted as
    they are; those of qualification may repeat.
    """
    counts = {
        "total_leave_requests": (t.leave, F.count("leave_id")),
        "qualification_count": (t.qualification, F.count_distinct("qual_id")),
        "payroll_records": (t.payroll, F.count("payroll_id")),
    }
    pay = pay_rows(t, "bonus_amount")
    profile = (
        staff(t).join(departments(t), "job_id", "left").join(pay, "salary_id", "left")
    )
    for name, (child, count) in counts.items():
        per = child.groupBy("emp_id").agg(count.alias(name))
        profile = profile.join(per, "emp_id", "left")
    known = matching_department(profile)
    return known.select(
        "emp_id",
        "employee_name",
        "gender",
        "age",
        "email",
        "phone",
        "hire_date",
        "dept_name",
        "job_id",
        F.col("amount").alias("monthly_salary"),
        "bonus_amount",
        (F.col("amount") + F.col("bonus_amount")).alias("total_compensation"),
        *[F.coalesce(n, F.lit(0)).alias(n) for n in counts],
    )


def matching_department(profile: DataFrame) -> DataFrame:
    """The view shows the department's own key: NULL when the department does not exist."""
    return profile.withColumn("job_id", F.when(F.col("dept_name").isNotNull(), F.col("job_id")))


def payroll_analysis(t: Tables, as_of: AsOf = None) -> DataFrame:
    people = staff(t).select("emp_id", "employee_name")
    joined = t.payroll.join(people, "emp_id").join(departments(t), "job_id")
    return joined.select(
        "payroll_id",
        "emp_id",
        "employee_name",
        "dept_name",
        "payroll_date",
        "gross_amount",
        "deductions",
        "net_amount",
        percent("deductions", "gross_amount").alias("deduction_pct"),
        _label("payment_status", labels.PAYMENT_TEXT).alias("payment_status_desc"),
        F.round((F.col("gross_amount") - F.col("deductions")) / labels.PERIODS, 2).alias("weekly_net"),
        days_between("payroll_date", day(as_of)).alias("days_since_payroll"),
    )


def leave_management(t: Tables, as_of: AsOf = None) -> DataFrame:
    people = staff(t).join(departments(t), "job_id").select("emp_id", "employee_name", "dept_name")
    joined = t.leave.join(people, "emp_id").join(
        approver_names(t), F.col("approved_by") == F.col("mgr_id"), "left"
    )
    return joined.select(
        "leave_id",
        "emp_id",
        "employee_name",
        "dept_name",
        "leave_type",
        "leave_start",
        "leave_end",
        leave_days("leave_start", "leave_end", inclusive=True, when_open=1).alias("days_requested"),
        "reason",
        "status",
        _label("status", labels.LEAVE_TEXT).alias("status_description"),
        F.coalesce("approver", F.lit(" ")).alias("approved_by_manager"),
        days_between("leave_start", day(as_of)).alias("days_until_leave"),
    )


def employee_qualifications(t: Tables, as_of: AsOf = None) -> DataFrame:
    people = staff(t).join(departments(t), "job_id").select("emp_id", "employee_name", "dept_name")
    years = started_years("grant_date", as_of)
    joined = t.qualification.join(people, "emp_id").withColumn("years_since_certification", years)
    status = (
        F.when(F.col("years_since_certification") >= labels.RENEWAL_YEARS, labels.RENEWAL)
        .when(F.col("years_since_certification") >= labels.CURRENT_YEARS, labels.CURRENT)
        .otherwise(labels.RECENT)
    )
    return joined.select(
        "qual_id",
        "emp_id",
        "employee_name",
        "dept_name",
        "qual_title",
        "qual_type",
        "grant_date",
        "years_since_certification",
        status.alias("certification_status"),
    )


# --- summary tables -----------------------------------------------------------------------


def department_summary(t: Tables, as_of: AsOf = None, per_payroll_row: bool = True) -> DataFrame:
    """Pay and payroll per department.

    The catalogued query joins payroll to employees first, so head count, budget and average
    count an employee once per payroll row. ``per_payroll_row=False`` counts each once.
    """
    weight = F.greatest(F.coalesce(F.col("payroll_records"), F.lit(0)), F.lit(1))
    people = (
        t.employee.select("emp_id", "job_id", "salary_id")
        .join(pay_rows(t), "salary_id", "left")
        .join(payroll_per_employee(t), "emp_id", "left")
        .withColumn("weight", weight if per_payroll_row else F.lit(1).cast("bigint"))
        .withColumn("weighted", F.col("amount") * F.col("weight"))
    )
    per = people.groupBy("job_id").agg(
        F.sum("weight").alias("headcount"),
        F.sum("weighted").alias("budget"),
        F.sum(F.when(F.col("amount").isNotNull(), F.col("weight"))).alias("weights"),
        F.min("amount").alias("min_salary"),
        F.max("amount").alias("max_salary"),
        F.sum("payroll_records").alias("records"),
        F.sum("total_gross").alias("total_gross_paid"),
    )
    kept = departments(t, "dept_description").join(per, "job_id", "left")
    return kept.select(
        "job_id",
        "dept_name",
        "dept_description",
        F.coalesce("headcount", F.lit(0)).alias("headcount"),
        ratio(wide("budget"), "weights").alias("avg_salary"),
        "min_salary",
        "max_salary",
        F.col("budget").alias("total_salary_budget"),
        F.coalesce("records", F.lit(0)).alias("total_payroll_records"),
        "total_gross_paid",
        day(as_of).alias("last_refreshed"),
    )


def monthly_payroll(t: Tables, as_of: AsOf = None, months: int = 12) -> DataFrame:
    """Payroll per month and department over the trailing months."""
    first = add_months(month_start(day(as_of)), -months)
    recent = t.payroll.where(F.col("payroll_date") >= first)
    return (
        recent.join(departments(t), "job_id")
        .groupBy(month_start("payroll_date").alias("payroll_month"), "dept_name")
        .agg(
            F.count("payroll_id").alias("payroll_records"),
            F.count_distinct("emp_id").alias("employees_paid"),
            F.sum("gross_amount").alias("total_gross"),
            F.sum("deductions").alias("total_deductions"),
            F.sum("net_amount").alias("total_net"),
            mean("net_amount").alias("avg_net_per_employee"),
            F.max("payroll_date").alias("latest_payroll_date"),
        )
    )


def leave_statistics(t: Tables, as_of: AsOf = None) -> DataFrame:
    """Leave counts by status and type per department, from one row per employee."""
    places = t.employee.select("emp_id", "job_id").join(departments(t), "job_id")
    days = leave_days("leave_start", "leave_end", inclusive=True, when_open=0)

    def hits(column: str, value: str) -> Column:
        return F.sum(F.when(F.col(column) == value, 1).otherwise(0))

    per = t.leave.groupBy("emp_id").agg(
        F.count("leave_id").alias("requests"),
        hits("status", "APPROVED").alias("approved_count"),
        hits("status", "PENDING").alias("pending_count"),
        hits("status", "REJECTED").alias("rejected_count"),
        hits("leave_type", "SICK").alias("sick_leaves"),
        hits("leave_type", "VACATION").alias("vacation_leaves"),
        F.sum(days).alias("days"),
    )
    sums = ("approved_count", "pending_count", "rejected_count", "sick_leaves", "vacation_leaves")
    return (
        per.join(places, "emp_id")
        .groupBy("dept_name")
        .agg(
            F.count("emp_id").alias("employees_with_leaves"),
            F.sum("requests").alias("total_leave_requests"),
            *[F.sum(n).alias(n) for n in sums],
            F.round(F.sum("days").cast("decimal(20,0)") / F.sum("requests"), 2).alias(
                "avg_leave_duration"
            ),
        )
        .withColumn("last_refreshed", day(as_of))
    )


# --- queries over the views -----------------------------------------------------------------


def directory_size(t: Tables) -> DataFrame:
    return employee_directory(t).agg(F.count("*").alias("total_employees"))


def department_stats_sorted(t: Tables) -> DataFrame:
    return sort_by(department_stats(t), "-total_salary_budget", "job_id")


def top_earners(t: Tables, n: int = 5) -> DataFrame:
    """The n best paid by total compensation; a NULL total sorts first, as in the source."""
    best = top(salary_info(t), n, "-total_compensation", "emp_id")
    return best.select("full_name", "dept_name", "total_compensation")


def compensation_by_department(t: Tables) -> DataFrame:
    """Count and average total compensation per department of the profile view."""
    return (
        employee_profile(t)
        .groupBy("dept_name")
        .agg(F.count("*").alias("employees"), mean("total_compensation").alias("avg_compensation"))
    )


# --- registering and refreshing ---------------------------------------------------------------

VIEWS: dict[str, Callable[..., DataFrame]] = {
    "vw_employee_directory": employee_directory,
    "vw_salary_info": salary_info,
    "vw_department_stats": department_stats,
    "vw_employee_profile": employee_profile,
    "vw_payroll_analysis": payroll_analysis,
    "vw_leave_management": leave_management,
    "vw_employee_qualifications": employee_qualifications,
}
SUMMARIES: dict[str, Callable[..., DataFrame]] = {
    "mvw_department_summary": department_summary,
    "mvw_monthly_payroll": monthly_payroll,
    "mvw_leave_statistics": leave_statistics,
}


def register_views(t: Tables, as_of: AsOf = None) -> list[str]:
    """Make the views available to Spark SQL under their names."""
    dated = {payroll_analysis, leave_management, employee_qualifications}
    for name, view in VIEWS.items():
        (view(t, as_of) if view in dated else view(t)).createOrReplaceTempView(name)
    return list(VIEWS)


def refresh(df: DataFrame, base: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Full refresh: write the next numbered copy below ``base`` and return it.

    Readers of the former copy keep their files; `current_summary` opens the newest one.
    The number of a copy that was never finished is not used again.
    """
    number = max(_copies(df.sparkSession, base), default=0) + 1
    df.write.partitionBy(*partition_by).parquet(f"{base}/refresh_no={number}")
    return current_summary(df.sparkSession, base)


def _copies(spark: SparkSession, base: str, inside: str = "") -> list[int]:
    """Numbers of the copies below ``base`` that hold a file ``inside``."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/refresh_no=*{inside}")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    paths = [str(status.getPath().toString()) for status in files.globStatus(pattern) or []]
    return [int(path.rsplit("refresh_no=", 1)[1].split("/")[0]) for path in paths]


def latest_refresh(spark: SparkSession, base: str) -> int:
    """Number of the newest copy whose write has been committed, 0 without any."""
    return max(_copies(spark, base, "/_SUCCESS"), default=0)


def current_summary(spark: SparkSession, base: str) -> DataFrame:
    """The newest committed copy of a summary table."""
    return spark.read.parquet(f"{base}/refresh_no={latest_refresh(spark, base)}")
