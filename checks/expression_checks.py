"""Checks of projections, predicates, conditional and scalar expressions, and sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake import labels
from rosterlake.functions import dates, money, text
from rosterlake.operators.changes import archive_deleted
from rosterlake.operators.joins import matching
from rosterlake.operators.ordered import over_order, position
from rosterlake.operators.sorting import sort_by, top
from rosterlake.sources.loading import Tables

from .sql import cents, div, money as money_sql, num, q

DAY = "2024-01-15"
PAY_DAY = "2001-07-15"


def _tenure(t: Tables) -> DataFrame:
    days = dates.days_between("hire_date", dates.day(DAY))
    bucket = F.when(days < 1000, "new").when(days < 3000, "settled").otherwise("senior")
    return t.employee.select("emp_id", bucket.alias("tenure"))


def _date_ranges(t: Tables) -> DataFrame:
    start, today = F.col("leave_start"), dates.day(DAY)
    return t.leave.select(
        "leave_id",
        ((start >= today) & (start < F.date_add(today, 7))).alias("next_week"),
        (start <= today).alias("past_or_today"),
        (start >= dates.add_months(today, -12)).alias("last_year"),
        (dates.month_start("leave_start") == dates.month_start(today)).alias("same_month"),
    )


def _compound(t: Tables) -> DataFrame:
    # unknown tests neither keep nor drop a row by themselves
    bad = (~F.col("gender").isin("M", "F")) | (F.col("age") < 18) | (F.col("age") > 75)
    ended = (F.col("gender") == "F") & (F.col("job_id").isNull() | (F.col("job_id") < 5))
    return t.employee.where(bad | ended).select("emp_id", "gender", "age", "job_id")


def _money_functions(t: Tables) -> DataFrame:
    deductions, net = money.deduct("gross_amount", labels.PROCESS_RATE)
    return t.payroll.select(
        "payroll_id",
        (F.col("gross_amount") * F.lit("0.85").cast("decimal(3,2)")).alias("reduced"),
        deductions.alias("deductions"),
        net.alias("net"),
        F.round((F.col("gross_amount") - F.col("deductions")) / labels.PERIODS, 2).alias("per_period"),
    )


def _numbers(t: Tables) -> DataFrame:
    gap = F.col("gross_amount") - F.lit("250000.00").cast("decimal(12,2)")
    return t.payroll.select(
        "payroll_id",
        F.abs(gap).alias("abs_gap"),
        F.ceil(gap / 1000).cast("bigint").alias("ceil_thousands"),
        F.floor(F.col("gross_amount")).cast("bigint").alias("whole"),
        (F.col("payroll_id") % 5).alias("remainder"),
        F.ceil(F.col("payroll_id") / 5).cast("bigint").alias("batch_no"),
    )


def _rounding(t: Tables) -> DataFrame:
    x = F.col("gross_amount") / F.lit(8)
    return t.payroll.select(
        "payroll_id",
        F.round(x, 0).cast("double").alias("r0"),
        F.round(x, 1).alias("r1"),
        F.round(x, 2).alias("r2"),
    )


def _null_order(t: Tables) -> DataFrame:
    rows = t.salary_bonus.select("salary_id", "bonus_amount")
    down = over_order(rows, ["-bonus_amount", "salary_id"], {"down": position()})
    both = over_order(down, ["bonus_amount", "salary_id"], {"up": position()})
    return both.select("salary_id", "down", "up")


CHECKS = {
    "p01_projection_alias": (
        lambda t: t.employees.select(
            F.col("employee_id").alias("Employee ID"), text.full_name().alias("Full Name")
        ),
        q("""SELECT employee_id AS "Employee ID", first_name || ' ' || last_name AS "Full Name" FROM employees"""),
    ),
    "p02_literal_column": (
        lambda t: t.employees.select("employee_id", F.lit("staff").alias("tag")),
        q("SELECT employee_id, 'staff' AS tag FROM employees"),
    ),
    "p03_comparison_filter": (
        lambda t: t.payroll.where(
            (F.col("gross_amount") > 100000)
            & (F.col("payment_status") != "PAID")
            & (F.col("emp_id") <= F.col("payroll_id"))
        ).select("payroll_id", "gross_amount"),
        q("""SELECT payroll_id, gross_amount::DOUBLE AS gross_amount FROM payroll
            WHERE gross_amount > 100000 AND payment_status <> 'PAID' AND payroll_id >= emp_id"""),
    ),
    "p04_null_filter": (
        lambda t: t.employee.where(F.col("gender").isNull() & F.col("salary_id").isNotNull()).select(
            "emp_id", "salary_id"
        ),
        q("SELECT emp_id, salary_id FROM employee WHERE gender IS NULL AND salary_id IS NOT NULL"),
    ),
    "p05_in_list": (
        lambda t: t.leave.where(
            F.col("leave_type").isin("SICK", "VACATION") & ~F.col("status").isin("REJECTED")
        ).select("leave_id", "leave_type", "status"),
        q("""SELECT leave_id, leave_type, status FROM leave
            WHERE leave_type IN ('SICK', 'VACATION') AND status NOT IN ('REJECTED')"""),
    ),
    "p06_case_when": (_tenure, q(f"""
        SELECT emp_id, CASE WHEN DATE '{DAY}' - hire_date < 1000 THEN 'new'
            WHEN DATE '{DAY}' - hire_date < 3000 THEN 'settled' ELSE 'senior' END AS tenure FROM employee""")),
    "p07_date_ranges": (_date_ranges, q(f"""
        SELECT leave_id, leave_start BETWEEN DATE '{DAY}' AND DATE '{DAY}' + 6 AS next_week,
            leave_start <= DATE '{DAY}' AS past_or_today, leave_start >= DATE '2023-01-15' AS last_year,
            year(leave_start) = 2024 AND month(leave_start) = 1 AS same_month FROM leave""")),
    "p08_select_all": (
        lambda t: matching(t.works_on.select("*"), t.dependent, "essn").select(*t.works_on.columns),
        q("SELECT * REPLACE (hours::DOUBLE AS hours) FROM works_on WHERE essn IN (SELECT essn FROM dependent)"),
    ),
    "p09_masked_view": (
        lambda t: t.employee.select(
            "emp_id",
            "first_name",
            text.mask_email("email").alias("email"),
            text.mask_phone("phone").alias("phone"),
        ),
        q("""SELECT emp_id, first_name, email[1] || '***' || substr(email, position('@' IN email)) AS email,
            '***-**' || right(phone, 2) AS phone FROM employee"""),
    ),
    "p10_like": (
        lambda t: t.project.where(F.col("pname").like("s_all %")).select("pnumber", "pname"),
        q("SELECT pnumber, pname FROM project WHERE pname LIKE 's_all %'"),
    ),
    "p11_compound_predicate": (_compound, q("""
        SELECT emp_id, gender, age::BIGINT AS age, job_id FROM employee
        WHERE gender NOT IN ('M', 'F') OR age NOT BETWEEN 18 AND 75
            OR (gender = 'F' AND coalesce(job_id < 5, TRUE))""")),
    "f01_concat_null_as_empty": (
        lambda t: t.employee.select(
            "emp_id", text.joined("email", F.lit("/"), "gender", F.lit("/"), "job_id").alias("label")
        ),
        q("SELECT emp_id, concat(email, '/', gender, '/', job_id) AS label FROM employee"),
    ),
    "f02_coalesce": (
        lambda t: t.salary_bonus.select(
            "salary_id", F.coalesce("bonus_amount", F.lit(0).cast("decimal(12,2)")).alias("bonus")
        ),
        q("SELECT salary_id, ifnull(bonus_amount, 0)::DOUBLE AS bonus FROM salary_bonus"),
    ),
    "f03_nullif": (
        lambda t: t.salary_bonus.select(
            "salary_id", F.nullif("annual_increase", F.lit(0)).alias("increase")
        ),
        q("""SELECT salary_id, CASE WHEN annual_increase <> 0 THEN annual_increase::DOUBLE END AS increase
            FROM salary_bonus"""),
    ),
    "f04_round_half_up": (_rounding, q(f"""
        SELECT payroll_id, {div(cents('gross_amount'), '800', 0)} AS r0,
            {div(cents('gross_amount'), '800', 1)} AS r1, {div(cents('gross_amount'), '800', 2)} AS r2
        FROM payroll""")),
    "f05_ceil_abs_mod": (_numbers, q(f"""
        SELECT payroll_id, abs(gross_amount - 250000)::DOUBLE AS abs_gap,
            -((-({cents('gross_amount - 250000')}) - CASE WHEN ({cents('gross_amount - 250000')}) > 0
                THEN 99999 ELSE 0 END) // 100000)::BIGINT AS ceil_thousands,
            ({cents('gross_amount')} // 100)::BIGINT AS whole, payroll_id % 5 AS remainder,
            (payroll_id + 4) // 5 AS batch_no FROM payroll""")),
    "f06_trunc_date": (
        lambda t: t.job_execution_log.select(
            "log_id",
            F.to_date("execution_start").alias("day"),
            F.date_trunc("month", "execution_start").cast("date").alias("month"),
        ),
        q("""SELECT log_id, execution_start::DATE::VARCHAR AS day,
            date_trunc('month', execution_start)::DATE::VARCHAR AS month FROM job_execution_log"""),
    ),
    "f07_date_difference": (
        lambda t: t.leave.select(
            "leave_id", dates.days_between("leave_start", "leave_end").alias("days"),
            dates.leave_days("leave_start", "leave_end", True, 1).alias("days_incl"),
            dates.leave_days("leave_start", "leave_end", True, 0).alias("days_or_0"),
        ),
        q("""SELECT leave_id, leave_end - leave_start AS days, ifnull(leave_end - leave_start + 1, 1) AS days_incl,
            ifnull(leave_end - leave_start + 1, 0) AS days_or_0 FROM leave"""),
    ),
    "f08_date_shift": (
        lambda t: t.payroll.select("payroll_id", F.date_add("payroll_date", 10).alias("due")),
        q("SELECT payroll_id, (payroll_date + 10)::VARCHAR AS due FROM payroll"),
    ),
    "f09_add_months": (
        lambda t: t.payroll.select(
            "payroll_id",
            dates.add_months("payroll_date", 3).alias("later"),
            dates.add_months("payroll_date", -6).alias("earlier"),
        ),
        q("""SELECT payroll_id, (CASE WHEN payroll_date = last_day(payroll_date)
                THEN last_day(payroll_date + INTERVAL 3 MONTH) ELSE payroll_date + INTERVAL 3 MONTH END)::DATE::VARCHAR AS later,
            (CASE WHEN payroll_date = last_day(payroll_date) THEN last_day(payroll_date - INTERVAL 6 MONTH)
                ELSE payroll_date - INTERVAL 6 MONTH END)::DATE::VARCHAR AS earlier FROM payroll"""),
    ),
    "f10_months_between": (
        lambda t: t.qualification.select(
            "qual_id",
            "grant_date",
            dates.complete_months("grant_date", dates.day("2002-01-10")).alias("complete"),
            dates.month_boundaries("grant_date", dates.day("2002-01-10")).alias("boundaries"),
        ),
        q("""SELECT qual_id, grant_date::VARCHAR AS grant_date,
            datesub('month', grant_date, DATE '2002-01-10') AS complete,
            datediff('month', grant_date, DATE '2002-01-10') AS boundaries FROM qualification"""),
    ),
    "f11_report_date": (
        lambda t: t.payroll.select("payroll_id", dates.day(PAY_DAY).alias("as_of")),
        q(f"SELECT payroll_id, '{PAY_DAY}' AS as_of FROM payroll"),
    ),
    "f12_parse_date": (
        lambda t: t.payroll.select(
            "payroll_id",
            F.to_date(F.date_format("payroll_date", "dd/MM/yyyy"), "dd/MM/yyyy").alias("parsed"),
        ),
        q("""SELECT payroll_id, strptime(strftime(payroll_date, '%d/%m/%Y'), '%d/%m/%Y')::DATE::VARCHAR AS parsed
            FROM payroll"""),
    ),
    "f13_format_date": (
        lambda t: t.job_execution_log.select(
            "log_id",
            F.date_format("execution_start", "yyyy-MM-dd").alias("day"),
            F.date_format("execution_start", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        ),
        q("""SELECT log_id, strftime(execution_start, '%Y-%m-%d') AS day,
            strftime(execution_start, '%Y-%m-%d %H:%M:%S') AS stamp FROM job_execution_log"""),
    ),
    "f14_money_text": (
        lambda t: t.payroll.join(
            t.employees.select("employee_id", "salary"), F.col("emp_id") == F.col("employee_id")
        ).select(
            "payroll_id",
            text.money_text("salary").alias("salary_text"),
            text.money_text(F.col("gross_amount") * 3).alias("wide_text"),
        ),
        q(f"""SELECT payroll_id, {money_sql('salary')} AS salary_text, {money_sql('(gross_amount * 3)')} AS wide_text
            FROM payroll INNER JOIN employees ON emp_id = employee_id"""),
    ),
    "f15_indent": (
        lambda t: t.employees.select(
            "employee_id",
            text.joined(text.indent(F.col("employee_id") % 5 + 1), "first_name").alias("line"),
        ),
        q("SELECT employee_id, repeat('  ', (employee_id % 5)::INTEGER) || first_name AS line FROM employees"),
    ),
    "f16_elapsed_seconds": (
        lambda t: t.raw_events.select(
            "event_id",
            F.round(dates.elapsed_seconds(F.date_trunc("day", "ts"), F.col("ts")), 3).alias("seconds"),
        ),
        """SELECT event_id, round((epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1000000.0, 3)::DOUBLE AS seconds
            FROM events""",
    ),
    "f17_money_arithmetic": (_money_functions, q(f"""
        SELECT payroll_id, (gross_amount * 0.85)::DOUBLE AS reduced,
            {div(cents('gross_amount') + ' * 30', '100', 0)} / 100 AS deductions,
            ({cents('gross_amount')} - {div(cents('gross_amount') + ' * 30', '100', 0)}) / 100 AS net,
            {div(cents('gross_amount - deductions'), '26', 0)} / 100 AS per_period FROM payroll""")),
    "f18_trunc_number": (
        lambda t: t.raw_events.select(
            "event_id", F.col("value").cast("bigint").alias("whole")
        ),
        "SELECT event_id, trunc(value)::BIGINT AS whole FROM events",
    ),
    "f19_changed_by": (
        lambda t: archive_deleted(t.employee, t.employee, "2024-01-15", "payroll_admin").audit.select(
            "emp_id", F.col("archived_by").alias("changed_by")
        ),
        q("SELECT emp_id, 'payroll_admin' AS changed_by FROM employee"),
    ),
    "f20_number_text": (
        lambda t: t.payroll.select(
            "payroll_id",
            text.number_text("gross_amount").alias("gross"),
            text.number_text((F.col("payroll_id") % 300).cast("decimal(12,2)") / 100).alias("small"),
        ),
        q(f"""SELECT payroll_id, {num('gross_amount')} AS gross,
            {num('((payroll_id % 300)::DOUBLE / 100)::DECIMAL(12,2)')} AS small FROM payroll"""),
    ),
    "o01_multi_key_sort": (
        lambda t: sort_by(
            t.payroll.select("payment_status", "gross_amount", "payroll_id"),
            "payment_status", "-gross_amount", "payroll_id",
        ),
        q("SELECT payment_status, gross_amount::DOUBLE AS gross_amount, payroll_id FROM payroll ORDER BY 1, 2 DESC, 3"),
    ),
    "o02_nulls_last": (
        lambda t: t.employee.orderBy(F.asc_nulls_last("job_id"), "emp_id").select("job_id", "emp_id"),
        q("SELECT job_id, emp_id FROM employee ORDER BY job_id NULLS LAST, emp_id"),
    ),
    "o03_null_placement": (_null_order, q("""
        SELECT salary_id, row_number() OVER (ORDER BY bonus_amount DESC NULLS FIRST, salary_id) AS down,
            row_number() OVER (ORDER BY bonus_amount ASC NULLS LAST, salary_id) AS up FROM salary_bonus""")),
    "o04_sort_by_expression": (
        lambda t: t.payroll.orderBy(
            (F.col("gross_amount") - F.col("deductions")).desc(), "payroll_id"
        ).select("payroll_id", "net_amount"),
        q("""SELECT payroll_id, net_amount::DOUBLE AS net_amount FROM payroll
            ORDER BY gross_amount - deductions DESC, payroll_id"""),
    ),
    "o05_top_k": (
        lambda t: top(t.payroll, 10, "-gross_amount", "payroll_id").select("payroll_id", "gross_amount"),
        q("""SELECT payroll_id, gross_amount::DOUBLE AS gross_amount FROM payroll
            ORDER BY payroll.gross_amount DESC, payroll_id LIMIT 10"""),
    ),
}
