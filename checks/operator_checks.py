"""Checks of sources, joins, aggregates, windows, set operations and subqueries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.money import mean, percent, ratio
from rosterlake.functions.text import joined
from rosterlake.operators.grouping import margin, rollup_sums, with_share
from rosterlake.operators.hierarchy import approval_levels
from rosterlake.operators.joins import (
    flag_existing,
    full_outer_to_many,
    matching,
    outer_to_many,
    without,
)
from rosterlake.operators.ordered import (
    following,
    largest_before,
    moving_mean,
    over_order,
    position,
    previous,
    rank_rows,
    running_sum,
    top_ranked,
)
from rosterlake.operators.subqueries import average_of, greater_than_all, greater_than_any
from rosterlake.plans import nested, views
from rosterlake.session import new_path
from rosterlake.sources.loading import (
    Tables,
    append_rows,
    conform,
    create_table_as,
    insert_select,
    row_count_inventory,
    with_defaults,
)
from rosterlake.sources.schemas import DEFAULTS, declared_schema

from .sql import avg2, cents, div, q

PAY_DAY = "2001-07-15"
PAYROLL_COLUMNS = """payroll_id, payroll_date::VARCHAR AS payroll_date, gross_amount::DOUBLE AS gross_amount,
    deductions::DOUBLE AS deductions, net_amount::DOUBLE AS net_amount, emp_id, job_id, salary_id,
    NULL::BIGINT AS leave_id, payment_status"""
ORDERED = ["payroll_date", "payroll_id"]
RAW = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _late_rows(t: Tables) -> DataFrame:
    """One further payroll row per event, with the columns an insert names."""
    top_id = t.payroll.agg(F.max("payroll_id").alias("m")).scalar()
    return t.raw_events.select(
        (top_id + 1 + F.col("event_id")).alias("payroll_id"),
        F.to_date("ts").alias("payroll_date"),
        F.col("value").cast("decimal(12,2)").alias("gross_amount"),
        F.col("user_id").alias("emp_id"),
    )


def _defaults(t: Tables) -> DataFrame:
    given = t.leave.drop("status", "leave_type")
    return with_defaults(given, DEFAULTS["leave"]).select("leave_id", "leave_end", "status", "leave_type")


def _distinct_keys(t: Tables) -> DataFrame:
    return t.works_on.select("essn", "pno").distinct()


def _fanout(t: Tables) -> DataFrame:
    """Three children of an employee, each counted before the join."""
    people = t.employee.select("emp_id")
    for name, child in (("leaves", t.leave), ("courses", t.qualification), ("pays", t.payroll)):
        per = child.groupBy("emp_id").agg(F.count("*").alias(name))
        people = people.join(per, "emp_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return people


def _cube(t: Tables) -> DataFrame:
    detail = t.payroll.groupBy("job_id", "payment_status").agg(
        F.count("*").alias("n"), F.sum("gross_amount").alias("gross")
    )
    return detail.cube("job_id", "payment_status").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("n").alias("n"),
        F.sum("gross").alias("gross"),
    )


def _rollup2(t: Tables) -> DataFrame:
    return rollup_sums(t.works_on, ["pno", "essn"], "hours")


def _running(t: Tables, frames, **form) -> DataFrame:
    rows = t.payroll.select("payroll_id", "job_id", "payroll_date", "gross_amount")
    return over_order(rows, ORDERED, frames, ["job_id"], **form).drop(
        "payroll_date", "gross_amount"
    )


LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _numbered(t: Tables, **form) -> DataFrame:
    lines = t.raw_lineitem.select(*LINES, "l_shipdate")
    return over_order(lines, ["-l_shipdate", *LINES], {"row_num": position()}, **form).drop("l_shipdate")


def _hour_ranks(t: Tables, **form) -> DataFrame:
    return rank_rows(t.works_on, "hours", {"rank": "rank_no"}, ["pno"], **form)


def _chain(t: Tables) -> DataFrame:
    """Staff of every reporting level below the top, to the fifth level."""
    seeds = t.employees.where("manager_id IS NULL").select(F.col("employee_id").alias("node"))
    links = t.employees.select(
        F.col("manager_id").alias("child"), F.col("employee_id").alias("parent")
    )
    return approval_levels(seeds, links, 5)


CHECKS = {
    "s01_load_table": (
        lambda t: t.raw_lineitem.where("l_quantity > 25").select("l_orderkey", "l_quantity"),
        "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 25",
    ),
    "s02_declared_schema": (
        lambda t: conform(t.payroll, declared_schema("payroll")),
        q(f"SELECT {PAYROLL_COLUMNS} FROM payroll"),
    ),
    "s03_with_defaults": (_defaults, q("""
        SELECT leave_id, leave_end::VARCHAR AS leave_end, 'PENDING' AS status, 'SICK' AS leave_type FROM leave""")),
    "s04_append_rows": (
        lambda t: append_rows(t.payroll, with_defaults(_late_rows(t), DEFAULTS["payroll"])),
        q(f"""SELECT {PAYROLL_COLUMNS} FROM payroll UNION ALL
            SELECT (SELECT max(payroll_id) FROM payroll) + 1 + event_id, ts::DATE::VARCHAR,
                value::DECIMAL(12,2)::DOUBLE, 0, NULL, user_id, NULL, NULL, NULL, 'PENDING' FROM events"""),
    ),
    "s05_insert_select": (
        lambda t: insert_select(t.payroll, "payroll", nested.payroll_of_high_pay(t, PAY_DAY)),
        q(f"""WITH pool AS (SELECT sum(amount) AS s, count(amount) AS n FROM salary_bonus),
            made AS (SELECT emp_id, e.job_id, e.salary_id, {cents('amount')} AS c
                FROM pool, employee e INNER JOIN salary_bonus b ON b.salary_id = e.salary_id WHERE amount * n > s)
            SELECT {PAYROLL_COLUMNS} FROM payroll UNION ALL
            SELECT NULL, '{PAY_DAY}', c::DOUBLE / 100, {div('c * 15', '100', 0)} / 100,
                (c - {div('c * 15', '100', 0)}) / 100, emp_id, job_id, salary_id, NULL, 'PROCESSED' FROM made"""),
    ),
    "s06_create_table_as": (
        lambda t: create_table_as(
            views.employee_directory(t), new_path(t.employee.sparkSession, "directory")
        ),
        q("""SELECT emp_id, first_name, last_name, email, dept_name, phone, hire_date::VARCHAR AS hire_date
            FROM employee LEFT OUTER JOIN job_department USING (job_id)"""),
    ),
    "s07_row_counts": (
        lambda t: row_count_inventory({n: t[f"raw_{n}"] for n in RAW}),
        " UNION ALL ".join(f"SELECT '{n}' AS tbl, count(*) AS total FROM {n}" for n in RAW),
    ),
    "j01_inner": (
        lambda t: t.works_on.join(t.project, F.col("pno") == F.col("pnumber")).select("essn", "pname", "hours"),
        q("SELECT essn, pname, hours::DOUBLE AS hours FROM works_on INNER JOIN project ON pno = pnumber"),
    ),
    "j02_multi_way_inner": (
        lambda t: t.payroll.join(t.employee.select("emp_id", F.col("job_id").alias("home")), "emp_id")
        .join(t.job_department.select(F.col("job_id").alias("home"), "dept_name"), "home")
        .join(t.countries.select(F.col("country_id").alias("home"), "region_id"), "home")
        .join(t.regions, "region_id")
        .select("payroll_id", "dept_name", "region_name"),
        q("""SELECT payroll_id, dept_name, region_name FROM payroll p, employee e, job_department d, countries c, regions r
            WHERE e.emp_id = p.emp_id AND d.job_id = e.job_id AND c.country_id = d.job_id AND r.region_id = c.region_id"""),
    ),
    "j03_left_outer": (
        lambda t: t.leave.join(t.employee.select("emp_id", "first_name"), "emp_id", "left").select(
            "leave_id", "emp_id", "first_name"
        ),
        q("SELECT leave_id, emp_id, first_name FROM leave LEFT OUTER JOIN employee USING (emp_id)"),
    ),
    "j04_right_outer": (
        lambda t: t.salary_bonus.select("salary_id", "amount")
        .join(t.employee.select("emp_id", "salary_id"), "salary_id", "right")
        .select("emp_id", "amount"),
        q("""SELECT emp_id, amount::DOUBLE AS amount FROM salary_bonus s
            RIGHT OUTER JOIN employee e ON s.salary_id = e.salary_id"""),
    ),
    "j05_right_joins_then_inner": (
        lambda t: outer_to_many(
            t.project.join(t.company_department, F.col("dno") == F.col("dnum")),
            t.works_on.join(
                t.dependent.select("essn", "dependent_name"), "essn", "left"
            ).withColumnRenamed("essn", "worker"),
            "pnumber",
            "pno",
        ).select("pnumber", "dname", "worker", "dependent_name"),
        q("""SELECT pnumber, dname, w.essn AS worker, dependent_name
            FROM dependent n RIGHT OUTER JOIN works_on w ON n.essn = w.essn
            RIGHT OUTER JOIN project p ON w.pno = p.pnumber INNER JOIN company_department ON p.dno = dnum"""),
    ),
    "j06_full_outer": (
        lambda t: full_outer_to_many(
            t.employee.select("emp_id", "first_name"),
            t.leave.select(F.col("emp_id").alias("on_leave"), "leave_id"),
            "emp_id",
            "on_leave",
        ).select(F.coalesce("emp_id", "on_leave").alias("emp_id"), "first_name", "leave_id"),
        q("SELECT emp_id, first_name, leave_id FROM employee FULL OUTER JOIN leave USING (emp_id)"),
    ),
    "j07_self_join": (
        lambda t: t.company_employee.select("ssn", "super_ssn").join(
            t.company_employee.select(F.col("ssn").alias("super_ssn"), F.col("dno").alias("boss_dno")),
            "super_ssn",
        ),
        q("""SELECT e.super_ssn, e.ssn, b.dno AS boss_dno FROM company_employee e, company_employee b
            WHERE b.ssn = e.super_ssn"""),
    ),
    "j08_self_join_residual": (
        lambda t: t.employees.alias("s")
        .join(
            t.employees.alias("b"),
            (F.col("s.manager_id") == F.col("b.employee_id"))
            & (F.col("s.salary") > F.col("b.salary") * 2),
        )
        .select(F.col("s.employee_id").alias("emp"), F.col("b.employee_id").alias("boss")),
        q("""SELECT s.employee_id AS emp, b.employee_id AS boss FROM employees s, employees b
            WHERE s.manager_id = b.employee_id AND s.salary > 2 * b.salary"""),
    ),
    "j10_two_totals": (
        lambda t: t.salary_bonus.agg(F.sum("amount").alias("pay_total")).withColumn(
            "gross_total", t.payroll.agg(F.sum("gross_amount").alias("g")).scalar()
        ),
        q("""SELECT (SELECT sum(amount) FROM salary_bonus)::DOUBLE AS pay_total,
            (SELECT sum(gross_amount) FROM payroll)::DOUBLE AS gross_total"""),
    ),
    "j11_anti_not_exists": (
        lambda t: without(t.raw_documents, t.dependent, "doc_id", "essn").select("doc_id", "n_chars"),
        q("""SELECT doc_id, n_chars FROM documents o
            WHERE NOT EXISTS (FROM dependent n WHERE n.essn = o.doc_id)"""),
    ),
    "j12_anti_left_null": (
        lambda t: without(t.employee, t.leave, "emp_id").select("emp_id", "job_id"),
        q("SELECT e.emp_id, job_id FROM employee e LEFT OUTER JOIN leave v ON v.emp_id = e.emp_id WHERE leave_id IS NULL"),
    ),
    "j13_semi_exists": (
        lambda t: matching(t.project, t.works_on, "pnumber", "pno").select("pnumber", "pname"),
        q("SELECT pnumber, pname FROM project WHERE EXISTS (FROM works_on WHERE pno = pnumber)"),
    ),
    "j14_semi_in": (
        lambda t: matching(
            t.payroll,
            t.payroll.groupBy("emp_id").agg(F.count("*").alias("n")).where("n > 12"),
            "emp_id",
        ).select("payroll_id", "emp_id"),
        q("""SELECT payroll_id, emp_id FROM payroll
            WHERE emp_id IN (SELECT emp_id FROM payroll GROUP BY 1 HAVING count(*) > 12)"""),
    ),
    "j15_existence_flag": (
        lambda t: flag_existing(t.employee.select("emp_id"), t.leave, "emp_id", "has_leave"),
        q("SELECT emp_id, emp_id IN (SELECT emp_id FROM leave) AS has_leave FROM employee"),
    ),
    "j16_join_on_aggregate": (
        lambda t: t.payroll.join(
            t.payroll.groupBy("emp_id").agg(mean("gross_amount").alias("mean_gross")), "emp_id"
        ).select("payroll_id", "gross_amount", "mean_gross"),
        q(f"""WITH per AS (SELECT emp_id, {avg2('gross_amount')} AS mean_gross FROM payroll GROUP BY 1)
            SELECT payroll_id, gross_amount::DOUBLE AS gross_amount, mean_gross
            FROM payroll INNER JOIN per USING (emp_id)"""),
    ),
    "a01_global_aggregate": (
        lambda t: t.payroll.agg(
            F.count("*").alias("n"), F.min("gross_amount").alias("low"),
            mean("gross_amount").alias("mean"), F.max("gross_amount").alias("high"),
        ),
        q(f"""SELECT count(*) AS n, min(gross_amount)::DOUBLE AS low, {avg2('gross_amount')} AS mean,
            max(gross_amount)::DOUBLE AS high FROM payroll"""),
    ),
    "a02_group_aggregate": (
        lambda t: t.payroll.groupBy("payment_status", "job_id").agg(
            F.count("*").alias("n"), F.sum("net_amount").alias("total"),
            mean("net_amount").alias("mean"), F.min("payroll_date").alias("first_day"),
        ),
        q(f"""SELECT payment_status, job_id, count(*) AS n, sum(net_amount)::DOUBLE AS total,
            {avg2('net_amount')} AS mean, min(payroll_date)::VARCHAR AS first_day FROM payroll GROUP BY 1, 2"""),
    ),
    "a03_count_star_and_column": (
        lambda t: t.employee.groupBy("job_id").agg(
            F.count("*").alias("all_rows"), F.count("gender").alias("known"), F.count("email").alias("mails")
        ),
        q("""SELECT job_id, count(*) AS all_rows, count(gender) AS known, count(email) AS mails
            FROM employee GROUP BY 1"""),
    ),
    "a04_count_distinct": (
        lambda t: t.works_on.groupBy("essn").agg(
            F.count_distinct("pno").alias("projects"), F.count_distinct("hours").alias("hour_values")
        ),
        q("""SELECT essn, count(DISTINCT pno) AS projects, count(DISTINCT hours) AS hour_values
            FROM works_on GROUP BY 1"""),
    ),
    "a05_conditional_aggregate": (
        lambda t: t.payroll.groupBy("emp_id").agg(
            F.sum(F.when(F.col("payment_status") == "PAID", 1).otherwise(0)).alias("paid"),
            F.sum(F.when(F.col("payment_status") == "PENDING", F.col("gross_amount"))).alias("open_gross"),
        ),
        q("""SELECT emp_id, count(*) FILTER (payment_status = 'PAID') AS paid,
            (sum(gross_amount) FILTER (payment_status = 'PENDING'))::DOUBLE AS open_gross FROM payroll GROUP BY 1"""),
    ),
    "a06_rollup_one": (
        lambda t: t.payroll.rollup("payment_status").agg(
            margin("payment_status", "ALL").alias("status"), F.count("*").alias("n")
        ).select("status", "n"),
        q("""SELECT CASE grouping(payment_status) WHEN 1 THEN 'ALL' ELSE payment_status END AS status, count(*) AS n
            FROM payroll GROUP BY ROLLUP (payment_status)"""),
    ),
    "a07_rollup_two": (_rollup2, q("""
        SELECT pno, essn, (grouping(pno) * 2 + grouping(essn))::BIGINT AS level, sum(hours)::DOUBLE AS hours
        FROM works_on GROUP BY ROLLUP (pno, essn)""")),
    "a08_cube": (_cube, q("""
        SELECT job_id, payment_status, (grouping(job_id) * 2 + grouping(payment_status))::BIGINT AS level,
            count(*) AS n, sum(gross_amount)::DOUBLE AS gross FROM payroll GROUP BY CUBE (job_id, payment_status)""")),
    "a09_margin_labels": (
        lambda t: t.employee.groupBy("gender").agg(F.count("*").alias("n")).rollup("gender").agg(
            margin("gender", "BOTH").alias("label"), F.sum("n").alias("n")
        ).select("label", "n"),
        q("""SELECT gender AS label, count(*) AS n FROM employee GROUP BY gender
            UNION ALL SELECT 'BOTH', count(*) FROM employee"""),
    ),
    "a10_having": (
        lambda t: t.works_on.groupBy("essn", "pno").agg(F.count("*").alias("n")).where("n > 1"),
        q("SELECT essn, pno, count(*) AS n FROM works_on GROUP BY ALL HAVING count(*) > 1"),
    ),
    "a11_share_of_total": (
        lambda t: with_share(
            t.payroll.groupBy("payment_status").agg(F.sum("gross_amount").alias("gross")), "gross", "pct"
        ),
        q(f"""SELECT payment_status, sum(gross_amount)::DOUBLE AS gross,
            {div(f'100 * sum({cents("gross_amount")})', f'sum(sum({cents("gross_amount")})) OVER ()')} AS pct
            FROM payroll GROUP BY 1"""),
    ),
    "a12_safe_ratio": (
        lambda t: t.salary_bonus.select(
            "salary_id", ratio("amount", "annual_increase").alias("per_point"),
            percent("annual_increase", "bonus_amount").alias("pct"),
        ),
        q(f"""SELECT salary_id, {div(cents('amount'), cents('annual_increase'))} AS per_point,
            {div(f'100 * {cents("annual_increase")}', cents('bonus_amount'))} AS pct FROM salary_bonus"""),
    ),
    "a13_distinct": (_distinct_keys, q("SELECT DISTINCT essn, pno FROM works_on")),
    "a14_by_month": (
        lambda t: t.payroll.groupBy(F.trunc("payroll_date", "MM").alias("month")).agg(
            F.count("*").alias("n"), F.sum("gross_amount").alias("gross")
        ),
        q("""SELECT date_trunc('month', payroll_date)::DATE::VARCHAR AS month, count(*) AS n,
            sum(gross_amount)::DOUBLE AS gross FROM payroll GROUP BY 1"""),
    ),
    "a15_children_counted_apart": (_fanout, q("""
        SELECT emp_id, (SELECT count(*) FROM leave v WHERE v.emp_id = e.emp_id) AS leaves,
            (SELECT count(*) FROM qualification k WHERE k.emp_id = e.emp_id) AS courses,
            (SELECT count(*) FROM payroll p WHERE p.emp_id = e.emp_id) AS pays FROM employee e""")),
    "w01_row_number": (
        _numbered,
        """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, row_number() OVER
            (ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_num FROM lineitem""",
    ),
    "w02_rank": (
        _hour_ranks,
        q("""SELECT essn, pno, hours::DOUBLE AS hours, rank() OVER (PARTITION BY pno ORDER BY works_on.hours DESC) AS rank_no
            FROM works_on"""),
    ),
    "w03_dense_rank": (
        lambda t: rank_rows(t.works_on, "hours", {"dense_rank": "dense_no", "rank": "rank_no"}),
        q("""SELECT essn, pno, hours::DOUBLE AS hours, dense_rank() OVER (ORDER BY works_on.hours DESC) AS dense_no,
            rank() OVER (ORDER BY works_on.hours DESC) AS rank_no FROM works_on"""),
    ),
    "w04_top_per_group": (
        lambda t: top_ranked(
            t.works_on, "hours", 3, {"dense_rank": "dense_no", "rank": "rank_no"}, ["pno"]
        ),
        q("""SELECT * FROM (SELECT essn, pno, hours::DOUBLE AS hours,
            dense_rank() OVER (PARTITION BY pno ORDER BY works_on.hours DESC) AS dense_no,
            rank() OVER (PARTITION BY pno ORDER BY works_on.hours DESC) AS rank_no FROM works_on) WHERE dense_no <= 3"""),
    ),
    "w05_lag_lead": (
        lambda t: _running(
            t, {"before": previous("gross_amount"), "two_after": following("gross_amount", 2)}
        ),
        q("""SELECT payroll_id, job_id, (lag(gross_amount) OVER o)::DOUBLE AS before,
            (lead(gross_amount, 2) OVER o)::DOUBLE AS two_after FROM payroll
            WINDOW o AS (PARTITION BY job_id ORDER BY payroll_date, payroll_id)"""),
    ),
    "w06_running_total": (
        lambda t: _running(
            t, {"running": running_sum("gross_amount"), "highest": largest_before("gross_amount")}
        ),
        q("""SELECT payroll_id, job_id, (sum(gross_amount) OVER (o ROWS UNBOUNDED PRECEDING))::DOUBLE AS running,
            (max(gross_amount) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::DOUBLE AS highest
            FROM payroll WINDOW o AS (PARTITION BY job_id ORDER BY payroll_date, payroll_id)"""),
    ),
    "w07_moving_average": (
        lambda t: _running(t, {"near": moving_mean("gross_amount", 2, 2)}),
        q(f"""SELECT payroll_id, job_id, {div('s', 'n', 0)} / 100 AS near FROM (SELECT payroll_id, job_id,
            (sum({cents('gross_amount')}) OVER (o ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))::HUGEINT AS s,
            (count(*) OVER (o ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))::HUGEINT AS n
            FROM payroll WINDOW o AS (PARTITION BY job_id ORDER BY payroll_date, payroll_id))"""),
    ),
    "w08_cumulative_count": (
        lambda t: _running(t, {"so_far": position()}),
        q("""SELECT payroll_id, job_id, count(*) OVER (PARTITION BY job_id ORDER BY payroll_date, payroll_id
            ROWS UNBOUNDED PRECEDING) AS so_far FROM payroll"""),
    ),
    "w09_share_of_group": (
        lambda t: with_share(
            t.payroll.select("payroll_id", "job_id", "gross_amount"), "gross_amount", "pct", ["job_id"], 4
        ).drop("gross_amount"),
        q(f"""SELECT payroll_id, job_id, {div(f'100 * {cents("gross_amount")}',
            f'sum({cents("gross_amount")}) OVER (PARTITION BY job_id)', 4)} AS pct FROM payroll"""),
    ),
    "w10_total_of_aggregate": (nested.share_of_all, q("""
        SELECT job_id, sum(gross_amount)::DOUBLE AS gross, (sum(sum(gross_amount)) OVER ())::DOUBLE AS company_gross
        FROM payroll GROUP BY job_id""")),
    "u01_union_all": (
        lambda t: t.leave.select(F.lit("leave").alias("kind"), F.col("leave_start").alias("day"), "emp_id")
        .unionByName(
            t.payroll.select(F.lit("pay").alias("kind"), F.col("payroll_date").alias("day"), "emp_id")
        ),
        q("""SELECT 'leave' AS kind, leave_start::VARCHAR AS day, emp_id FROM leave
            UNION ALL SELECT 'pay', payroll_date::VARCHAR, emp_id FROM payroll"""),
    ),
    "q01_scalar_in_where": (
        lambda t: t.payroll.where(F.col("gross_amount") > average_of(t.payroll, "gross_amount")).select(
            "payroll_id"
        ),
        q("""SELECT payroll_id FROM payroll
            WHERE gross_amount * (SELECT count(*) FROM payroll) > (SELECT sum(gross_amount) FROM payroll)"""),
    ),
    "q02_scalar_in_select": (
        lambda t: t.payroll.select(
            "payroll_id", t.payroll.agg(F.max("gross_amount").alias("m")).scalar().alias("highest")
        ),
        q("SELECT payroll_id, (SELECT max(gross_amount)::DOUBLE FROM payroll) AS highest FROM payroll"),
    ),
    "q03_correlated_average": (
        lambda t: t.payroll.join(
            t.payroll.groupBy("emp_id").agg(F.max("payroll_date").alias("last_day")), "emp_id"
        ).select("payroll_id", F.datediff("last_day", "payroll_date").alias("days_to_last")),
        q("""SELECT payroll_id, (SELECT max(payroll_date) FROM payroll i WHERE i.emp_id = o.emp_id) - payroll_date
            AS days_to_last FROM payroll o"""),
    ),
    "q04_correlated_count": (
        lambda t: t.project.join(
            t.works_on.groupBy(F.col("pno").alias("pnumber")).agg(
                F.count("*").alias("rows_all"), F.count_if(F.col("hours") > 40).alias("rows_long")
            ),
            "pnumber",
            "left",
        ).select(
            "pnumber", F.coalesce("rows_all", F.lit(0)).alias("rows_all"),
            F.coalesce("rows_long", F.lit(0)).alias("rows_long"),
        ),
        q("""SELECT pnumber, (SELECT count(*) FROM works_on WHERE pno = pnumber) AS rows_all,
            (SELECT count(*) FROM works_on WHERE pno = pnumber AND hours > 40) AS rows_long FROM project"""),
    ),
    "q05_greater_than_all": (
        lambda t: greater_than_all(
            t.payroll, "gross_amount", t.payroll.where("payroll_date < '1995-02-01'"), "net_amount"
        ).select("payroll_id"),
        q("""SELECT payroll_id FROM payroll
            WHERE gross_amount > ALL (SELECT net_amount FROM payroll WHERE payroll_date < DATE '1995-02-01')"""),
    ),
    "q05_greater_than_all_of_none": (
        lambda t: greater_than_all(
            t.payroll, "gross_amount", t.payroll.where("job_id = 24"), "net_amount"
        ).select("payroll_id"),
        q("SELECT payroll_id FROM payroll WHERE gross_amount > ALL (SELECT net_amount FROM payroll WHERE job_id = 24)"),
    ),
    "q06_greater_than_any": (
        lambda t: greater_than_any(
            t.payroll, "net_amount", t.payroll.where("payment_status = 'PAID'"), "gross_amount"
        ).select("payroll_id"),
        q("""SELECT payroll_id FROM payroll
            WHERE net_amount > ANY (SELECT gross_amount FROM payroll WHERE payment_status = 'PAID')"""),
    ),
    "q07_derived_table": (
        lambda t: t.payroll.groupBy("emp_id").agg(F.count("*").alias("n")).groupBy("n").agg(
            F.count("*").alias("employees")
        ),
        q("""SELECT n, count(*) AS employees FROM (SELECT emp_id, count(*) AS n FROM payroll GROUP BY 1) GROUP BY n"""),
    ),
    "q08_chained_results": (
        lambda t: t.works_on.groupBy("essn", "pno").agg(F.sum("hours").alias("h"))
        .groupBy("essn").agg(F.max("h").alias("top_hours"), F.sum("h").alias("all_hours"))
        .select(joined(F.lit("E"), "essn").alias("worker"), "top_hours", "all_hours"),
        q("""WITH per AS (SELECT essn, pno, sum(hours) AS h FROM works_on GROUP BY ALL),
            best AS (SELECT essn, max(h) AS a, sum(h) AS b FROM per GROUP BY 1)
            SELECT 'E' || essn AS worker, a::DOUBLE AS top_hours, b::DOUBLE AS all_hours FROM best"""),
    ),
    "q09_hierarchy_walk": (_chain, q("""
        WITH l1 AS (SELECT employee_id AS node FROM employees WHERE manager_id IS NULL),
        l2 AS (SELECT employee_id AS node FROM employees INNER JOIN l1 ON manager_id = node),
        l3 AS (SELECT employee_id AS node FROM employees INNER JOIN l2 ON manager_id = node),
        l4 AS (SELECT employee_id AS node FROM employees INNER JOIN l3 ON manager_id = node),
        l5 AS (SELECT employee_id AS node FROM employees INNER JOIN l4 ON manager_id = node)
        SELECT node, lvl::BIGINT AS lvl, 1::DOUBLE AS paths FROM (SELECT node, 1 AS lvl FROM l1
            UNION ALL SELECT node, 2 FROM l2 UNION ALL SELECT node, 3 FROM l3
            UNION ALL SELECT node, 4 FROM l4 UNION ALL SELECT node, 5 FROM l5)""")),
}

# The same results with blocks so small that the tables cover many of them.
ANY_SIZE = {"block_rows": 1 << 10}
CHECKS |= {
    "w01_row_number_sliced": (lambda t: _numbered(t, **ANY_SIZE), CHECKS["w01_row_number"][1]),
    "w02_rank_sliced": (lambda t: _hour_ranks(t, slices=64), CHECKS["w02_rank"][1]),
    "w03_dense_rank_sliced": (
        lambda t: rank_rows(
            t.works_on, "hours", {"dense_rank": "dense_no", "rank": "rank_no"}, slices=64
        ),
        CHECKS["w03_dense_rank"][1],
    ),
    "w05_lag_lead_sliced": (
        lambda t: _running(
            t,
            {"before": previous("gross_amount"), "two_after": following("gross_amount", 2)},
            **ANY_SIZE,
        ),
        CHECKS["w05_lag_lead"][1],
    ),
    "w06_running_total_sliced": (
        lambda t: _running(
            t,
            {"running": running_sum("gross_amount"), "highest": largest_before("gross_amount")},
            **ANY_SIZE,
        ),
        CHECKS["w06_running_total"][1],
    ),
    "w07_moving_average_sliced": (
        lambda t: _running(t, {"near": moving_mean("gross_amount", 2, 2)}, **ANY_SIZE),
        CHECKS["w07_moving_average"][1],
    ),
    "w08_cumulative_count_sliced": (
        lambda t: _running(t, {"so_far": position()}, **ANY_SIZE),
        CHECKS["w08_cumulative_count"][1],
    ),
}
