"""Checks of quality jobs, change jobs, view functions, the payroll run and streams.

Batches of changes are derived from whole benchmark tables: proposed amounts from
lineitem, hires from supplier, leave decisions from orders, requests from events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import money
from rosterlake.operators import changes, lookups, quality
from rosterlake.operators.ordered import assign_keys
from rosterlake.plans import monitoring, views
from rosterlake.session import new_path
from rosterlake.sources import adapter
from rosterlake.sources.ledger import KeyLedger
from rosterlake.sources.loading import Tables
from rosterlake.sources.snapshots import BucketedSnapshot
from rosterlake.sources.schemas import FOREIGN_KEYS
from rosterlake.streaming.validation import read_committed, stream_validate_leave, stream_validate_payroll

from .sql import cents, div, num, q

DAY = "2024-01-15"
PAY_DAY = "2001-07-15"
ADMIN = "payroll_admin"
STEP = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "new_amount"]

# --- derived batches -------------------------------------------------------------------------


def raises(t: Tables) -> DataFrame:
    """Proposed amounts between 850 and 1050 for each pay row, many per row."""
    cent = F.round(F.col("l_extendedprice") * 100).cast("bigint") % 20000 + 85000
    amount = (cent.cast("decimal(14,2)") / 100).cast("decimal(12,2)")
    return t.raw_lineitem.select(
        F.col("l_partkey").alias("salary_id"),
        amount.alias("new_amount"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey",
    )


RAISES = """raises AS (SELECT l_partkey AS salary_id, l_shipdate, l_orderkey, l_linenumber, l_suppkey,
    ((round(l_extendedprice * 100)::BIGINT % 20000 + 85000)::DOUBLE / 100)::DECIMAL(12,2) AS new_amount FROM lineitem),
    met AS (SELECT salary_id, new_amount, greatest(amount, max(new_amount) OVER (PARTITION BY salary_id
        ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, new_amount
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS old_amount
        FROM raises INNER JOIN salary_bonus USING (salary_id))"""


def odd_raises(t: Tables) -> DataFrame:
    """Proposals of which some are for unknown pay rows and some have no amount."""
    amount = F.col("o_totalprice").cast("decimal(12,2)")
    return t.raw_orders.select(
        (F.col("o_orderkey") % 400).alias("salary_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", amount).alias("new_amount"),
        F.col("o_orderdate").alias("l_shipdate"),
        F.col("o_orderkey").alias("l_orderkey"),
        F.lit(1).alias("l_linenumber"),
        F.col("o_custkey").alias("l_suppkey"),
    )


ODD_RAISES = """odd_raises AS (SELECT o_orderkey % 400 AS salary_id,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice::DECIMAL(12,2) END AS new_amount,
    o_orderkey % 400 IN (SELECT salary_id FROM salary_bonus) AS known FROM orders)"""


def _guarded(t: Tables) -> changes.Outcome:
    return changes.guard_no_decrease(t.salary_bonus, raises(t), STEP, DAY, ADMIN)


def payroll_batch(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Payroll rows of which some lack the net amount or the deductions."""
    orders = t.raw_orders if orders is None else orders
    priority = F.col("_priority")
    rows = orders.select(*adapter.payroll_columns(), F.col("o_orderpriority").alias("_priority"))
    return rows.withColumns(
        {
            "net_amount": F.when(~priority.isin("1-URGENT", "5-LOW"), F.col("net_amount")),
            "deductions": F.when(priority != "1-URGENT", F.col("deductions")),
        }
    ).drop("_priority")


BATCH = """batch AS (SELECT payroll_id, payroll_date, gross_amount, emp_id, job_id, salary_id, leave_id, payment_status,
    CASE WHEN priority <> '1-URGENT' THEN deductions END AS deductions,
    CASE WHEN priority NOT IN ('1-URGENT', '5-LOW') THEN net_amount END AS net_amount FROM payroll),
    pay AS (SELECT emp_id, amount FROM employee e INNER JOIN salary_bonus s ON s.salary_id = e.salary_id),
    checked AS (SELECT batch.* EXCLUDE (net_amount), amount AS expected, CASE WHEN amount IS NOT NULL AND net_amount IS NULL
        THEN gross_amount - coalesce(deductions, 0) ELSE net_amount END AS net_amount
        FROM batch LEFT OUTER JOIN pay USING (emp_id))"""
CHECKED = """payroll_id, payroll_date::VARCHAR AS payroll_date, gross_amount::DOUBLE AS gross_amount,
    deductions::DOUBLE AS deductions, net_amount::DOUBLE AS net_amount, emp_id, job_id, salary_id,
    leave_id, payment_status"""
GAP = div(f"100 * abs({cents('gross_amount - expected')})", cents("expected"))
WARNING = f"""'Payroll variance: ' || {num(f'({GAP})::DECIMAL(18,2)')} || '% (Expected: $' || {num('expected')}
    || ', Actual: $' || {num('gross_amount')} || ')'"""


def hires(t: Tables) -> DataFrame:
    """New employees from suppliers: some without a name, with a bad gender or age, or with
    an e-mail that is taken by an employee or by another hire."""
    key = F.col("s_suppkey")
    mail = F.when(key % 6 == 0, key).when(key % 6 == 1, F.floor(key / 12) + 5_000_000_000)
    return t.raw_supplier.select(
        key.alias("batch_no"),
        F.when(key % 20 != 3, F.col("s_name")).alias("first_name"),
        F.lit("Newcomer").alias("last_name"),
        F.when(key % 7 == 5, "X").when(key % 2 == 0, "M").when(key % 7 != 6, "F").alias("gender"),
        F.when(key % 13 != 11, 10 + key % 70).cast("int").alias("age"),
        F.concat(F.lit("user"), mail, F.lit("@example.com")).alias("email"),
        F.lit("555-0000").alias("phone"),
        F.col("s_nationkey").cast("bigint").alias("job_id"),
        key.alias("salary_id"),
    )


HIRES = """hires AS (SELECT s_suppkey AS batch_no, CASE WHEN s_suppkey % 20 <> 3 THEN s_name END AS first_name,
    CASE WHEN s_suppkey % 7 = 5 THEN 'X' WHEN s_suppkey % 2 = 0 THEN 'M' WHEN s_suppkey % 7 <> 6 THEN 'F' END AS gender,
    CASE WHEN s_suppkey % 13 <> 11 THEN 10 + s_suppkey % 70 END AS age,
    CASE s_suppkey % 6 WHEN 0 THEN 'user' || s_suppkey || '@example.com'
        WHEN 1 THEN 'user' || (s_suppkey // 12 + 5000000000) || '@example.com' END AS email,
    s_nationkey::BIGINT AS job_id FROM supplier),
    coded AS (SELECT *, CASE WHEN first_name IS NULL THEN '-20001' WHEN gender NOT IN ('M', 'F') THEN '-20002'
        WHEN age NOT BETWEEN 18 AND 75 THEN '-20003' END AS code FROM hires),
    judged AS (SELECT *, CASE WHEN code IS NOT NULL THEN code
        WHEN email IN (SELECT email FROM employee WHERE email IS NOT NULL) THEN 'EMAIL_EXISTS'
        WHEN EXISTS (FROM coded o WHERE o.email = c.email AND o.code IS NULL AND o.batch_no < c.batch_no)
            THEN 'EMAIL_EXISTS' END AS reject_code FROM coded c)"""


def decisions(t: Tables) -> DataFrame:
    state = F.col("o_orderstatus")
    return t.raw_orders.select(
        F.col("o_orderkey").alias("leave_id"),
        F.when(state == "O", "APPROVED").when(state == "F", "REJECTED").otherwise("MAYBE").alias("status"),
        F.col("o_custkey").alias("approved_by"),
    )


DECISIONS = """decisions AS (SELECT o_orderkey AS leave_id, o_custkey AS approver, CASE o_orderstatus
    WHEN 'O' THEN 'APPROVED' WHEN 'F' THEN 'REJECTED' ELSE 'MAYBE' END AS verdict FROM orders)"""


def many_decisions(t: Tables) -> DataFrame:
    """Several decisions for a leave, numbered; some have no status, some leaves are unknown."""
    flag = F.col("l_returnflag")
    return t.raw_lineitem.select(
        F.col("l_orderkey").alias("leave_id"),
        F.when(flag == "A", "APPROVED").when(flag == "R", "REJECTED").alias("status"),
        F.col("l_suppkey").alias("approved_by"),
        F.col("l_linenumber").alias("step"),
    )


MANY_DECISIONS = """many AS (SELECT leave_id, verdict, approver, row_number() OVER (PARTITION BY leave_id
    ORDER BY step DESC, verdict DESC, approver DESC) AS age FROM (SELECT l_orderkey AS leave_id, l_linenumber AS step,
    CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'R' THEN 'REJECTED' ELSE 'PENDING' END AS verdict,
    l_suppkey AS approver FROM lineitem))"""


def requests(t: Tables) -> DataFrame:
    start = F.to_date("ts")
    return t.raw_events.select(
        F.col("event_id").alias("request_no"),
        F.col("user_id").alias("emp_id"),
        F.col("event_type").alias("leave_type"),
        start.alias("leave_start"),
        F.when(F.col("event_id") % 11 != 4, F.date_add(start, (F.col("event_id") % 9 - 3).cast("int"))).alias(
            "leave_end"
        ),
        F.col("props").alias("reason"),
    )


REQUESTS = """asked AS (SELECT event_id AS request_no, user_id AS emp_id, event_type AS leave_type,
    ts::DATE AS leave_start, CASE WHEN event_id % 11 <> 4 THEN ts::DATE + (event_id % 9 - 3)::INTEGER END AS leave_end,
    props AS reason FROM events), sized AS (SELECT *, leave_end - leave_start + 1 AS days FROM asked)"""


def leave_batch(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """Leave rows of which some end before they start and some have no status."""
    rows = adapter.leave(t.raw_events if events is None else events)
    shift = F.when(F.col("leave_id") % 8 == 1, 9).otherwise(0)
    return rows.withColumns(
        {
            "leave_end": F.date_sub("leave_end", shift),
            "status": F.when(F.col("leave_id") % 4 != 0, F.col("status")),
        }
    )


LEAVES = """arrived AS (SELECT leave_id, leave_type, leave_start,
    leave_end - CASE WHEN leave_id % 8 = 1 THEN 9 ELSE 0 END AS leave_end, reason,
    CASE WHEN leave_id % 4 <> 0 THEN status ELSE 'PENDING' END AS status, emp_id, approved_by FROM leave)"""
LEAVE_COLUMNS = """leave_id, leave_type, leave_start::VARCHAR AS leave_start, leave_end::VARCHAR AS leave_end,
    reason, status, emp_id, approved_by"""


def toxic(t: Tables) -> DataFrame:
    return t.raw_labels.where("toxic = 1").select(F.col("doc_id").alias("emp_id"))


GONE = "(SELECT doc_id FROM labels WHERE toxic = 1)"


def contacts(t: Tables) -> DataFrame:
    """Directory changes by supplier key; the job column must not get through."""
    return t.raw_supplier.select(
        F.col("s_suppkey").alias("emp_id"),
        F.col("s_name").alias("first_name"),
        F.lit("Renamed").alias("last_name"),
        F.lit(None).cast("string").alias("email"),
        F.lit("555-9999").alias("phone"),
        F.lit(7).cast("bigint").alias("job_id"),
    )


# --- larger jobs ------------------------------------------------------------------------------


def _deleted(table: str):
    def run(t: Tables) -> DataFrame:
        """Rows and set references per table after deleting departments 0 to 4."""
        keys = t.regions.select(F.col("region_id").alias("job_id"))
        rows = quality.delete_with_references(t, "job_department", keys)[table]
        return rows.select(*[c for c in rows.columns if c.endswith("_id")])

    return run


def _deleted_staff(table: str):
    def run(t: Tables) -> DataFrame:
        """Key columns of a table after deleting employees: their leaves and pay rows go, too."""
        rows = quality.delete_with_references(t, "employee", toxic(t))[table]
        return rows.select(*[c for c in rows.columns if c.endswith("_id")])

    return run


def bad_leave(t: Tables) -> DataFrame:
    """Leave rows of which some end before they start and some have a status out of the list."""
    status = F.when(F.col("leave_id") % 13 != 0, F.col("status")).otherwise("MAYBE")
    return leave_batch(t).withColumn("status", F.when(F.col("leave_id") % 4 != 0, status))


def bad_payroll(t: Tables) -> DataFrame:
    """Payroll rows that break each of the table's rules in some rows."""
    key = F.col("payroll_id")
    return t.payroll.withColumns(
        {
            "gross_amount": F.when(key % 7 == 0, -F.col("gross_amount")).otherwise(F.col("gross_amount")),
            "deductions": F.when(key % 11 == 0, F.lit(-1)).when(key % 5 != 1, F.col("deductions")),
            "payment_status": F.when(key % 5 == 0, "PROCESSING").when(key % 9 != 0, F.col("payment_status")),
        }
    )


def _rule_counts(rows: DataFrame, table: str) -> DataFrame:
    failed = F.array_join("failed_rules", ",").alias("failed")
    return quality.with_failed_rules(rows, quality.checks_of(table)).groupBy(failed).agg(F.count("*").alias("n"))


def _orphans(t: Tables) -> DataFrame:
    return quality.orphan_counts(t, FOREIGN_KEYS)


def _valid_and_rejected(table: str):
    def run(t: Tables) -> DataFrame:
        return quality.with_failed_rules(t[table], quality.checks_of(table)).groupBy(
            F.array_join("failed_rules", ",").alias("failed")
        ).agg(F.count("*").alias("n"))

    return run


def _dimension(t: Tables) -> DataFrame:
    wide = t.employee.join(t.job_department.select("job_id", "dept_name", "salary_range"), "job_id")
    return quality.extract_dimension(wide, "job_id", ["dept_name", "salary_range"])[0]


def _fact(t: Tables) -> DataFrame:
    wide = t.employee.join(t.job_department.select("job_id", "dept_name", "salary_range"), "job_id")
    return quality.extract_dimension(wide, "job_id", ["dept_name", "salary_range"])[1].select(
        "emp_id", "job_id", "salary_id"
    )


def _fd(t: Tables) -> DataFrame:
    return quality.fd_violations(t.employee, ["last_name", "age"], "job_id")


def _payroll_audit(t: Tables) -> DataFrame:
    return changes.validate_payroll(payroll_batch(t), t.employee, t.salary_bonus, PAY_DAY).audit


def _audit_counts(t: Tables) -> DataFrame:
    archive = changes.archive_deleted(t.employee, toxic(t), DAY, ADMIN).audit
    return monitoring.audit_counts(_guarded(t).audit, _payroll_audit(t), archive)


def _refreshed(summary):
    def run(t: Tables) -> DataFrame:
        base = new_path(t.employee.sparkSession, "summary")
        day = PAY_DAY if summary is not views.leave_statistics else DAY
        return views.refresh(summary(t, day), base)

    return run


def _run_part(part: str):
    def run(t: Tables) -> DataFrame:
        base = new_path(t.employee.sparkSession, "monthly")
        return getattr(monitoring.payroll_run(t, payroll_batch(t), PAY_DAY, base), part)

    return run


def _stream_payroll(part: str, ids: bool = False):
    def run(t: Tables) -> DataFrame:
        spark = t.employee.sparkSession
        out = new_path(spark, "stream")
        arriving = spark.readStream.schema(t.raw_orders.schema).parquet(f"{t.folder}/order[s].parquet")
        query = stream_validate_payroll(
            adapter.payroll(arriving), t.employee, t.salary_bonus, out, new_path(spark, "progress"), PAY_DAY
        )
        query.awaitTermination()
        found = read_committed(spark, out, part).drop("batch_id")
        return found.drop("audit_id") if part == "audit" and not ids else found

    return run


def _stream_leave(part: str):
    def run(t: Tables) -> DataFrame:
        spark = t.employee.sparkSession
        out = new_path(spark, "stream")
        arriving = spark.readStream.schema(t.raw_events.schema).parquet(f"{t.folder}/event[s].parquet")
        stream_validate_leave(leave_batch(t, arriving), out, new_path(spark, "progress")).awaitTermination()
        return read_committed(spark, out, part).drop("batch_id", "failed_rules")

    return run


def _stream_missing_net(t: Tables) -> DataFrame:
    """Arriving rows without a net amount or deductions get what the batch job gives them."""
    spark = t.employee.sparkSession
    out = new_path(spark, "stream")
    arriving = spark.readStream.schema(t.raw_orders.schema).parquet(f"{t.folder}/order[s].parquet")
    stream_validate_payroll(
        payroll_batch(t, arriving), t.employee, t.salary_bonus, out, new_path(spark, "progress"), PAY_DAY
    ).awaitTermination()
    return read_committed(spark, out, "accepted").drop("batch_id")


def _ledger_keys(t: Tables) -> DataFrame:
    """Keys of three batches of leaves; the second one is asked for twice."""
    spark = t.employee.sparkSession
    ledger = KeyLedger(spark, new_path(spark, "keys"))
    parts = [t.leave.where(F.col("leave_id") % 3 == k).select("leave_id") for k in range(3)]
    keyed = [ledger.assign(parts[k], ["leave_id"], "new_id", "leave", f"batch {k}") for k in (0, 1, 1, 2)]
    return keyed[0].union(keyed[2]).union(keyed[3])


def _bucketed(current: DataFrame, key: str, batch: DataFrame, apply) -> DataFrame:
    """The rows after ``apply`` has changed the buckets of a stored snapshot that ``batch`` falls into."""
    stored = BucketedSnapshot.create(current, new_path(current.sparkSession, "snapshot"), key, 16)
    stored.change(batch, apply)
    return stored.read()


def asked(t: Tables) -> DataFrame:
    """Keys of employees, of which some are unknown."""
    return t.raw_documents.select((F.col("doc_id") * 3).alias("emp_id"))


def _sql_view(t: Tables) -> DataFrame:
    views.register_views(t, PAY_DAY)
    return t.employee.sparkSession.sql(
        "SELECT dept_name, count(*) AS n, sum(base_salary) AS pay FROM vw_salary_info GROUP BY dept_name"
    )


KEYS = q("SELECT leave_id, 2999 + row_number() OVER (ORDER BY leave_start DESC, leave_id) AS new_id FROM leave")

CHECKS = {
    "n01_explode_multivalue": (
        lambda t: quality.explode_multivalue(t.raw_documents, "doc_id", "text").select(
            "doc_id", F.col("place").cast("bigint").alias("place"), F.md5("text").alias("value_md5")
        ),
        """SELECT doc_id, place, md5(trim(part, ' ')) AS value_md5 FROM (SELECT doc_id,
            unnest(string_split(text, ',')) AS part, generate_subscripts(string_split(text, ','), 1) AS place
            FROM documents)""",
    ),
    "n02_extract_dimension": (_dimension, q("""
        SELECT DISTINCT job_id, dept_name, salary_range FROM employee INNER JOIN job_department USING (job_id)""")),
    "n02_remaining_fact": (_fact, q("""
        SELECT emp_id, job_id, salary_id FROM employee INNER JOIN job_department USING (job_id)""")),
    "n03_fd_violations": (_fd, q("""
        SELECT last_name, age::BIGINT AS age, count(DISTINCT coalesce(job_id, -1)) AS distinct_values
        FROM employee GROUP BY 1, 2 HAVING count(DISTINCT coalesce(job_id, -1)) > 1""")),
    "n03_dependency_report": (
        lambda t: quality.dependency_report(
            t.employee, {("last_name", "age"): ("job_id", "gender", "hire_date"), ("emp_id",): ("first_name", "email")}
        ),
        q("""WITH by_name AS (SELECT count(DISTINCT job_id) + max((job_id IS NULL)::INTEGER) AS j,
                count(DISTINCT gender) + max((gender IS NULL)::INTEGER) AS g, count(DISTINCT hire_date) AS h
                FROM employee GROUP BY last_name, age)
            SELECT 'last_name,age' AS determinant, 'job_id' AS dependent, count(*) FILTER (j > 1) AS violations FROM by_name
            UNION ALL SELECT 'last_name,age', 'gender', count(*) FILTER (g > 1) FROM by_name
            UNION ALL SELECT 'last_name,age', 'hire_date', count(*) FILTER (h > 1) FROM by_name
            UNION ALL SELECT 'emp_id', 'first_name', 0 UNION ALL SELECT 'emp_id', 'email', 0"""),
    ),
    "n04_check_employee": (_valid_and_rejected("employee"), q("""
        SELECT concat_ws(',', CASE WHEN gender NOT IN ('M', 'F') THEN 'gender' END,
            CASE WHEN age NOT BETWEEN 18 AND 75 THEN 'age' END) AS failed, count(*) AS n FROM employee GROUP BY 1""")),
    "n04_check_salary": (
        lambda t: quality.check_rows(
            t.salary_bonus.join(
                t.employees.select(F.col("employee_id").alias("salary_id"), "salary"), "salary_id"
            ).withColumn("amount", F.col("salary")),
            quality.checks_of("salary_bonus"),
        )[1].select("salary_id", "amount", F.array_join("failed_rules", ",").alias("failed")),
        q("""SELECT salary_id, salary::DOUBLE AS amount, 'salary_positive' AS failed
            FROM salary_bonus INNER JOIN employees ON employee_id = salary_id WHERE salary <= 0"""),
    ),
    "n04_check_leave": (lambda t: _rule_counts(bad_leave(t), "leave"), q("""
        WITH bad AS (SELECT leave_start, leave_end - CASE WHEN leave_id % 8 = 1 THEN 9 ELSE 0 END AS leave_end,
            CASE WHEN leave_id % 4 = 0 THEN NULL WHEN leave_id % 13 = 0 THEN 'MAYBE' ELSE status END AS status FROM leave)
        SELECT concat_ws(',', CASE WHEN status NOT IN ('PENDING', 'APPROVED', 'REJECTED') THEN 'leave_status' END,
            CASE WHEN leave_end < leave_start THEN 'leave_dates' END) AS failed, count(*) AS n FROM bad GROUP BY 1""")),
    "n04_rejected_leave": (
        lambda t: quality.check_rows(bad_leave(t), quality.checks_of("leave"))[1].select("leave_id", "status"),
        q("""WITH bad AS (SELECT leave_id, leave_start, leave_end - CASE WHEN leave_id % 8 = 1 THEN 9 ELSE 0 END AS leave_end,
            CASE WHEN leave_id % 4 = 0 THEN NULL WHEN leave_id % 13 = 0 THEN 'MAYBE' ELSE status END AS status FROM leave)
            SELECT leave_id, status FROM bad WHERE status = 'MAYBE' OR leave_end < leave_start"""),
    ),
    "n04_check_payroll": (lambda t: _rule_counts(bad_payroll(t), "payroll"), q("""
        WITH bad AS (SELECT CASE WHEN payroll_id % 7 = 0 THEN -gross_amount ELSE gross_amount END AS gross,
            CASE WHEN payroll_id % 11 = 0 THEN -1 WHEN payroll_id % 5 <> 1 THEN deductions END AS ded,
            CASE WHEN payroll_id % 5 = 0 THEN 'PROCESSING' WHEN payroll_id % 9 <> 0 THEN payment_status END AS status
            FROM payroll)
        SELECT concat_ws(',', CASE WHEN gross <= 0 THEN 'payroll_gross' END,
            CASE WHEN ded < 0 THEN 'payroll_deductions' END,
            CASE WHEN status NOT IN ('PENDING', 'PROCESSED', 'PAID') THEN 'payroll_status' END) AS failed,
            count(*) AS n FROM bad GROUP BY 1""")),
    "n05_not_null_violations": (
        lambda t: quality.not_null_violations(t.employee, ["gender", "email", "job_id"]).select(
            "emp_id", F.array_join("failed_rules", ",").alias("failed")
        ),
        q("""SELECT emp_id, concat_ws(',', CASE WHEN gender IS NULL THEN 'gender' END,
            CASE WHEN email IS NULL THEN 'email' END, CASE WHEN job_id IS NULL THEN 'job_id' END) AS failed
            FROM employee WHERE gender IS NULL OR email IS NULL OR job_id IS NULL"""),
    ),
    "n06_unique_email": (
        lambda t: quality.unique_violations(t.employee, ["email"]),
        q("SELECT email, count(*) AS occurrences FROM employee WHERE email IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    ),
    "n06_unique_key": (
        lambda t: quality.unique_violations(t.qualification, ["qual_id"]),
        q("SELECT qual_id, count(*) AS occurrences FROM qualification GROUP BY 1 HAVING count(*) > 1"),
    ),
    "n07_orphan_rows": (
        lambda t: quality.orphan_rows(t.leave, t.employee, "emp_id", "emp_id").select("leave_id", "emp_id"),
        q("SELECT leave_id, emp_id FROM leave WHERE emp_id NOT IN (SELECT emp_id FROM employee)"),
    ),
    "n07_orphan_counts": (_orphans, q("""
        SELECT 'salary_bonus' AS child, 'job_id' AS fk, (SELECT count(*) FROM salary_bonus
            WHERE job_id NOT IN (SELECT job_id FROM job_department)) AS orphans
        UNION ALL SELECT 'employee', 'job_id', (SELECT count(*) FROM employee
            WHERE job_id NOT IN (SELECT job_id FROM job_department))
        UNION ALL SELECT 'employee', 'salary_id', (SELECT count(*) FROM employee
            WHERE salary_id NOT IN (SELECT salary_id FROM salary_bonus))
        UNION ALL SELECT 'qualification', 'emp_id', (SELECT count(*) FROM qualification
            WHERE emp_id NOT IN (SELECT emp_id FROM employee))
        UNION ALL SELECT 'leave', 'emp_id', (SELECT count(*) FROM leave
            WHERE emp_id NOT IN (SELECT emp_id FROM employee))
        UNION ALL SELECT 'payroll', 'emp_id', (SELECT count(*) FROM payroll
            WHERE emp_id NOT IN (SELECT emp_id FROM employee))
        UNION ALL SELECT 'payroll', 'leave_id', (SELECT count(*) FROM payroll
            WHERE leave_id NOT IN (SELECT leave_id FROM leave))
        UNION ALL SELECT 'books', 'author_id', (SELECT count(*) FROM books
            WHERE author_id NOT IN (SELECT author_id FROM authors))
        UNION ALL SELECT 'book_orders', 'book_id', (SELECT count(*) FROM book_orders
            WHERE book_id NOT IN (SELECT book_id FROM books))
        UNION ALL SELECT 'payroll', 'job_id', (SELECT count(*) FROM payroll
            WHERE job_id NOT IN (SELECT job_id FROM job_department))
        UNION ALL SELECT 'payroll', 'salary_id', (SELECT count(*) FROM payroll
            WHERE salary_id NOT IN (SELECT salary_id FROM salary_bonus))""")),
    "n08_cascade_delete": (
        lambda t: quality.cascade_delete(t.leave, "emp_id", toxic(t), "emp_id").select("leave_id", "emp_id"),
        q(f"SELECT leave_id, emp_id FROM leave WHERE emp_id NOT IN {GONE}"),
    ),
    "n09_set_null_on_delete": (
        lambda t: quality.set_null_on_delete(t.payroll, "salary_id", toxic(t), "emp_id").select(
            "payroll_id", "salary_id"
        ),
        q(f"""SELECT payroll_id, CASE WHEN salary_id NOT IN {GONE} THEN salary_id END AS salary_id FROM payroll"""),
    ),
    "n09_deleted_departments_pay": (_deleted("salary_bonus"), q("""
        SELECT salary_id, job_id FROM salary_bonus WHERE job_id > 4""")),
    "n09_deleted_departments_staff": (_deleted("employee"), q("""
        SELECT emp_id, CASE WHEN job_id > 4 THEN job_id END AS job_id,
            CASE WHEN salary_id NOT IN (SELECT salary_id FROM salary_bonus WHERE job_id <= 4) THEN salary_id END AS salary_id
        FROM employee""")),
    "n09_deleted_departments_payroll": (_deleted("payroll"), q("""
        SELECT payroll_id, emp_id, CASE WHEN job_id > 4 THEN job_id END AS job_id,
            CASE WHEN salary_id NOT IN (SELECT salary_id FROM salary_bonus WHERE job_id <= 4) THEN salary_id END AS salary_id,
            leave_id
        FROM payroll""")),
    "n09_deleted_staff_payroll": (_deleted_staff("payroll"), q(f"""
        SELECT payroll_id, emp_id, job_id, salary_id,
            CASE WHEN leave_id NOT IN (SELECT leave_id FROM leave WHERE emp_id IN {GONE}) THEN leave_id END AS leave_id
        FROM payroll WHERE emp_id NOT IN {GONE}""")),
    "n09_deleted_staff_leave": (_deleted_staff("leave"), q(f"""
        SELECT leave_id, emp_id FROM leave WHERE emp_id NOT IN {GONE}""")),
    "n10_assign_keys": (
        lambda t: assign_keys(t.leave.select("leave_id", "leave_start"), ["-leave_start", "leave_id"], "new_id", 3000)
        .drop("leave_start"),
        KEYS,
    ),
    "n10_assign_keys_sliced": (
        lambda t: assign_keys(
            t.leave.select("leave_id", "leave_start"), ["-leave_start", "leave_id"], "new_id", 3000
        ).drop("leave_start"),
        KEYS,
    ),
    "d01_apply_updates": (
        lambda t: changes.apply_updates(
            t.salary_bonus.select("salary_id", "amount", "job_id"),
            raises(t).withColumnRenamed("new_amount", "amount"),
            "salary_id",
            ["amount"],
            STEP[:-1],
        ),
        q("""WITH raises AS (SELECT l_partkey AS salary_id, arg_max(((round(l_extendedprice * 100)::BIGINT % 20000
                + 85000)::DOUBLE / 100)::DECIMAL(12,2), (l_shipdate, l_orderkey, l_linenumber, l_suppkey)) AS latest
            FROM lineitem GROUP BY 1)
            SELECT salary_id, coalesce(latest, amount)::DOUBLE AS amount, job_id
            FROM salary_bonus LEFT OUTER JOIN raises USING (salary_id)"""),
    ),
    "n10_ledger_keys": (_ledger_keys, q("""
        SELECT leave_id, 2999 + row_number() OVER (ORDER BY leave_id % 3, leave_id) AS new_id FROM leave""")),
    "d01_bucketed_updates": (
        lambda t: _bucketed(
            t.salary_bonus.select("salary_id", "amount", "job_id"),
            "salary_id",
            raises(t).withColumnRenamed("new_amount", "amount"),
            lambda rows, batch: changes.apply_updates(rows, batch, "salary_id", ["amount"], STEP[:-1]),
        ),
        q("""WITH raises AS (SELECT l_partkey AS salary_id, arg_max(((round(l_extendedprice * 100)::BIGINT % 20000
                + 85000)::DOUBLE / 100)::DECIMAL(12,2), (l_shipdate, l_orderkey, l_linenumber, l_suppkey)) AS latest
            FROM lineitem GROUP BY 1)
            SELECT salary_id, coalesce(latest, amount)::DOUBLE AS amount, job_id
            FROM salary_bonus LEFT OUTER JOIN raises USING (salary_id)"""),
    ),
    "d02_guard_audit": (lambda t: _guarded(t).audit, q(f"""
        WITH {RAISES} SELECT salary_id, old_amount::DOUBLE AS old_amount, new_amount::DOUBLE AS new_amount,
            (new_amount - old_amount)::DOUBLE AS change_amount, '{ADMIN}' AS changed_by, '{DAY}' AS changed_date,
            'Salary increase approved' AS reason FROM met WHERE new_amount > old_amount""")),
    "d02_audit_log": (
        lambda t: changes.audit_rows(
            _guarded(t).audit, "salary_audit_log", ["salary_id", "new_amount"]
        ).drop("changed_date"),
        q(f"""WITH {RAISES} SELECT row_number() OVER (ORDER BY salary_id, new_amount) AS audit_id, salary_id,
            old_amount::DOUBLE AS old_amount, new_amount::DOUBLE AS new_amount,
            (new_amount - old_amount)::DOUBLE AS change_amount, '{ADMIN}' AS changed_by,
            'Salary increase approved' AS reason FROM met WHERE new_amount > old_amount"""),
    ),
    "d02_guard_rejected": (lambda t: _guarded(t).rejected, q(f"""
        WITH {RAISES} SELECT salary_id, old_amount::DOUBLE AS old_amount, new_amount::DOUBLE AS new_amount,
            'SALARY CUT BLOCKED! Current: $' || {num('old_amount')} || ' Attempted: $' || {num('new_amount')}
            || ' Decrease of $' || {num('(old_amount - new_amount)')}
            || '. Contact HR Department for override.' AS message, '-20100' AS reject_code
        FROM met WHERE new_amount < old_amount""")),
    "d02_guard_odd_batch": (
        lambda t: changes.guard_no_decrease(t.salary_bonus, odd_raises(t), STEP, DAY, ADMIN).rejected.where(
            "reject_code <> '-20100'"
        ).select("salary_id", "new_amount", "reject_code"),
        q(f"""WITH {ODD_RAISES} SELECT salary_id, new_amount::DOUBLE AS new_amount,
            CASE WHEN known THEN 'AMOUNT_MISSING' ELSE 'SALARY_NOT_FOUND' END AS reject_code
            FROM odd_raises WHERE NOT known OR new_amount IS NULL"""),
    ),
    "d02_guard_odd_snapshot": (
        lambda t: changes.guard_no_decrease(t.salary_bonus, odd_raises(t), STEP, DAY, ADMIN).rows.select(
            "salary_id", "amount"
        ),
        q(f"""WITH {ODD_RAISES} SELECT salary_id, greatest(any_value(amount), max(new_amount))::DOUBLE AS amount
            FROM salary_bonus LEFT OUTER JOIN odd_raises USING (salary_id) GROUP BY 1"""),
    ),
    "d02_guard_snapshot": (
        lambda t: _guarded(t).rows.select("salary_id", "amount"),
        q(f"""WITH {RAISES} SELECT salary_id, greatest(any_value(amount), max(new_amount))::DOUBLE AS amount
            FROM salary_bonus LEFT OUTER JOIN met USING (salary_id) GROUP BY 1"""),
    ),
    "d03_archive_deleted": (
        lambda t: changes.archive_deleted(t.employee, toxic(t), DAY, ADMIN).audit,
        q(f"""SELECT emp_id, first_name, last_name, gender, age::BIGINT AS age, email, phone,
            hire_date::VARCHAR AS hire_date, job_id, salary_id, '{DAY}' AS archived_date, '{ADMIN}' AS archived_by,
            'Automatically archived on deletion' AS archive_reason FROM employee WHERE emp_id IN {GONE}"""),
    ),
    "d03_remaining": (
        lambda t: changes.archive_deleted(t.employee, toxic(t), DAY, ADMIN).rows.select("emp_id"),
        q(f"SELECT emp_id FROM employee WHERE emp_id NOT IN {GONE}"),
    ),
    "d04_payroll_accepted": (
        lambda t: changes.validate_payroll(payroll_batch(t), t.employee, t.salary_bonus, PAY_DAY).rows,
        q(f"WITH {BATCH} SELECT {CHECKED} FROM checked"),
    ),
    "d04_payroll_audit": (_payroll_audit, q(f"""
        WITH {BATCH} SELECT payroll_id, emp_id, 'VARIANCE_WARNING' AS audit_type, {WARNING} AS message,
            '{PAY_DAY}' AS audit_date FROM checked WHERE 5 * abs(gross_amount - expected) > expected""")),
    "d04_audit_log": (
        lambda t: changes.audit_rows(_payroll_audit(t), "payroll_audit", ["payroll_id"]),
        q(f"""WITH {BATCH} SELECT row_number() OVER (ORDER BY payroll_id) AS audit_id, payroll_id, emp_id,
            'VARIANCE_WARNING' AS audit_type, {WARNING} AS message, '{PAY_DAY}' AS audit_date
            FROM checked WHERE 5 * abs(gross_amount - expected) > expected"""),
    ),
    "d05_leave_accepted": (lambda t: changes.validate_leave(leave_batch(t)).rows, q(f"""
        WITH {LEAVES} SELECT {LEAVE_COLUMNS} FROM arrived WHERE leave_end IS NULL OR leave_end >= leave_start""")),
    "d05_leave_rejected": (
        lambda t: changes.validate_leave(leave_batch(t)).rejected.drop("failed_rules"),
        q(f"WITH {LEAVES} SELECT {LEAVE_COLUMNS} FROM arrived WHERE leave_end < leave_start"),
    ),
    "d05_status_changes": (
        lambda t: changes.status_changes(t.leave, changes.decide_leave(t.leave, decisions(t)).rows),
        q(f"""WITH {DECISIONS} SELECT leave_id, emp_id, verdict AS new_status, status AS old_status
            FROM leave INNER JOIN decisions USING (leave_id) WHERE verdict <> 'MAYBE' AND verdict <> status"""),
    ),
    "d06_update_directory": (
        lambda t: changes.update_directory(t.employee, contacts(t)).drop("hire_date", "age", "gender"),
        q("""SELECT emp_id, coalesce(s_name, first_name) AS first_name,
            CASE WHEN s_suppkey IS NULL THEN last_name ELSE 'Renamed' END AS last_name,
            CASE WHEN s_suppkey IS NULL THEN email END AS email,
            CASE WHEN s_suppkey IS NULL THEN phone ELSE '555-9999' END AS phone, job_id, salary_id
            FROM employee LEFT OUTER JOIN supplier ON s_suppkey = emp_id"""),
    ),
    "d06_many_changes": (
        lambda t: changes.update_directory(
            t.employee,
            t.raw_orders.select(
                F.col("o_custkey").alias("emp_id"),
                F.col("o_orderpriority").alias("first_name"),
                F.lit("Renamed").alias("last_name"),
                F.col("o_orderkey").cast("string").alias("email"),
                F.lit("555-9999").alias("phone"),
                "o_orderkey",
            ),
            ["o_orderkey"],
        ).select("emp_id", "first_name", "last_name", "email", "phone"),
        q("""SELECT emp_id, coalesce(priority, first_name) AS first_name,
            CASE WHEN priority IS NULL THEN last_name ELSE 'Renamed' END AS last_name,
            CASE WHEN priority IS NULL THEN email ELSE newest::VARCHAR END AS email,
            CASE WHEN priority IS NULL THEN phone ELSE '555-9999' END AS phone
            FROM employee LEFT OUTER JOIN (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS priority,
                max(o_orderkey) AS newest FROM orders GROUP BY 1) ON o_custkey = emp_id"""),
    ),
    "d06_bucketed_directory": (
        lambda t: _bucketed(t.employee, "emp_id", contacts(t), changes.update_directory).drop("hire_date", "age", "gender"),
        q("""SELECT emp_id, coalesce(s_name, first_name) AS first_name,
            CASE WHEN s_suppkey IS NULL THEN last_name ELSE 'Renamed' END AS last_name,
            CASE WHEN s_suppkey IS NULL THEN email END AS email,
            CASE WHEN s_suppkey IS NULL THEN phone ELSE '555-9999' END AS phone, job_id, salary_id
            FROM employee LEFT OUTER JOIN supplier ON s_suppkey = emp_id"""),
    ),
    "d07_payroll_notices": (
        lambda t: changes.payroll_notices(t.payroll, t.employee),
        q(f"""SELECT payroll_id, emp_id, 'Notification: Payroll processed for ' || first_name || ' ' || last_name
            || ' - Net: $' || {num('net_amount')} AS notice FROM payroll INNER JOIN employee USING (emp_id)"""),
    ),
    "d08_hires": (
        lambda t: changes.add_employees(t.employee, hires(t), "batch_no", DAY).audit.select(
            "emp_id", "first_name", "gender", "age", "email", "hire_date", "job_id"
        ),
        q(f"""WITH {HIRES} SELECT (SELECT max(emp_id) FROM employee) + row_number() OVER (ORDER BY batch_no) AS emp_id,
            first_name, gender, age, email, '{DAY}' AS hire_date, job_id FROM judged WHERE reject_code IS NULL"""),
    ),
    "d08_rejected": (
        lambda t: changes.add_employees(t.employee, hires(t), "batch_no", DAY).rejected.select(
            "batch_no", "reject_code"
        ),
        q(f"WITH {HIRES} SELECT batch_no, reject_code FROM judged WHERE reject_code IS NOT NULL"),
    ),
    "d09_add_qualifications": (
        lambda t: changes.add_qualifications(
            t.raw_conversations.select(
                (F.col("conv_id") * 20).alias("emp_id"),
                F.concat(F.lit("Course "), F.col("turn")).alias("qual_title"),
                F.col("role").alias("qual_type"),
            ),
            t.employee,
            DAY,
        ).rows,
        q(f"""SELECT conv_id * 20 AS emp_id, 'Course ' || turn AS qual_title, role AS qual_type, '{DAY}' AS grant_date
            FROM conversations WHERE conv_id * 20 IN (SELECT emp_id FROM employee)"""),
    ),
    "d10_leave_decided": (
        lambda t: changes.decide_leave(t.leave, decisions(t)).rows.select("leave_id", "status", "approved_by"),
        q(f"""WITH {DECISIONS} SELECT leave_id, CASE WHEN verdict <> 'MAYBE' THEN verdict ELSE status END AS status,
            CASE WHEN verdict <> 'MAYBE' THEN approver ELSE approved_by END AS approved_by
            FROM leave LEFT OUTER JOIN decisions USING (leave_id)"""),
    ),
    "d10_bucketed_decisions": (
        lambda t: _bucketed(
            t.leave, "leave_id", decisions(t), lambda rows, batch: changes.decide_leave(rows, batch).rows
        ).select("leave_id", "status", "approved_by"),
        q(f"""WITH {DECISIONS} SELECT leave_id, CASE WHEN verdict <> 'MAYBE' THEN verdict ELSE status END AS status,
            CASE WHEN verdict <> 'MAYBE' THEN approver ELSE approved_by END AS approved_by
            FROM leave LEFT OUTER JOIN decisions USING (leave_id)"""),
    ),
    "d10_rejected": (
        lambda t: changes.decide_leave(t.leave, decisions(t)).rejected.select("leave_id", "reject_code"),
        q(f"""WITH {DECISIONS} SELECT leave_id, CASE verdict WHEN 'MAYBE' THEN '-20020' ELSE 'LEAVE_NOT_FOUND' END
            AS reject_code FROM decisions WHERE verdict = 'MAYBE' OR leave_id NOT IN (SELECT leave_id FROM leave)"""),
    ),
    "d10_many_decisions": (
        lambda t: changes.decide_leave(t.leave, many_decisions(t), ["step"]).rows.select(
            "leave_id", "status", "approved_by"
        ),
        q(f"""WITH {MANY_DECISIONS} SELECT leave_id, coalesce(verdict, status) AS status,
            CASE WHEN verdict IS NULL THEN approved_by ELSE approver END AS approved_by
            FROM leave LEFT OUTER JOIN (SELECT * FROM many WHERE age = 1) USING (leave_id)"""),
    ),
    "d10_many_rejected": (
        lambda t: changes.decide_leave(t.leave, many_decisions(t), ["step"]).rejected.select(
            "leave_id", "approved_by", "reject_code"
        ),
        q(f"""WITH {MANY_DECISIONS}, marked AS (SELECT *, leave_id IN (SELECT leave_id FROM leave) AS known FROM many)
            SELECT leave_id, approver AS approved_by, CASE WHEN known THEN 'SUPERSEDED' ELSE 'LEAVE_NOT_FOUND' END
            AS reject_code FROM marked WHERE NOT known OR age > 1"""),
    ),
    "d11_leave_requested": (
        lambda t: changes.request_leave(requests(t)).rows.select(
            "request_no", "emp_id", "leave_end", "days", "status", "result"
        ),
        f"""WITH {REQUESTS} SELECT request_no, emp_id, leave_end::VARCHAR AS leave_end, days, 'PENDING' AS status,
            concat('SUCCESS: Leave request submitted (', days, ' days)') AS result
            FROM sized WHERE days IS NULL OR days > 0""",
    ),
    "d11_rejected": (
        lambda t: changes.request_leave(requests(t)).rejected.select("request_no", "days", "result"),
        f"""WITH {REQUESTS} SELECT request_no, days, CASE WHEN days < 0
            THEN 'ERROR: End date must be after start date' ELSE 'ERROR: leave_dates' END AS result
            FROM sized WHERE days <= 0""",
    ),
    "d12_process_payroll": (
        lambda t: changes.process_payroll(t.payroll.select("payroll_id", "emp_id", "gross_amount")),
        q(f"""SELECT payroll_id, emp_id, gross_amount::DOUBLE AS gross_amount,
            {div(cents('gross_amount') + ' * 30', '100', 0)} / 100 AS deductions,
            ({cents('gross_amount')} - {div(cents('gross_amount') + ' * 30', '100', 0)}) / 100 AS net_amount,
            'PROCESSED' AS payment_status FROM payroll"""),
    ),
    "d13_bulk_payroll": (
        lambda t: changes.bulk_payroll(
            t.employee.select("emp_id", "job_id", "salary_id").join(
                t.salary_bonus.select("salary_id", F.col("amount").alias("gross")), "salary_id"
            ),
            PAY_DAY,
        ),
        q(f"""SELECT '{PAY_DAY}' AS payroll_date, amount::DOUBLE AS gross_amount,
            {div(cents('amount') + ' * 20', '100', 0)} / 100 AS deductions,
            ({cents('amount')} - {div(cents('amount') + ' * 20', '100', 0)}) / 100 AS net_amount,
            emp_id, e.job_id, e.salary_id, 'PROCESSED' AS payment_status
            FROM employee e INNER JOIN salary_bonus s ON s.salary_id = e.salary_id"""),
    ),
    "v01_net_salary": (lambda t: lookups.net_salary(asked(t), t.employee, t.salary_bonus).rows, q("""
        SELECT emp_id, ((amount + coalesce(bonus_amount, 0)) * 0.70)::DOUBLE AS net
        FROM documents INNER JOIN employee e ON emp_id = doc_id * 3
        INNER JOIN salary_bonus s ON s.salary_id = e.salary_id""")),
    "v01_rejected": (lambda t: lookups.net_salary(asked(t), t.employee, t.salary_bonus).rejected, q("""
        SELECT doc_id * 3 AS emp_id, '-20030' AS reject_code FROM documents WHERE doc_id * 3 NOT IN
        (SELECT emp_id FROM employee e INNER JOIN salary_bonus s ON s.salary_id = e.salary_id)""")),
    "v02_net_salary_pkg": (lambda t: lookups.net_salary_pkg(asked(t), t.employee, t.salary_bonus), q("""
        SELECT doc_id * 3 AS emp_id, coalesce(amount + coalesce(bonus_amount, 0) * 0.70, 0)::DOUBLE AS net
        FROM documents LEFT OUTER JOIN employee e ON emp_id = doc_id * 3
        LEFT OUTER JOIN salary_bonus s ON s.salary_id = e.salary_id""")),
    "v03_days_employed": (lambda t: lookups.days_employed(asked(t), t.employee, DAY), q(f"""
        SELECT doc_id * 3 AS emp_id, coalesce(DATE '{DAY}' - hire_date, 0) AS days
        FROM documents LEFT OUTER JOIN employee ON emp_id = doc_id * 3""")),
    "v04_dept_headcount": (
        lambda t: lookups.dept_headcount(t.raw_documents.select((F.col("doc_id") % 40).alias("job_id")), t.employee),
        q("""SELECT doc_id % 40 AS job_id, coalesce(n, 0) AS headcount FROM documents
            LEFT OUTER JOIN (SELECT job_id, count(*) AS n FROM employee GROUP BY 1) e ON e.job_id = doc_id % 40"""),
    ),
    "v05_employee_name": (lambda t: lookups.employee_name(asked(t), t.employee), q("""
        SELECT doc_id * 3 AS emp_id, coalesce(first_name || ' ' || last_name, 'Unknown') AS employee_name
        FROM documents LEFT OUTER JOIN employee ON emp_id = doc_id * 3""")),
    "v06_bonus": (
        lambda t: lookups.bonus(t.raw_documents.select((F.col("doc_id") * 3).alias("salary_id")), t.salary_bonus, "1.25"),
        q(f"""SELECT doc_id * 3 AS salary_id, CASE WHEN s.salary_id IS NULL THEN 0
            ELSE {div(cents('bonus_amount') + ' * 125', '100', 0)} / 100 END AS bonus
            FROM documents LEFT OUTER JOIN salary_bonus s ON s.salary_id = doc_id * 3"""),
    ),
    "v07_view_in_sql": (_sql_view, q("""
        SELECT dept_name, count(*) AS n, sum(amount)::DOUBLE AS pay FROM employee e
        INNER JOIN job_department d ON d.job_id = e.job_id INNER JOIN salary_bonus s ON s.salary_id = e.salary_id
        GROUP BY 1""")),
    "v08_refreshed_monthly_payroll": (
        lambda t: _refreshed(views.monthly_payroll)(t).select(
            "payroll_month", "dept_name", "payroll_records", "total_net"
        ),
        q("""SELECT date_trunc('month', payroll_date)::DATE::VARCHAR AS payroll_month, dept_name,
            count(*) AS payroll_records, sum(net_amount)::DOUBLE AS total_net
            FROM payroll INNER JOIN job_department USING (job_id) WHERE payroll_date >= DATE '2000-07-01'
            GROUP BY 1, 2"""),
    ),
    "v08_refreshed_department_summary": (
        lambda t: _refreshed(views.department_summary)(t).select(
            "job_id", "dept_name", "headcount", "total_salary_budget", "total_payroll_records", "last_refreshed"
        ),
        q(f"""WITH per AS (SELECT e.job_id, count(*) AS headcount, sum(amount) AS budget, count(payroll_id) AS records
            FROM employee e LEFT OUTER JOIN salary_bonus s ON s.salary_id = e.salary_id
            LEFT OUTER JOIN payroll p ON p.emp_id = e.emp_id GROUP BY 1)
            SELECT d.job_id, dept_name, coalesce(headcount, 0) AS headcount, budget::DOUBLE AS total_salary_budget,
            coalesce(records, 0) AS total_payroll_records, '{PAY_DAY}' AS last_refreshed
            FROM job_department d LEFT OUTER JOIN per ON per.job_id = d.job_id"""),
    ),
    "v08_refreshed_leave_statistics": (
        lambda t: _refreshed(views.leave_statistics)(t).select("dept_name", "total_leave_requests"),
        q("""SELECT dept_name, count(*) AS total_leave_requests
            FROM leave INNER JOIN employee USING (emp_id) INNER JOIN job_department USING (job_id) GROUP BY 1"""),
    ),
    "v09_daily_audit": (lambda t: monitoring.daily_audit(t, PAY_DAY), q(f"""
        SELECT *, missing + warnings AS records_affected, CASE WHEN missing > 0 THEN 'FAILED'
            WHEN warnings > 0 THEN 'WARNING' ELSE 'SUCCESS' END AS status
        FROM (SELECT (SELECT count(*) FROM employee WHERE emp_id NOT IN (SELECT emp_id FROM payroll
                WHERE payroll_date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31')) AS missing,
            (SELECT count(*) FROM payroll p INNER JOIN employee e USING (emp_id)
                INNER JOIN salary_bonus s ON s.salary_id = e.salary_id WHERE payroll_date = DATE '{PAY_DAY}'
                AND abs(gross_amount - amount) * 2 > amount) AS warnings)""")),
    "v10_log_by_status": (
        lambda t: t.job_execution_log.groupBy("job_name").agg(
            F.count("*").alias("runs"),
            money.percent(F.count_if(F.col("status") == "SUCCESS"), F.count("*")).alias("success_rate"),
        ),
        q(f"""SELECT job_name, count(*) AS runs, {div("100 * count(*) FILTER (status = 'SUCCESS')::HUGEINT",
            'count(*)::HUGEINT')} AS success_rate FROM job_execution_log GROUP BY 1"""),
    ),
    "v11_run_processed": (
        lambda t: _run_part("processed")(t).select("payroll_id", "deductions", "net_amount", "payment_status"),
        q(f"""SELECT payroll_id, {div(cents('gross_amount') + ' * 30', '100', 0)} / 100 AS deductions,
            ({cents('gross_amount')} - {div(cents('gross_amount') + ' * 30', '100', 0)}) / 100 AS net_amount,
            'PROCESSED' AS payment_status FROM payroll"""),
    ),
    "v11_run_audit": (
        lambda t: _run_part("audit")(t).select("audit_id", "payroll_id", "message"),
        q(f"""WITH {BATCH} SELECT row_number() OVER (ORDER BY payroll_id) AS audit_id, payroll_id, {WARNING} AS message
            FROM checked WHERE 5 * abs(gross_amount - expected) > expected"""),
    ),
    "v11_run_report": (
        lambda t: _run_part("report")(t).select("payroll_month", "dept_name", "payroll_records"),
        q("""SELECT date_trunc('month', payroll_date)::DATE::VARCHAR AS payroll_month, dept_name,
            2 * count(*) AS payroll_records FROM payroll INNER JOIN job_department USING (job_id)
            WHERE payroll_date >= DATE '2000-07-01' GROUP BY 1, 2"""),
    ),
    "v11_run_steps": (
        lambda t: _run_part("steps")(t).where("step <> 'report'"),
        q("""SELECT 'validated' AS step, (SELECT count(*) FROM payroll) AS rows, 0::BIGINT AS position
            UNION ALL SELECT 'processed', (SELECT count(*) FROM payroll), 1
            UNION ALL SELECT 'audit', (SELECT count(*) FROM payroll p INNER JOIN employee e USING (emp_id)
                INNER JOIN salary_bonus s ON s.salary_id = e.salary_id
                WHERE 5 * abs(gross_amount - amount) > amount), 2
            UNION ALL SELECT 'checks', 1, 3"""),
    ),
    "v11_run_checks": (
        lambda t: _run_part("checks")(t),
        q(f"""SELECT *, missing + warnings AS records_affected, CASE WHEN missing > 0 THEN 'FAILED'
            WHEN warnings > 0 THEN 'WARNING' ELSE 'SUCCESS' END AS status
            FROM (SELECT (SELECT count(*) FROM employee WHERE emp_id NOT IN (SELECT emp_id FROM payroll
                WHERE payroll_date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31')) AS missing,
            (SELECT 2 * count(*) FROM payroll p INNER JOIN employee e USING (emp_id)
                INNER JOIN salary_bonus s ON s.salary_id = e.salary_id WHERE payroll_date = DATE '{PAY_DAY}'
                AND abs(gross_amount - amount) * 2 > amount) AS warnings)"""),
    ),
    "au01_audit_counts": (_audit_counts, q(f"""
        WITH {RAISES}, {BATCH}
        SELECT 'Salary Changes' AS audit_type, (SELECT count(*) FROM met WHERE new_amount > old_amount) AS total
        UNION ALL SELECT 'Payroll Issues',
            (SELECT count(*) FROM checked WHERE 5 * abs(gross_amount - expected) > expected)
        UNION ALL SELECT 'Archived Employees', (SELECT count(*) FROM employee WHERE emp_id IN {GONE})""")),
    "t01_stream_payroll": (_stream_payroll("accepted"), q(f"SELECT {CHECKED} FROM payroll")),
    "t01_stream_payroll_audit": (_stream_payroll("audit"), q(f"""
        WITH checked AS (SELECT payroll_id, emp_id, gross_amount, amount AS expected FROM payroll p
            INNER JOIN employee e USING (emp_id) INNER JOIN salary_bonus s ON s.salary_id = e.salary_id)
        SELECT payroll_id, emp_id, 'VARIANCE_WARNING' AS audit_type, {WARNING} AS message, '{PAY_DAY}' AS audit_date
        FROM checked WHERE 5 * abs(gross_amount - expected) > expected""")),
    "t01_stream_audit_ids": (
        lambda t: _stream_payroll("audit", ids=True)(t).select("audit_id", "payroll_id"),
        q("""SELECT row_number() OVER (ORDER BY payroll_id) AS audit_id, payroll_id FROM payroll p
            INNER JOIN employee e USING (emp_id) INNER JOIN salary_bonus s ON s.salary_id = e.salary_id
            WHERE 5 * abs(gross_amount - amount) > amount"""),
    ),
    "t01_stream_missing_net": (_stream_missing_net, q(f"WITH {BATCH} SELECT {CHECKED} FROM checked")),
    "t02_stream_leave": (_stream_leave("accepted"), q(f"""
        WITH {LEAVES} SELECT {LEAVE_COLUMNS} FROM arrived WHERE leave_end IS NULL OR leave_end >= leave_start""")),
    "t02_stream_leave_rejected": (_stream_leave("rejected"), q(f"""
        WITH {LEAVES} SELECT {LEAVE_COLUMNS} FROM arrived WHERE leave_end < leave_start""")),
}
