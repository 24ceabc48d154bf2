"""SQL text helpers: the adapter views as CTEs, and exact decimal rounding.

Division of decimals gives doubles in the checking database, so rounded quotients are
written as integer arithmetic there: half away from zero, without an intermediate value.
"""

from __future__ import annotations

import re

VIEWS = {
    "employee": """SELECT c_custkey AS emp_id, c_name AS first_name, c_mktsegment AS last_name,
        CASE WHEN c_custkey % 10 = 9 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
        18 + c_custkey % 60 AS age,
        CASE WHEN c_custkey % 11 <> 10 THEN 'user'
            || (c_custkey - CASE WHEN c_custkey % 50 = 49 THEN 1 ELSE 0 END) || '@example.com' END AS email,
        '555-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS phone,
        DATE '2010-01-01' + (c_custkey % 5000)::INTEGER AS hire_date,
        CASE WHEN c_nationkey <> 24 THEN c_nationkey::BIGINT END AS job_id,
        CASE WHEN c_custkey % 17 <> 16 THEN c_custkey END AS salary_id
        FROM customer""",
    "job_department": """SELECT n_nationkey::BIGINT AS job_id, n_name AS dept_name,
        n_name || ' department' AS dept_description, 'R' || n_regionkey AS salary_range FROM nation""",
    "salary_bonus": """SELECT p_partkey AS salary_id, p_retailprice::DECIMAL(12,2) AS amount,
        CASE WHEN p_partkey % 10 <> 7 THEN p_size::DECIMAL(12,2) END AS bonus_amount,
        (p_size % 8)::DECIMAL(5,2) AS annual_increase, (p_size % 25)::BIGINT AS job_id FROM part""",
    "payroll": """SELECT o_orderkey AS payroll_id, o_orderdate::DATE AS payroll_date, g AS gross_amount,
        ded AS deductions, (g - ded)::DECIMAL(12,2) AS net_amount, o_custkey AS emp_id,
        CASE WHEN o_custkey % 25 <> 24 THEN o_custkey % 25 END AS job_id, o_custkey AS salary_id,
        CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS leave_id,
        CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'F' THEN 'PROCESSED' ELSE 'PAID' END AS payment_status,
        o_orderpriority AS priority
        FROM (SELECT *, o_totalprice::DECIMAL(12,2) AS g,
                round(o_totalprice::DECIMAL(12,2) * 0.20, 2)::DECIMAL(12,2) AS ded FROM orders)""",
    "leave": """SELECT event_id AS leave_id,
        CASE event_type WHEN 'error' THEN 'SICK' WHEN 'click' THEN 'VACATION' ELSE upper(event_type) END AS leave_type,
        ts::DATE AS leave_start,
        CASE WHEN event_id % 10 <> 0 THEN ts::DATE + (event_id % 7)::INTEGER END AS leave_end, props AS reason,
        CASE event_id % 3 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'APPROVED' ELSE 'REJECTED' END AS status,
        CASE WHEN event_id % 97 = 5 THEN -1 - user_id ELSE user_id END AS emp_id,
        CASE WHEN event_id % 10 <> 3 THEN user_id // 10 END AS approved_by FROM events""",
    "qualification": """SELECT l_orderkey * 8 + l_linenumber AS qual_id, 'Course ' || l_partkey AS qual_title,
        CASE l_returnflag WHEN 'A' THEN 'CERTIFICATION' WHEN 'N' THEN 'DEGREE' ELSE 'TRAINING' END AS qual_type,
        l_shipdate::DATE AS grant_date, l_suppkey AS emp_id FROM lineitem""",
    "job_execution_log": """SELECT event_id AS log_id, event_type AS job_name, ts AS execution_start,
        CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'WARNING' ELSE 'SUCCESS' END AS status,
        user_id AS records_affected, value::DECIMAL(18,3) AS execution_time_sec FROM events""",
    "employees": """SELECT c_custkey AS employee_id, c_name AS first_name, c_mktsegment AS last_name,
        c_acctbal::DECIMAL(12,2) AS salary, c_mktsegment AS job_id,
        CASE WHEN c_nationkey <> 24 THEN c_nationkey::BIGINT END AS department_id,
        CASE WHEN c_custkey <> 0 THEN (c_custkey - 1) // 10 END AS manager_id FROM customer""",
    "departments": """SELECT n_nationkey::BIGINT AS department_id, n_name AS department_name,
        CASE WHEN n_nationkey % 9 <> 8 THEN n_nationkey::BIGINT * 5 END AS manager_id,
        n_nationkey::BIGINT AS location_id FROM nation""",
    "jobs": "SELECT DISTINCT c_mktsegment AS job_id, 'Job ' || c_mktsegment AS job_title FROM customer",
    "locations": """SELECT n_nationkey::BIGINT AS location_id, 'City ' || n_name AS city,
        n_nationkey::BIGINT AS country_id FROM nation""",
    "countries": """SELECT n_nationkey::BIGINT AS country_id, 'Country ' || n_name AS country_name,
        n_regionkey::BIGINT AS region_id FROM nation""",
    "regions": "SELECT r_regionkey::BIGINT AS region_id, r_name AS region_name FROM region",
    "company_employee": """SELECT c_custkey AS ssn, c_name AS fname, c_mktsegment AS lname,
        CASE WHEN c_nationkey <> 24 THEN c_nationkey::BIGINT END AS dno,
        CASE WHEN c_custkey <> 0 THEN (c_custkey - 1) // 10 END AS super_ssn FROM customer""",
    "company_department": "SELECT n_nationkey::BIGINT AS dnum, n_name AS dname FROM nation",
    "project": "SELECT p_partkey AS pnumber, p_name AS pname, (p_size % 25)::BIGINT AS dno FROM part",
    "works_on": """SELECT l_suppkey AS essn, l_partkey AS pno, l_quantity::DECIMAL(4,1) AS hours
        FROM lineitem""",
    "authors": "SELECT s_suppkey AS author_id, s_name AS first_name FROM supplier",
    "books": "SELECT p_partkey AS book_id, p_name AS title, p_partkey // 10 AS author_id FROM part",
    "book_orders": "SELECT o_orderkey AS order_id, o_custkey AS book_id FROM orders",
    "dependent": """SELECT doc_id AS essn, 'Dependent ' || doc_id AS dependent_name,
        CASE WHEN toxic = 0 THEN CASE quality WHEN 1 THEN 'Child' ELSE 'Spouse' END END AS relationship
        FROM labels""",
}


def q(body: str) -> str:
    """The query with the adapter views it names put in front as CTEs."""
    body = body.strip()
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", body)]
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in used)
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def cents(x: str) -> str:
    """An amount with two decimals as an integer."""
    return f"CAST(({x}) * 100 AS HUGEINT)"


def div(num: str, den: str, digits: int = 2) -> str:
    """Quotient of two integer expressions, rounded half away from zero; NULL by zero."""
    scale = 10**digits
    return (
        f"(CASE WHEN ({den}) <> 0 THEN CAST((CASE WHEN (({num}) < 0) <> (({den}) < 0) THEN -1 ELSE 1 END)"
        f" * ((2 * {scale} * abs({num}) + abs({den})) // (2 * abs({den}))) AS DOUBLE) / {scale} END)"
    )


def avg2(x: str) -> str:
    """Average of an amount, rounded to two decimals."""
    total = f"sum({cents(x)})"
    return f"({div(total, f'count({x})::HUGEINT', 0)} / 100)"


def money(x: str) -> str:
    """Dollar text of 12 characters."""
    digits = f"format('{{:,.2f}}', abs({x})::DOUBLE)"
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN abs({x}) >= 1000000 THEN repeat('#', 12) ELSE "
        f"lpad(CASE WHEN {x} < 0 THEN '-$' ELSE '$' END || CASE WHEN abs({x}) < 1 THEN "
        f"substr({digits}, 2) ELSE {digits} END, 12, ' ') END"
    )


def num(x: str) -> str:
    """A decimal as text without trailing zeros and leading zero."""
    s = f"({x})::VARCHAR"
    cut = f"CASE WHEN contains({s}, '.') THEN regexp_replace({s}, '\\.?0+$', '') ELSE {s} END"
    return f"regexp_replace({cut}, '^(-?)0\\.', '\\1.')"
