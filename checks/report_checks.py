"""Checks of the payroll, leave and qualification reports."""

from __future__ import annotations

from rosterlake.plans import matches, monitoring, nested, pay_summary, views
from rosterlake.operators.changes import validate_payroll
from rosterlake.sources.loading import Tables, row_count_inventory

from .sql import avg2, cents, div, q

LEAVE_DAY = "2024-01-15"
OLD_LEAVE_DAY = "2024-07-20"
PAY_DAY = "2001-07-15"
CERT_DAY = "2002-01-01"

NAME = "first_name || ' ' || last_name"
# employees with department and pay row
PAID = """employee INNER JOIN job_department d USING (job_id)
    INNER JOIN (SELECT salary_id, amount, bonus_amount, annual_increase FROM salary_bonus) USING (salary_id)"""
# all departments with their employees and pay rows
ALL_DEPTS = """job_department d LEFT OUTER JOIN employee e ON e.job_id = d.job_id
    LEFT OUTER JOIN salary_bonus s ON s.salary_id = e.salary_id"""


def pct(part: str, whole: str, digits: int = 2) -> str:
    return div(f"100 * {cents(part)}", cents(whole), digits)


def _warnings(t: Tables):
    audit = validate_payroll(t.payroll, t.employee, t.salary_bonus, PAY_DAY).audit
    return monitoring.variance_warnings(audit, PAY_DAY)


CHECKS = {
    "ag01_salary_budget": (pay_summary.salary_budget, q(f"""
        SELECT dept_name, count(e.emp_id) AS employee_count, sum(amount)::DOUBLE AS total_salary,
            {avg2('amount')} AS avg_salary, min(amount)::DOUBLE AS min_salary, max(amount)::DOUBLE AS max_salary
        FROM {ALL_DEPTS} GROUP BY d.job_id, dept_name""")),
    "ag02_rollup_total": (pay_summary.budget_with_total, q(f"""
        SELECT CASE WHEN grouping(dept_name) = 1 THEN 'GRAND TOTAL' ELSE dept_name END AS department,
            count(e.emp_id) AS headcount, sum(amount)::DOUBLE AS salary_budget, {avg2('amount')} AS avg_salary,
            CASE WHEN grouping(dept_name) = 1 THEN 'COMPANY WIDE' ELSE 'Department' END AS level_type
        FROM {ALL_DEPTS} GROUP BY ROLLUP (dept_name)""")),
    "ag03_cube_gender": (pay_summary.pay_by_department_and_gender, q(f"""
        SELECT CASE WHEN grouping(dept_name) = 1 THEN 'TOTAL' ELSE dept_name END AS department,
            CASE WHEN grouping(gender) = 1 THEN 'BOTH' ELSE gender END AS gender,
            count(e.emp_id) AS employee_count, sum(amount)::DOUBLE AS total_salary, {avg2('amount')} AS avg_salary
        FROM {ALL_DEPTS} GROUP BY CUBE (dept_name, gender)""")),
    "ag04_department_ranks": (pay_summary.department_pay_ranks, q(f"""
        SELECT dept_name, {NAME} AS employee_name, amount::DOUBLE AS amount,
            dense_rank() OVER (PARTITION BY dept_name ORDER BY amount DESC) AS salary_rank,
            {div(f'100 * {cents("amount")}', f'sum({cents("amount")}) OVER (PARTITION BY dept_name)')}
                AS pct_of_dept_salary
        FROM {PAID}""")),
    "ag05_top_paid": (pay_summary.top_paid, q(f"""
        SELECT * FROM (SELECT {NAME} AS employee_name, dept_name, amount::DOUBLE AS amount,
            row_number() OVER (ORDER BY amount DESC, emp_id) AS row_num, rank() OVER (ORDER BY amount DESC) AS rank_no,
            dense_rank() OVER (ORDER BY amount DESC) AS dense_rank_no FROM {PAID}) WHERE dense_rank_no <= 5""")),
    "ag06_pay_gaps": (pay_summary.pay_gaps, q(f"""
        SELECT emp_id, {NAME} AS employee_name, dept_name, amount::DOUBLE AS amount,
            (lag(amount) OVER o)::DOUBLE AS prev_higher, (lead(amount) OVER o)::DOUBLE AS next_lower,
            (amount - lag(amount) OVER o)::DOUBLE AS gap_from_higher,
            (lead(amount) OVER o - amount)::DOUBLE AS gap_to_lower
        FROM {PAID} WINDOW o AS (ORDER BY amount DESC, emp_id)""")),
    "ag07_running_totals": (pay_summary.pay_running_totals, q(f"""
        SELECT emp_id, employee_name, amount::DOUBLE AS amount, running_total, cumulative_count,
            {div('near_sum', 'near_count', 0)} / 100 AS moving_avg
        FROM (SELECT emp_id, {NAME} AS employee_name, amount,
            (sum(amount) OVER (o ROWS UNBOUNDED PRECEDING))::DOUBLE AS running_total,
            (sum({cents('amount')}) OVER (o ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))::HUGEINT AS near_sum,
            (count(*) OVER (o ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))::HUGEINT AS near_count,
            count(*) OVER (o ROWS UNBOUNDED PRECEDING) AS cumulative_count
            FROM employee INNER JOIN salary_bonus USING (salary_id)
            WINDOW o AS (ORDER BY amount DESC, emp_id))""")),
    "ag08_payroll_expense": (pay_summary.payroll_expense, q(f"""
        SELECT dept_name, count(DISTINCT emp_id) AS employees_paid, count(payroll_id) AS payroll_records,
            sum(gross_amount)::DOUBLE AS total_gross, sum(deductions)::DOUBLE AS total_deductions,
            sum(net_amount)::DOUBLE AS total_net,
            {div(f'100 * sum({cents("gross_amount")})', f'sum(sum({cents("gross_amount")})) OVER ()')}
                AS pct_of_total_payroll,
            {avg2('net_amount')} AS avg_net_payment
        FROM payroll INNER JOIN job_department USING (job_id) GROUP BY job_id, dept_name""")),
    "ag09_leave_rollup": (pay_summary.leave_by_department_and_type, q(f"""
        SELECT dept_name, leave_type, (grouping(dept_name) * 2 + grouping(leave_type))::BIGINT AS level,
            count(*) AS leave_count, count(DISTINCT emp_id) AS employees_on_leave,
            {div('sum(coalesce(leave_end - leave_start, 0))', 'count(*)', 1)} AS avg_duration_days
        FROM leave INNER JOIN employee USING (emp_id) INNER JOIN job_department USING (job_id)
        GROUP BY ROLLUP (dept_name, leave_type)""")),
    "ag10_qualification_spread": (pay_summary.qualification_spread, q("""
        SELECT dept_name, qual_type, count(*) AS qualifications, count(DISTINCT emp_id) AS unique_employees
        FROM qualification INNER JOIN employee USING (emp_id) INNER JOIN job_department USING (job_id)
        GROUP BY ALL""")),
    "ag11_key_metrics": (pay_summary.key_metrics, q(f"""
        SELECT count(DISTINCT emp_id) AS total_employees, sum(amount)::DOUBLE AS total_salary,
            {avg2('amount')} AS avg_salary, max(amount)::DOUBLE AS max_salary,
            (SELECT sum(gross_amount)::DOUBLE FROM payroll) AS total_payroll,
            (SELECT sum(deductions)::DOUBLE FROM payroll) AS total_deductions
        FROM (SELECT DISTINCT emp_id, amount FROM employee INNER JOIN salary_bonus USING (salary_id))""")),
    "jn01_staff_departments": (matches.staff_with_department, q(f"""
        SELECT emp_id, {NAME} AS employee_name, gender, dept_name, salary_range
        FROM employee INNER JOIN job_department USING (job_id)""")),
    "jn02_departments_example": (matches.departments_with_example, q(f"""
        SELECT d.job_id, dept_name, dept_description, count(emp_id) AS employee_count,
            CASE WHEN count(emp_id) = 0 THEN 'No employees' ELSE {NAME} END AS example_employee
        FROM job_department d LEFT OUTER JOIN employee e ON e.job_id = d.job_id
        GROUP BY d.job_id, dept_name, dept_description, first_name, last_name""")),
    "jn03_pay_rows_of_staff": (matches.pay_rows_of_staff, q(f"""
        SELECT s.salary_id, amount::DOUBLE AS amount, bonus_amount::DOUBLE AS bonus_amount, dept_name,
            count(emp_id) AS employees_with_this_salary,
            CASE WHEN count(emp_id) = 0 THEN 'No employees assigned' ELSE {NAME} END AS example_employee
        FROM salary_bonus s RIGHT OUTER JOIN employee e ON e.salary_id = s.salary_id
        LEFT OUTER JOIN job_department d ON d.job_id = e.job_id
        GROUP BY s.salary_id, amount, bonus_amount, dept_name, first_name, last_name""")),
    "jn04_staff_and_leave": (matches.staff_and_leave, q(f"""
        SELECT coalesce(e.emp_id, v.emp_id) AS emp_id,
            CASE WHEN e.emp_id IS NULL THEN 'ORPHANED LEAVE' ELSE {NAME} END AS employee_name,
            coalesce(dept_name, 'UNASSIGNED') AS department, coalesce(leave_id, 0) AS recent_leave_count,
            coalesce(leave_type, 'N/A') AS leave_type,
            coalesce(strftime(leave_start, '%Y-%m-%d'), 'Never') AS last_leave_start
        FROM employee e FULL OUTER JOIN leave v ON v.emp_id = e.emp_id
        LEFT OUTER JOIN job_department d ON d.job_id = e.job_id""")),
    "jn05_staff_pay_totals": (matches.staff_pay_totals, q(f"""
        SELECT e.emp_id, {NAME} AS employee_name, gender, age::BIGINT AS age, dept_name,
            amount::DOUBLE AS monthly_salary, bonus_amount::DOUBLE AS bonus_amount,
            count(payroll_id) AS payroll_records, sum(gross_amount)::DOUBLE AS total_gross_paid,
            sum(deductions)::DOUBLE AS total_deductions, sum(net_amount)::DOUBLE AS total_net_paid
        FROM employee e INNER JOIN job_department d ON d.job_id = e.job_id
        INNER JOIN salary_bonus s ON s.salary_id = e.salary_id LEFT OUTER JOIN payroll p ON p.emp_id = e.emp_id
        GROUP BY e.emp_id, first_name, last_name, gender, age, dept_name, amount, bonus_amount""")),
    "jn06_department_payroll": (matches.department_payroll, q(f"""
        SELECT dept_name, salary_range, count(DISTINCT e.emp_id) AS headcount,
            count(DISTINCT s.salary_id) AS distinct_salary_levels, {avg2('amount')} AS avg_salary,
            min(amount)::DOUBLE AS min_salary, max(amount)::DOUBLE AS max_salary,
            (sum(sum(net_amount)) OVER (PARTITION BY dept_name))::DOUBLE AS dept_net_payroll
        FROM {ALL_DEPTS} LEFT OUTER JOIN payroll p ON p.emp_id = e.emp_id
        GROUP BY d.job_id, dept_name, salary_range""")),
    "jn06_department_payroll_safe": (
        lambda t: matches.department_payroll(t, per_payroll_row=False),
        q(f"""
        SELECT dept_name, salary_range, count(e.emp_id) AS headcount,
            count(DISTINCT s.salary_id) AS distinct_salary_levels, {avg2('amount')} AS avg_salary,
            min(amount)::DOUBLE AS min_salary, max(amount)::DOUBLE AS max_salary,
            (SELECT sum(net_amount)::DOUBLE FROM payroll p INNER JOIN employee x USING (emp_id)
                WHERE x.job_id = d.job_id) AS dept_net_payroll
        FROM {ALL_DEPTS} GROUP BY d.job_id, dept_name, salary_range"""),
    ),
    "jn07_leave_approvers": (matches.leave_approvers, q("""
        SELECT DISTINCT leave_id, e.first_name || ' ' || e.last_name AS employee_requesting,
            e.emp_id AS emp_requesting, m.first_name || ' ' || m.last_name AS approving_manager,
            m.emp_id AS mgr_id, leave_type, leave_start::VARCHAR AS leave_start, status
        FROM leave v, employee e, employee m WHERE e.emp_id = v.emp_id AND m.emp_id = v.approved_by""")),
    "jn08_staff_qualifications": (lambda t: matches.staff_qualifications(t, CERT_DAY), q(f"""
        SELECT e.emp_id, {NAME} AS employee_name, dept_name, qual_title, qual_type,
            strftime(grant_date, '%Y-%m-%d') AS grant_date,
            (date_diff('month', grant_date, DATE '{CERT_DAY}'))::BIGINT AS months_since_certification
        FROM employee e INNER JOIN job_department USING (job_id)
        LEFT OUTER JOIN qualification k ON k.emp_id = e.emp_id""")),
    "jn09_department_pay_pairs": (matches.department_pay_pairs, q("""
        SELECT dept_name, amount::DOUBLE AS monthly_salary, bonus_amount::DOUBLE AS bonus_amount,
            'Dept-Salary Combination ' || job_id || '-' || salary_id AS combination_id
        FROM job_department INNER JOIN salary_bonus USING (job_id)""")),
    "jn10_staff_without_leave": (matches.staff_without_leave, q(f"""
        SELECT emp_id, {NAME} AS employee_name, dept_name, hire_date::VARCHAR AS hire_date,
            'No leaves on record' AS status
        FROM employee INNER JOIN job_department USING (job_id)
        WHERE emp_id NOT IN (SELECT emp_id FROM leave)""")),
    "jn11_staff_without_qualification": (matches.staff_without_qualification, q(f"""
        SELECT emp_id, {NAME} AS employee_name, dept_name, 'No certifications' AS qual_status
        FROM employee INNER JOIN job_department USING (job_id)
        WHERE emp_id NOT IN (SELECT emp_id FROM qualification)""")),
    "jn12_assignment_counts": (matches.assignment_counts, q("""
        SELECT (SELECT count(*) FROM employee INNER JOIN salary_bonus USING (salary_id)) AS with_salary,
            (SELECT count(*) FROM employee WHERE salary_id IS NULL) AS without_salary,
            (SELECT count(*) FROM employee INNER JOIN job_department USING (job_id)) AS with_department,
            (SELECT count(*) FROM employee WHERE job_id IS NULL) AS without_department""")),
    "sq01_pay_against_department": (nested.pay_against_department, q(f"""
        WITH rows_ AS (SELECT {NAME} AS employee_name, dept_name, job_id, {cents('amount')} AS c, amount FROM {PAID}),
        pool AS (SELECT job_id, sum({cents('amount')}) AS s, count(*)::HUGEINT AS n
            FROM employee e INNER JOIN (SELECT salary_id, amount FROM salary_bonus) USING (salary_id) GROUP BY job_id)
        SELECT employee_name, dept_name, amount::DOUBLE AS employee_salary, {div('s', 'n', 0)} / 100 AS dept_avg_salary,
            {div('c * n - s', 'n', 0)} / 100 AS difference_from_avg FROM rows_ INNER JOIN pool USING (job_id)""")),
    "sq02_above_company_average": (nested.above_company_average, q(f"""
        WITH pool AS (SELECT sum(amount) AS s, count(amount) AS n, {avg2('amount')} AS company_avg FROM salary_bonus)
        SELECT emp_id, {NAME} AS employee_name, dept_name, amount::DOUBLE AS amount, company_avg
        FROM pool, {PAID} WHERE amount * n > s""")),
    "sq03_leave_counts": (nested.leave_counts, q(f"""
        SELECT emp_id, {NAME} AS employee_name, dept_name,
            (SELECT count(*) FROM leave v WHERE v.emp_id = e.emp_id) AS total_leaves,
            (SELECT count(*) FROM leave v WHERE v.emp_id = e.emp_id AND status = 'APPROVED') AS approved_leaves,
            (SELECT count(*) FROM leave v WHERE v.emp_id = e.emp_id AND status = 'PENDING') AS pending_leaves
        FROM employee e INNER JOIN job_department USING (job_id)""")),
    "sq04_existence_flags": (nested.existence_flags, q(f"""
        SELECT emp_id, {NAME} AS employee_name, dept_name,
            CASE WHEN emp_id IN (SELECT emp_id FROM qualification) THEN 'Yes' ELSE 'No' END AS has_qualifications,
            CASE WHEN emp_id IN (SELECT emp_id FROM leave WHERE status = 'APPROVED') THEN 'Yes' ELSE 'No' END
                AS has_approved_leave
        FROM employee INNER JOIN job_department USING (job_id)""")),
    "sq05_department_share": (nested.department_share_of_pay, q(f"""
        WITH per AS (SELECT dept_name, count(e.emp_id) AS emp_count, sum(amount) AS total, {avg2('amount')} AS avg_salary
            FROM {ALL_DEPTS} GROUP BY dept_name), pool AS (SELECT sum(amount) AS everything FROM salary_bonus)
        SELECT dept_name, emp_count, total::DOUBLE AS total_salary, avg_salary,
            {pct('total', 'everything')} AS pct_of_total FROM per, pool""")),
    "sq06_ranks_with_department": (nested.pay_ranks_with_department, q(f"""
        WITH stats AS (SELECT d.job_id, count(e.emp_id) AS dept_size, {avg2('amount')} AS avg_salary
            FROM {ALL_DEPTS} GROUP BY d.job_id)
        SELECT {NAME} AS employee_name, dept_name, amount::DOUBLE AS amount,
            rank() OVER (PARTITION BY dept_name ORDER BY amount DESC) AS salary_rank,
            round(amount::DOUBLE - avg_salary, 2) AS variance_from_avg, dept_size
        FROM {PAID} INNER JOIN stats USING (job_id)""")),
    "sq07_payroll_report": (nested.payroll_report, q(f"""
        WITH per AS (SELECT emp_id, count(payroll_id) AS n, sum(gross_amount) AS g, sum(deductions) AS x,
            sum(net_amount) AS net FROM payroll GROUP BY emp_id)
        SELECT {NAME} AS employee_name, dept_name, amount::DOUBLE AS base_salary, bonus_amount::DOUBLE AS bonus_amount,
            coalesce(n, 0) AS payroll_count, g::DOUBLE AS total_gross, x::DOUBLE AS total_deductions,
            net::DOUBLE AS total_net, {pct('x', 'g')} AS deduction_pct
        FROM {PAID} LEFT OUTER JOIN per USING (emp_id)""")),
    "sq08_approval_chain": (nested.approval_chain, q(f"""
        WITH links AS (SELECT emp_id AS child, approved_by AS parent, count(*) AS n FROM leave
            WHERE approved_by IN (SELECT emp_id FROM employee) GROUP BY ALL),
        l1 AS (SELECT emp_id AS node, 1::HUGEINT AS p FROM employee
            WHERE emp_id NOT IN (SELECT approved_by FROM leave WHERE approved_by IS NOT NULL)),
        l2 AS (SELECT parent AS node, sum(p * n)::HUGEINT AS p FROM l1 INNER JOIN links ON child = node GROUP BY 1),
        l3 AS (SELECT parent AS node, sum(p * n)::HUGEINT AS p FROM l2 INNER JOIN links ON child = node GROUP BY 1),
        l4 AS (SELECT parent AS node, sum(p * n)::HUGEINT AS p FROM l3 INNER JOIN links ON child = node GROUP BY 1),
        l5 AS (SELECT parent AS node, sum(p * n)::HUGEINT AS p FROM l4 INNER JOIN links ON child = node GROUP BY 1),
        walk AS (SELECT 1 AS lvl, * FROM l1 UNION ALL SELECT 2, * FROM l2 UNION ALL SELECT 3, * FROM l3
            UNION ALL SELECT 4, * FROM l4 UNION ALL SELECT 5, * FROM l5)
        SELECT repeat('  ', lvl - 1) || {NAME} AS hierarchy,
            CASE lvl WHEN 1 THEN 'Individual Contributor' ELSE 'Approver' END AS role, lvl::BIGINT AS lvl,
            p::DOUBLE AS paths
        FROM walk INNER JOIN employee ON emp_id = node""")),
    "sq09_insert_high_pay": (lambda t: nested.payroll_of_high_pay(t, PAY_DAY), q(f"""
        WITH pool AS (SELECT sum(amount) AS s, count(amount) AS n FROM salary_bonus),
        made AS (SELECT emp_id, e.job_id, e.salary_id, {cents('amount')} AS c
            FROM pool, employee e INNER JOIN salary_bonus b ON b.salary_id = e.salary_id WHERE amount * n > s)
        SELECT '{PAY_DAY}' AS payroll_date, c::DOUBLE / 100 AS gross_amount,
            {div('c * 15', '100', 0)} / 100 AS deductions,
            (c - {div('c * 15', '100', 0)}) / 100 AS net_amount,
            emp_id, job_id, salary_id, 'PROCESSED' AS payment_status FROM made""")),
    "sq10_leave_summary": (nested.leave_summary, q(f"""
        WITH per AS (SELECT emp_id, count(*) AS n FROM leave GROUP BY emp_id)
        SELECT emp_id, {NAME} AS employee_name, coalesce(n, 0) AS leaves
        FROM employee LEFT OUTER JOIN per USING (emp_id)""")),
    "vw01_employee_directory": (views.employee_directory, q("""
        SELECT emp_id, first_name, last_name, email, dept_name, phone, hire_date::VARCHAR AS hire_date
        FROM employee LEFT OUTER JOIN job_department USING (job_id)""")),
    "vw02_salary_info": (views.salary_info, q(f"""
        SELECT emp_id, {NAME} AS full_name, dept_name, salary_id, amount::DOUBLE AS base_salary,
            bonus_amount::DOUBLE AS bonus_amount, annual_increase::DOUBLE AS annual_increase_pct,
            (amount + bonus_amount)::DOUBLE AS total_compensation, hire_date::VARCHAR AS hire_date
        FROM {PAID}""")),
    "vw03_department_stats": (views.department_stats, q(f"""
        SELECT d.job_id, dept_name, dept_description, count(e.emp_id) AS headcount, {avg2('amount')} AS avg_salary,
            min(amount)::DOUBLE AS min_salary, max(amount)::DOUBLE AS max_salary,
            sum(amount)::DOUBLE AS total_salary_budget
        FROM {ALL_DEPTS} GROUP BY d.job_id, dept_name, dept_description""")),
    "vw04_employee_profile": (views.employee_profile, q(f"""
        WITH v AS (SELECT emp_id, count(DISTINCT leave_id) AS a FROM leave GROUP BY 1),
        k AS (SELECT emp_id, count(DISTINCT qual_id) AS b FROM qualification GROUP BY 1),
        p AS (SELECT emp_id, count(DISTINCT payroll_id) AS c FROM payroll GROUP BY 1)
        SELECT e.emp_id, {NAME} AS employee_name, gender, age::BIGINT AS age, email, phone,
            hire_date::VARCHAR AS hire_date, dept_name, d.job_id, amount::DOUBLE AS monthly_salary,
            bonus_amount::DOUBLE AS bonus_amount, (amount + bonus_amount)::DOUBLE AS total_compensation,
            coalesce(a, 0) AS total_leave_requests, coalesce(b, 0) AS qualification_count,
            coalesce(c, 0) AS payroll_records
        FROM employee e LEFT OUTER JOIN job_department d ON d.job_id = e.job_id
        LEFT OUTER JOIN salary_bonus s ON s.salary_id = e.salary_id LEFT OUTER JOIN v ON v.emp_id = e.emp_id
        LEFT OUTER JOIN k ON k.emp_id = e.emp_id LEFT OUTER JOIN p ON p.emp_id = e.emp_id""")),
    "vw05_payroll_analysis": (lambda t: views.payroll_analysis(t, PAY_DAY), q(f"""
        SELECT payroll_id, emp_id, {NAME} AS employee_name, dept_name, payroll_date::VARCHAR AS payroll_date,
            gross_amount::DOUBLE AS gross_amount, deductions::DOUBLE AS deductions, net_amount::DOUBLE AS net_amount,
            {pct('deductions', 'gross_amount')} AS deduction_pct,
            CASE payment_status WHEN 'PENDING' THEN 'Awaiting Processing' WHEN 'PROCESSED' THEN 'Ready to Pay'
                WHEN 'PAID' THEN 'Paid Out' ELSE 'Unknown' END AS payment_status_desc,
            {div(cents('gross_amount - deductions'), '26', 0)} / 100 AS weekly_net,
            DATE '{PAY_DAY}' - payroll_date AS days_since_payroll
        FROM payroll p INNER JOIN employee e USING (emp_id) INNER JOIN job_department d ON d.job_id = p.job_id""")),
    "vw06_leave_management": (lambda t: views.leave_management(t, LEAVE_DAY), q(f"""
        SELECT leave_id, e.emp_id, e.first_name || ' ' || e.last_name AS employee_name, dept_name, leave_type,
            leave_start::VARCHAR AS leave_start, leave_end::VARCHAR AS leave_end,
            coalesce(leave_end - leave_start + 1, 1) AS days_requested, reason, status,
            CASE status WHEN 'APPROVED' THEN 'Approved by Manager' WHEN 'PENDING' THEN 'Awaiting Approval'
                WHEN 'REJECTED' THEN 'Not Approved' ELSE 'Unknown' END AS status_description,
            coalesce(m.first_name || ' ' || m.last_name, ' ') AS approved_by_manager,
            DATE '{LEAVE_DAY}' - leave_start AS days_until_leave
        FROM leave v INNER JOIN employee e ON e.emp_id = v.emp_id INNER JOIN job_department d ON d.job_id = e.job_id
        LEFT OUTER JOIN employee m ON m.emp_id = v.approved_by""")),
    "vw07_qualification_ages": (lambda t: views.employee_qualifications(t, CERT_DAY), q(f"""
        SELECT *, CASE WHEN years_since_certification >= 3 THEN 'Renewal Recommended'
            WHEN years_since_certification >= 2 THEN 'Current' ELSE 'Recent' END AS certification_status
        FROM (SELECT qual_id, emp_id, {NAME} AS employee_name, dept_name, qual_title, qual_type,
            grant_date::VARCHAR AS grant_date,
            ceil((DATE '{CERT_DAY}' - grant_date) / 365.25)::BIGINT AS years_since_certification
            FROM qualification INNER JOIN employee USING (emp_id) INNER JOIN job_department USING (job_id))""")),
    "vw08_department_summary": (lambda t: views.department_summary(t, PAY_DAY), q(f"""
        SELECT d.job_id, dept_name, dept_description, count(e.emp_id) AS headcount, {avg2('amount')} AS avg_salary,
            min(amount)::DOUBLE AS min_salary, max(amount)::DOUBLE AS max_salary,
            sum(amount)::DOUBLE AS total_salary_budget, count(DISTINCT payroll_id) AS total_payroll_records,
            sum(gross_amount)::DOUBLE AS total_gross_paid, '{PAY_DAY}' AS last_refreshed
        FROM {ALL_DEPTS} LEFT OUTER JOIN payroll p ON p.emp_id = e.emp_id
        GROUP BY d.job_id, dept_name, dept_description""")),
    "vw08_department_summary_safe": (
        lambda t: views.department_summary(t, PAY_DAY, per_payroll_row=False),
        q(f"""
        WITH per AS (SELECT e.job_id, count(*) AS n, sum(gross_amount) AS g
            FROM payroll p INNER JOIN employee e USING (emp_id) GROUP BY e.job_id)
        SELECT d.job_id, dept_name, dept_description, count(e.emp_id) AS headcount, {avg2('amount')} AS avg_salary,
            min(amount)::DOUBLE AS min_salary, max(amount)::DOUBLE AS max_salary,
            sum(amount)::DOUBLE AS total_salary_budget, coalesce(any_value(n), 0) AS total_payroll_records,
            any_value(g)::DOUBLE AS total_gross_paid, '{PAY_DAY}' AS last_refreshed
        FROM {ALL_DEPTS} LEFT OUTER JOIN per ON per.job_id = d.job_id
        GROUP BY d.job_id, dept_name, dept_description"""),
    ),
    "vw09_monthly_payroll": (lambda t: views.monthly_payroll(t, PAY_DAY), q(f"""
        SELECT date_trunc('month', payroll_date)::DATE::VARCHAR AS payroll_month, dept_name,
            count(payroll_id) AS payroll_records, count(DISTINCT emp_id) AS employees_paid,
            sum(gross_amount)::DOUBLE AS total_gross, sum(deductions)::DOUBLE AS total_deductions,
            sum(net_amount)::DOUBLE AS total_net, {avg2('net_amount')} AS avg_net_per_employee,
            max(payroll_date)::VARCHAR AS latest_payroll_date
        FROM payroll INNER JOIN job_department USING (job_id) WHERE payroll_date >= DATE '2000-07-01'
        GROUP BY date_trunc('month', payroll_date), dept_name""")),
    "vw10_leave_statistics": (lambda t: views.leave_statistics(t, LEAVE_DAY), q(f"""
        SELECT dept_name, count(DISTINCT emp_id) AS employees_with_leaves, count(leave_id) AS total_leave_requests,
            count(*) FILTER (status = 'APPROVED') AS approved_count,
            count(*) FILTER (status = 'PENDING') AS pending_count,
            count(*) FILTER (status = 'REJECTED') AS rejected_count,
            count(*) FILTER (leave_type = 'SICK') AS sick_leaves,
            count(*) FILTER (leave_type = 'VACATION') AS vacation_leaves,
            {div('sum(coalesce(leave_end - leave_start + 1, 0))', 'count(*)')} AS avg_leave_duration,
            '{LEAVE_DAY}' AS last_refreshed
        FROM leave INNER JOIN employee USING (emp_id) INNER JOIN job_department USING (job_id)
        GROUP BY dept_name""")),
    "vw11_top_earners": (views.top_earners, q(f"""
        SELECT {NAME} AS full_name, dept_name, (amount + bonus_amount)::DOUBLE AS total_compensation
        FROM {PAID} ORDER BY amount + bonus_amount DESC NULLS FIRST, emp_id LIMIT 5""")),
    "vw12_directory_size": (views.directory_size, q("""
        SELECT count(*) AS total_employees FROM employee LEFT OUTER JOIN job_department USING (job_id)""")),
    "vw13_department_stats_sorted": (views.department_stats_sorted, q(f"""
        SELECT d.job_id, dept_name, dept_description, count(e.emp_id) AS headcount, {avg2('amount')} AS avg_salary,
            min(amount)::DOUBLE AS min_salary, max(amount)::DOUBLE AS max_salary,
            sum(amount)::DOUBLE AS total_salary_budget
        FROM {ALL_DEPTS} GROUP BY d.job_id, dept_name, dept_description
        ORDER BY total_salary_budget DESC NULLS FIRST""")),
    "mo01_missing_payroll": (lambda t: monitoring.missing_payroll(t, PAY_DAY), q(f"""
        SELECT count(*) AS missing_payroll FROM employee WHERE emp_id NOT IN (SELECT emp_id FROM payroll
            WHERE date_trunc('month', payroll_date) = date_trunc('month', DATE '{PAY_DAY}'))""")),
    "mo02_unusual_payroll": (lambda t: monitoring.unusual_payroll(t, PAY_DAY), q(f"""
        SELECT count(*) AS variance_warnings
        FROM payroll p INNER JOIN employee e USING (emp_id) INNER JOIN salary_bonus s ON s.salary_id = e.salary_id
        WHERE payroll_date = DATE '{PAY_DAY}' AND abs(gross_amount - amount) * 2 > amount""")),
    "mo03_upcoming_leave": (lambda t: monitoring.upcoming_leave(t, LEAVE_DAY), q(f"""
        SELECT count(*) AS approved_leaves FROM leave WHERE status = 'APPROVED'
            AND leave_start BETWEEN DATE '{LEAVE_DAY}' AND DATE '{LEAVE_DAY}' + 6""")),
    "mo04_overdue_leave": (lambda t: monitoring.overdue_leave(t, LEAVE_DAY), q(f"""
        SELECT count(*) AS pending_leaves FROM leave
        WHERE status = 'PENDING' AND DATE '{LEAVE_DAY}' - leave_start >= 0""")),
    "mo05_old_rejected_leave": (lambda t: monitoring.old_rejected_leave(t, OLD_LEAVE_DAY), q("""
        SELECT count(*) AS rejected_leaves FROM leave
        WHERE status = 'REJECTED' AND leave_start < DATE '2024-01-20'""")),
    "mo06_variance_warnings": (_warnings, q("""
        SELECT count(*) AS validation_errors
        FROM payroll p INNER JOIN employee e USING (emp_id) INNER JOIN salary_bonus s ON s.salary_id = e.salary_id
        WHERE abs(gross_amount - amount) * 5 > amount""")),
    "mo07_recent_executions": (lambda t: monitoring.recent_executions(t.job_execution_log), q("""
        SELECT job_name, status, records_affected, execution_time_sec::DOUBLE AS execution_time_sec
        FROM job_execution_log ORDER BY execution_start DESC, log_id DESC LIMIT 10""")),
    "mo08_execution_summary": (lambda t: monitoring.execution_summary(t.job_execution_log), q(f"""
        SELECT count(*) AS total_executions, count(*) FILTER (status = 'SUCCESS') AS successful,
            count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'WARNING') AS warnings,
            {div('sum((execution_time_sec * 1000)::HUGEINT)', '10 * count(*)::HUGEINT', 0)} / 100
                AS avg_execution_time
        FROM job_execution_log""")),
    "mo09_success_rate": (lambda t: monitoring.success_rate(t.job_execution_log), q(f"""
        SELECT {div("100 * count(*) FILTER (status = 'SUCCESS')::HUGEINT", 'count(*)::HUGEINT')} AS success_rate
        FROM job_execution_log""")),
    "rp01_average_compensation": (views.compensation_by_department, q(f"""
        SELECT dept_name, count(*) AS employees, {avg2('amount + bonus_amount')} AS avg_compensation
        FROM employee e LEFT OUTER JOIN job_department d USING (job_id)
        LEFT OUTER JOIN (SELECT salary_id, amount, bonus_amount FROM salary_bonus) USING (salary_id)
        GROUP BY dept_name""")),
    "rp02_top_paid_per_department": (pay_summary.top_paid_per_department, q(f"""
        SELECT * FROM (SELECT job_id, emp_id, {NAME} AS employee_name, amount::DOUBLE AS amount,
            rank() OVER (PARTITION BY job_id ORDER BY amount DESC) AS rank_no FROM {PAID}) WHERE rank_no <= 5""")),
    "bk01_bookstore_counts": (
        lambda t: row_count_inventory({"AUTHORS": t.authors, "BOOKS": t.books, "ORDERS": t.book_orders}),
        q("""SELECT 'AUTHORS' AS tbl, (SELECT count(*) FROM authors) AS total UNION ALL
        SELECT 'BOOKS', (SELECT count(*) FROM books) UNION ALL SELECT 'ORDERS', (SELECT count(*) FROM book_orders)"""),
    ),
    "v09_leave_figures": (lambda t: monitoring.leave_figures(t, LEAVE_DAY), q(f"""
        SELECT count(*) FILTER (status = 'APPROVED' AND leave_start >= DATE '{LEAVE_DAY}'
                AND leave_start < DATE '{LEAVE_DAY}' + 7) AS approved_leaves,
            count(*) FILTER (status = 'PENDING' AND leave_start <= DATE '{LEAVE_DAY}') AS pending_leaves,
            count(*) FILTER (status = 'REJECTED'
                AND leave_start < DATE '{LEAVE_DAY}' - INTERVAL 6 MONTH) AS rejected_leaves,
            count(*) FILTER (status = 'APPROVED' AND leave_start >= DATE '{LEAVE_DAY}') AS upcoming_approved
        FROM leave""")),
    "au02_approved_from": (lambda t: monitoring.approved_from(t, LEAVE_DAY), q(f"""
        SELECT count(*) AS upcoming_approved FROM leave
        WHERE status = 'APPROVED' AND leave_start >= DATE '{LEAVE_DAY}'""")),
}
