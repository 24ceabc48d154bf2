"""Checks of the staff directory, review and company reports."""

from __future__ import annotations

from rosterlake.plans import hr, thresholds

from .sql import avg2, money, q

NAME = "first_name || ' ' || last_name"
DEPT = 3  # department of the single-department queries

CHECKS = {
    "hr01_table_counts": (hr.table_counts, q("""
        SELECT 'EMPLOYEES' AS tbl, (SELECT count(*) FROM employees) AS total UNION ALL
        SELECT 'DEPARTMENTS', (SELECT count(*) FROM departments) UNION ALL
        SELECT 'JOBS', (SELECT count(*) FROM jobs) UNION ALL
        SELECT 'LOCATIONS', (SELECT count(*) FROM locations) UNION ALL
        SELECT 'COUNTRIES', (SELECT count(*) FROM countries) UNION ALL
        SELECT 'REGIONS', (SELECT count(*) FROM regions)""")),
    "hr02_employee_departments": (hr.employee_departments, q(f"""
        SELECT employee_id, {NAME} AS full_name, department_name
        FROM employees INNER JOIN departments USING (department_id)""")),
    "hr03_salary_report": (hr.salary_report, q(f"""
        SELECT {NAME} AS full_name, job_title, {money('salary')} AS salary_text
        FROM employees INNER JOIN jobs USING (job_id)""")),
    "hr04_employee_cities": (hr.employee_cities, q(f"""
        SELECT {NAME} AS full_name, department_name, city
        FROM employees INNER JOIN departments USING (department_id) INNER JOIN locations USING (location_id)""")),
    "hr05_employee_regions": (hr.employee_regions, q(f"""
        SELECT {NAME} AS full_name, department_name, country_name, region_name
        FROM employees INNER JOIN departments USING (department_id) INNER JOIN locations USING (location_id)
        INNER JOIN countries USING (country_id) INNER JOIN regions USING (region_id)""")),
    "hr06_optional_department": (hr.employees_or_no_department, q(f"""
        SELECT employee_id, {NAME} AS full_name,
            coalesce(department_name, 'No Department Assigned') AS department
        FROM employees LEFT OUTER JOIN departments USING (department_id)""")),
    "hr07_department_headcount": (hr.department_headcount, q("""
        SELECT p.department_id, department_name,
            (SELECT count(*) FROM employees s WHERE s.department_id = p.department_id) AS employee_count
        FROM departments p""")),
    "hr08_empty_departments": (hr.empty_departments, q("""
        SELECT department_id, department_name, city
        FROM departments LEFT OUTER JOIN locations USING (location_id)
        WHERE department_id NOT IN (SELECT department_id FROM employees WHERE department_id IS NOT NULL)""")),
    "hr09_employee_managers": (hr.employee_managers, q("""
        SELECT s.first_name || ' ' || s.last_name AS full_name, b.first_name || ' ' || b.last_name AS manager
        FROM employees s, employees b WHERE b.employee_id = s.manager_id""")),
    "hr10_top_of_hierarchy": (hr.top_of_hierarchy, q(f"""
        SELECT employee_id, {NAME} AS full_name, job_id, 'Top of organizational hierarchy' AS reason
        FROM employees WHERE manager_id IS NULL""")),
    "hr11_more_than_manager": (hr.earning_more_than_manager, q("""
        SELECT s.first_name || ' ' || s.last_name AS full_name, s.salary::DOUBLE AS salary,
            b.first_name || ' ' || b.last_name AS manager, b.salary::DOUBLE AS mgr_salary,
            (s.salary - b.salary)::DOUBLE AS difference
        FROM employees s, employees b WHERE b.employee_id = s.manager_id AND s.salary > b.salary""")),
    "hr12_managers_in_own_department": (hr.managers_in_own_department, q("""
        SELECT p.department_id AS dept_id, department_name, first_name || ' ' || last_name AS manager_name, city
        FROM departments p INNER JOIN locations USING (location_id)
        INNER JOIN employees s ON s.employee_id = p.manager_id AND s.department_id = p.department_id""")),
    "hr13_employee_profiles": (hr.employee_profiles, q(f"""
        SELECT employee_id, {NAME} AS full_name, job_title, department_name, city, country_name
        FROM employees INNER JOIN jobs USING (job_id) INNER JOIN departments USING (department_id)
        INNER JOIN locations USING (location_id) INNER JOIN countries USING (country_id)""")),
    "hr14_department_managers": (hr.department_managers, q("""
        SELECT department_name, coalesce((SELECT first_name || ' ' || last_name FROM employees s
            WHERE s.employee_id = p.manager_id), 'No Manager') AS manager, city, country_name
        FROM departments p INNER JOIN locations USING (location_id) INNER JOIN countries USING (country_id)""")),
    "hr15_manager_same_department": (hr.managers_in_same_department, q("""
        SELECT s.first_name || ' ' || s.last_name AS full_name, department_name,
            b.first_name || ' ' || b.last_name AS manager, city
        FROM employees s, employees b, departments p, locations l
        WHERE b.employee_id = s.manager_id AND b.department_id = s.department_id
            AND p.department_id = s.department_id AND l.location_id = p.location_id""")),
    "hr16_manager_other_department": (hr.managers_in_other_department, q("""
        SELECT s.first_name || ' ' || s.last_name AS full_name, p.department_name,
            b.first_name || ' ' || b.last_name AS manager, o.department_name AS manager_department
        FROM employees s, employees b, departments p, departments o
        WHERE b.employee_id = s.manager_id AND b.department_id <> s.department_id
            AND p.department_id = s.department_id AND o.department_id = b.department_id""")),
    "hr17_region_summary": (hr.region_summary, q("""
        SELECT region_name, country_name, count(DISTINCT p.department_id) AS departments,
            count(DISTINCT s.employee_id) AS employees
        FROM regions INNER JOIN countries USING (region_id) INNER JOIN locations USING (country_id)
        INNER JOIN departments p USING (location_id) LEFT OUTER JOIN employees s ON s.department_id = p.department_id
        GROUP BY ALL""")),
    "co01_project_hours": (hr.project_hours, q("""
        SELECT fname || ' ' || lname AS employee, ssn, dname, pname, hours::DOUBLE AS hours
        FROM works_on, company_employee e, company_department, project
        WHERE essn = ssn AND e.dno = dnum AND pno = pnumber""")),
    "co02_employee_dependents": (hr.employee_dependents, q("""
        SELECT fname || ' ' || lname AS employee, ssn, dname,
            coalesce(dependent_name, 'None') AS dependent_name, coalesce(relationship, 'N/A') AS relationship
        FROM company_employee INNER JOIN company_department ON dno = dnum
        LEFT OUTER JOIN dependent ON essn = ssn""")),
    "co03_projects_with_workers": (hr.projects_with_workers, q("""
        SELECT coalesce(fname || ' ' || lname, ' ') AS employee, coalesce(ssn::VARCHAR, 'No Employee') AS ssn,
            dname, pname, pnumber, hours::DOUBLE AS hours
        FROM project p INNER JOIN company_department ON p.dno = dnum
        LEFT OUTER JOIN works_on ON pno = pnumber LEFT OUTER JOIN company_employee ON ssn = essn""")),
    "co04_supervisors": (hr.supervisors, q("""
        SELECT s.fname || ' ' || s.lname AS employee, s.ssn, b.fname || ' ' || b.lname AS supervisor,
            b.ssn AS sup_ssn, dname
        FROM company_employee s, company_employee b, company_department
        WHERE b.ssn = s.super_ssn AND dnum = s.dno""")),
    "rv01_departments": (hr.review_departments, q("""
        SELECT first_name, last_name, department_name
        FROM employees INNER JOIN departments USING (department_id)""")),
    "rv02_jobs": (hr.review_jobs, q(f"""
        SELECT first_name, last_name, job_title, {money('salary')} AS salary_text
        FROM employees INNER JOIN jobs USING (job_id)""")),
    "rv03_all_departments": (hr.review_all_departments, q("""
        SELECT first_name, last_name, coalesce(department_name, 'No Department') AS department
        FROM employees LEFT OUTER JOIN departments USING (department_id)""")),
    "rv04_one_department": (lambda t: hr.review_one_department(t, "NATION_3"), q("""
        SELECT first_name, last_name, department_name
        FROM employees INNER JOIN departments USING (department_id) WHERE department_name = 'NATION_3'""")),
    "rv05_marked_department": (lambda t: hr.review_marked_department(t, "NATION_3"), q("""
        SELECT first_name, last_name, CASE WHEN department_name = 'NATION_3' THEN 'NATION_3'
            WHEN department_name IS NULL THEN 'No Department' ELSE department_name END AS department
        FROM employees LEFT OUTER JOIN departments USING (department_id)""")),
    "rv06_managers": (hr.review_managers, q("""
        SELECT s.first_name || ' ' || s.last_name AS full_name, s.salary::DOUBLE AS salary,
            b.first_name || ' ' || b.last_name AS manager, department_name
        FROM employees s, employees b, departments p
        WHERE b.employee_id = s.manager_id AND p.department_id = s.department_id""")),
    "cr01_above_average": (thresholds.above_average, q("""
        SELECT first_name, salary::DOUBLE AS salary FROM employees
        WHERE salary * (SELECT count(salary) FROM employees) > (SELECT sum(salary) FROM employees)""")),
    "cr02_departments_in": (thresholds.departments_in_use, q("""
        SELECT department_name FROM departments
        WHERE department_id IN (SELECT department_id FROM employees)""")),
    "cr03_departments_exists": (thresholds.departments_with_staff, q("""
        SELECT department_name FROM departments p
        WHERE EXISTS (FROM employees s WHERE s.department_id = p.department_id)""")),
    "cr04_shared_departments": (thresholds.in_shared_departments, q("""
        SELECT employee_id, first_name, last_name, salary::DOUBLE AS salary, job_id, department_id, manager_id
        FROM (SELECT *, count(*) OVER (PARTITION BY department_id) AS n FROM employees)
        WHERE n > 1 AND department_id IS NOT NULL""")),
    "cr05_valid_department": (thresholds.with_valid_department, q("""
        SELECT employee_id, first_name, last_name, salary::DOUBLE AS salary, job_id, department_id, manager_id
        FROM employees WHERE department_id IN (SELECT department_id FROM departments)""")),
    "cr06_same_salary": (lambda t: thresholds.same_salary_as(t, DEPT), q(f"""
        SELECT employee_id, first_name, last_name, salary::DOUBLE AS salary, job_id, department_id, manager_id
        FROM employees WHERE salary IN (SELECT salary FROM employees WHERE department_id = {DEPT})""")),
    "cr07_above_all": (lambda t: thresholds.above_all_of(t, DEPT), q(f"""
        SELECT first_name, salary::DOUBLE AS salary FROM employees
        WHERE salary > ALL (SELECT salary FROM employees WHERE department_id = {DEPT})""")),
    "cr08_above_any": (lambda t: thresholds.above_any_of(t, DEPT), q(f"""
        SELECT first_name, salary::DOUBLE AS salary FROM employees
        WHERE salary > ANY (SELECT salary FROM employees WHERE department_id = {DEPT})""")),
    "cr09_above_average_of": (lambda t: thresholds.above_average_of(t, DEPT), q(f"""
        SELECT first_name, salary::DOUBLE AS salary FROM employees,
            (SELECT sum(salary) AS s, count(salary) AS n FROM employees WHERE department_id = {DEPT})
        WHERE salary * n > s""")),
    "cr10_department_statistics": (lambda t: thresholds.department_statistics(t, DEPT), q(f"""
        SELECT count(*) AS employees, min(salary)::DOUBLE AS min_salary, {avg2('salary')} AS avg_salary,
            max(salary)::DOUBLE AS max_salary FROM employees WHERE department_id = {DEPT}""")),
    "cr11_company_average": (thresholds.company_average, q(f"""
        SELECT {avg2('salary')} AS company_avg FROM employees""")),
    "cr12_distinct_departments": (thresholds.distinct_departments, q("""
        SELECT count(DISTINCT department_id) AS distinct_departments FROM employees""")),
}

