"""Small payroll company: 5 departments, 8 pay rows, 12 employees and their records."""

from datetime import date
from decimal import Decimal

from rosterlake.sources.loading import Tables, conform, rows_of
from rosterlake.sources.schemas import declared_schema

AS_OF = date(2024, 6, 1)

# Sample rows of the declared tables, keys from the declared first key on.
DEPARTMENTS = ["Engineering", "Human Resources", "Finance", "Operations", "Marketing"]
PAY = [  # salary_id, amount, bonus, increase, department
    (100, "95000", "9500", "7.5", 1),
    (101, "75000", "6000", "5", 1),
    (102, "65000", "4000", "4", 2),
    (103, "85000", "7000", "6", 3),
    (104, "65000", "4500", "4.5", 3),
    (105, "55000", "3500", "4", 4),
    (106, "70000", "5000", "5", 5),
    (107, "60000", "3500", "4", 5),
]
STAFF = [  # emp_id, first, last, gender, age, department, pay row
    (1000, "John", "Doe", "M", 35, 1, 100),
    (1001, "Jane", "Smith", "F", 32, 1, 101),
    (1002, "Michael", "Johnson", "M", 28, 1, 101),
    (1003, "Sarah", "Williams", "F", 40, 2, 102),
    (1004, "Robert", "Brown", "M", 38, 2, 102),
    (1005, "Emily", "Davis", "F", 34, 3, 103),
    (1006, "David", "Miller", "M", 45, 3, 104),
    (1007, "Lisa", "Wilson", "F", 29, 3, 104),
    (1008, "James", "Taylor", "M", 36, 4, 105),
    (1009, "Patricia", "Anderson", "F", 31, 4, 105),
    (1010, "Christopher", "Thomas", "M", 33, 5, 106),
    (1011, "Jennifer", "Jackson", "F", 27, 5, 107),
]
QUALIFICATIONS = [  # qual_id, type, granted, emp_id
    (5000, "DEGREE", date(2010, 6, 15), 1000),
    (5001, "CERTIFICATION", date(2021, 3, 20), 1000),
    (5002, "DEGREE", date(2012, 5, 10), 1001),
    (5003, "CERTIFICATION", date(2020, 11, 15), 1002),
    (5004, "CERTIFICATION", date(2018, 9, 22), 1005),
    (5005, "DEGREE", date(2008, 4, 30), 1006),
    (5006, "CERTIFICATION", date(2019, 7, 14), 1003),
    (5007, "CERTIFICATION", date(2022, 1, 25), 1004),
]
LEAVES = [  # leave_id, type, start, end, status, emp_id, approver
    (3000, "SICK", date(2024, 1, 15), date(2024, 1, 17), "APPROVED", 1000, 1003),
    (3001, "VACATION", date(2024, 2, 10), date(2024, 2, 20), "APPROVED", 1001, 1003),
    (3002, "SICK", date(2024, 3, 5), None, "PENDING", 1005, 1003),
    (3003, "VACATION", date(2024, 4, 1), date(2024, 4, 15), "APPROVED", 1006, 1003),
]


def _payroll_rows():
    pay_of = {s: Decimal(a) for s, a, *_ in PAY}
    single = [
        (2000, AS_OF, 95000, 19000, 76000, 1000, 1, 100, "PENDING"),
        (2002, date(2024, 6, 2), 95000, 19000, 76000, 1000, 1, 100, "PAID"),
    ]
    bulk = []
    for n, (emp, _f, _l, _g, _a, job, pay) in enumerate(STAFF):
        gross = pay_of[pay]
        bulk.append(
            (2003 + n, AS_OF, gross, gross * Decimal("0.2"), gross * Decimal("0.8"), emp, job, pay,
             "PROCESSED")
        )
    return [(i, d, Decimal(g), Decimal(x), Decimal(n), *rest) for i, d, g, x, n, *rest in single + bulk]


def company_tables(spark) -> Tables:
    def table(name, rows, columns):
        return conform(rows_of(spark, name, rows, columns), declared_schema(name))

    departments = [(i + 1, n) for i, n in enumerate(DEPARTMENTS)]
    pay = [(s, Decimal(a), Decimal(b), Decimal(r), j) for s, a, b, r, j in PAY]
    staff = [
        (i, f, l, g, a, f"{f}.{l}@example.com".lower(), f"555-01{n:02d}", date(2020, 1, 1), j, s)
        for n, (i, f, l, g, a, j, s) in enumerate(STAFF, 1)
    ]
    quals = [(i, f"Course {i}", k, d, e) for i, k, d, e in QUALIFICATIONS]
    return Tables(
        job_department=table("job_department", departments, ["job_id", "dept_name"]),
        salary_bonus=table(
            "salary_bonus", pay, ["salary_id", "amount", "bonus_amount", "annual_increase", "job_id"]
        ),
        employee=table(
            "employee", staff,
            ["emp_id", "first_name", "last_name", "gender", "age", "email", "phone", "hire_date",
             "job_id", "salary_id"],
        ),
        qualification=table(
            "qualification", quals, ["qual_id", "qual_title", "qual_type", "grant_date", "emp_id"]
        ),
        leave=table(
            "leave", LEAVES,
            ["leave_id", "leave_type", "leave_start", "leave_end", "status", "emp_id", "approved_by"],
        ),
        payroll=table(
            "payroll", _payroll_rows(),
            ["payroll_id", "payroll_date", "gross_amount", "deductions", "net_amount", "emp_id",
             "job_id", "salary_id", "payment_status"],
        ),
    )
