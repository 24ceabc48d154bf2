"""Declared table schemas with nullability, defaults and keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

_KEY = "BIGINT NOT NULL"

# Column types of the declared tables.
_DDL: dict[str, str] = {
    "job_department": f"""job_id {_KEY}, dept_name STRING NOT NULL, dept_description STRING,
        salary_range STRING, created_date DATE""",
    "salary_bonus": f"""salary_id {_KEY}, amount DECIMAL(10,2) NOT NULL, bonus_amount DECIMAL(10,2),
        annual_increase DECIMAL(5,2), job_id {_KEY}, created_date DATE""",
    "employee": f"""emp_id {_KEY}, first_name STRING NOT NULL, last_name STRING NOT NULL,
        gender STRING, age INT, email STRING, phone STRING, hire_date DATE,
        job_id BIGINT, salary_id BIGINT""",
    "qualification": f"""qual_id {_KEY}, qual_title STRING NOT NULL, qual_type STRING,
        grant_date DATE, emp_id {_KEY}""",
    "leave": f"""leave_id {_KEY}, leave_type STRING, leave_start DATE NOT NULL, leave_end DATE,
        reason STRING, status STRING, emp_id {_KEY}, approved_by BIGINT""",
    "payroll": f"""payroll_id {_KEY}, payroll_date DATE NOT NULL,
        gross_amount DECIMAL(10,2) NOT NULL, deductions DECIMAL(10,2), net_amount DECIMAL(10,2),
        emp_id {_KEY}, job_id BIGINT, salary_id BIGINT, leave_id BIGINT, payment_status STRING""",
    "employee_archive": """emp_id BIGINT, first_name STRING, last_name STRING, gender STRING,
        age INT, email STRING, phone STRING, hire_date DATE, job_id BIGINT, salary_id BIGINT,
        archived_date DATE, archived_by STRING, archive_reason STRING""",
    "salary_audit_log": f"""audit_id {_KEY}, salary_id {_KEY}, old_amount DECIMAL(18,2),
        new_amount DECIMAL(18,2), change_amount DECIMAL(18,2), changed_by STRING,
        changed_date DATE, reason STRING""",
    "payroll_audit": f"""audit_id {_KEY}, payroll_id {_KEY}, emp_id BIGINT, audit_type STRING,
        message STRING, audit_date DATE""",
    "job_execution_log": f"""log_id {_KEY}, job_name STRING, execution_start TIMESTAMP,
        execution_end TIMESTAMP, status STRING, records_affected BIGINT, error_message STRING,
        execution_time_sec DECIMAL(18,3)""",
    "authors": f"""author_id {_KEY}, first_name STRING NOT NULL, last_name STRING NOT NULL,
        country STRING, birth_year INT""",
    "books": f"""book_id {_KEY}, title STRING NOT NULL, author_id {_KEY},
        price DECIMAL(8,2) NOT NULL, genre STRING, publish_year INT""",
    "book_orders": f"""order_id {_KEY}, book_id {_KEY}, customer_name STRING NOT NULL,
        quantity INT NOT NULL, order_date DATE, total_price DECIMAL(10,2)""",
}

TODAY = object()

# Declared column defaults; TODAY stands for the date of the load.
DEFAULTS: dict[str, dict[str, object]] = {
    "job_department": {"created_date": TODAY},
    "salary_bonus": {"bonus_amount": 0, "annual_increase": 5, "created_date": TODAY},
    "employee": {"hire_date": TODAY},
    "qualification": {"qual_type": "CERTIFICATION"},
    "leave": {"leave_type": "SICK", "status": "PENDING"},
    "payroll": {"payroll_date": TODAY, "deductions": 0, "payment_status": "PENDING"},
    "salary_audit_log": {"changed_date": TODAY},
    "payroll_audit": {"audit_date": TODAY},
    "book_orders": {"order_date": TODAY},
}

# First surrogate key of each table.
KEY_START: dict[str, int] = {
    "job_department": 1,
    "salary_bonus": 100,
    "employee": 1000,
    "payroll": 2000,
    "leave": 3000,
    "qualification": 5000,
    "salary_audit_log": 1,
    "payroll_audit": 1,
    "job_execution_log": 1,
}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    key: str
    on_delete: str = field(default="restrict")


# Declared foreign keys and what happens to the child row on delete.
FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("salary_bonus", "job_id", "job_department", "job_id", "cascade"),
    ForeignKey("employee", "job_id", "job_department", "job_id", "set null"),
    ForeignKey("employee", "salary_id", "salary_bonus", "salary_id", "set null"),
    ForeignKey("qualification", "emp_id", "employee", "emp_id", "cascade"),
    ForeignKey("leave", "emp_id", "employee", "emp_id", "cascade"),
    ForeignKey("payroll", "emp_id", "employee", "emp_id", "cascade"),
    ForeignKey("payroll", "job_id", "job_department", "job_id", "set null"),
    ForeignKey("payroll", "salary_id", "salary_bonus", "salary_id", "set null"),
    ForeignKey("payroll", "leave_id", "leave", "leave_id", "set null"),
    ForeignKey("books", "author_id", "authors", "author_id"),
    ForeignKey("book_orders", "book_id", "books", "book_id"),
)


def declared_schema(name: str) -> StructType:
    """The declared schema of a table as a StructType."""
    return StructType.fromDDL(_DDL[name])


def declared_tables() -> list[str]:
    return list(_DDL)
