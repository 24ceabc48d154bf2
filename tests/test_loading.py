"""Fixture totals, defaults, appends and table creation."""

from decimal import Decimal

import pytest

from rosterlake.session import new_path, scratch_dir
from rosterlake.sources import loading
from rosterlake.sources.schemas import DEFAULTS, KEY_START, declared_schema, declared_tables

from .fixtures import AS_OF


def test_fixture_totals(company):
    names = ("job_department", "salary_bonus", "employee", "qualification", "leave", "payroll")
    got = {r["tbl"]: r["total"] for r in loading.row_count_inventory({n: company[n] for n in names}).collect()}
    assert got == dict(zip(names, (5, 8, 12, 8, 4, 14)))


def test_schemas_are_complete():
    assert len(declared_tables()) == 13
    payroll = declared_schema("payroll")
    assert payroll["gross_amount"].dataType.simpleString() == "decimal(10,2)"
    assert not payroll["emp_id"].nullable and payroll["leave_id"].nullable
    assert KEY_START["employee"] == 1000


def test_defaults_fill_omitted_columns_only(spark):
    rows = spark.createDataFrame([(1, None), (2, "PAID")], "payroll_id bigint, payment_status string")
    got = loading.with_defaults(rows, DEFAULTS["payroll"], AS_OF).orderBy("payroll_id").collect()
    assert [r["payment_status"] for r in got] == [None, "PAID"]
    assert {r["payroll_date"] for r in got} == {AS_OF} and {r["deductions"] for r in got} == {0}


def test_append_rows_by_name(spark, company):
    new = spark.createDataFrame([("Legal", 6)], "dept_name string, job_id int")
    got = loading.append_rows(company.job_department, new)
    assert got.schema["job_id"].dataType.simpleString() == "bigint"
    row = got.where("job_id = 6").first()
    assert (row["dept_name"], row["salary_range"]) == ("Legal", None) and got.count() == 6


def test_insert_select_uses_declared_defaults(spark, company):
    query = company.employee.selectExpr("emp_id", "DATE '2024-07-01' AS leave_start", "9000 + emp_id AS leave_id")
    got = loading.insert_select(company.leave, "leave", query)
    assert got.count() == 16
    assert {(r["status"], r["leave_type"]) for r in got.where("leave_id > 9000").collect()} == {("PENDING", "SICK")}


def test_create_table_as(spark, company):
    full = loading.create_table_as(company.employee, new_path(spark, "copy"))
    empty = loading.create_table_as(company.employee, new_path(spark, "clone"), empty=True)
    assert full.count() == 12 and empty.count() == 0
    assert empty.columns == company.employee.columns


def test_tables_open_on_first_use(spark):
    opened = []

    def open_table():
        opened.append(1)
        return spark.range(3)

    t = loading.Tables(numbers=open_table)
    assert not opened
    assert t.numbers.count() == t["numbers"].count() == 3 and opened == [1]
    with pytest.raises(AttributeError):
        t.letters


def test_conform_orders_and_casts(spark):
    raw = spark.createDataFrame([("7", 12.5)], "book_id string, price double")
    got = loading.conform(raw, declared_schema("books"))
    assert got.first()["price"] == Decimal("12.50") and got.columns[0] == "book_id"


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        assert scratch_dir(spark).startswith(shared)
