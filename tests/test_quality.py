"""Constraint and normalization jobs."""

from datetime import date
from decimal import Decimal

from rosterlake.operators import quality as qy
from rosterlake.sources.schemas import FOREIGN_KEYS, ForeignKey


def test_first_normal_form(spark):
    raw = spark.createDataFrame(
        [(1001, "BSc,MBA,AWS Certified"), (1002, " BA , Oracle Certified"), (1003, None)],
        "emp_id bigint, qualification string",
    )
    got = qy.explode_multivalue(raw, "emp_id", "qualification").orderBy("emp_id", "place").collect()
    assert [tuple(r) for r in got] == [
        (1001, 1, "BSc"), (1001, 2, "MBA"), (1001, 3, "AWS Certified"),
        (1002, 1, "BA"), (1002, 2, "Oracle Certified"),
    ]


def test_separator_is_literal(spark):
    raw = spark.createDataFrame([(1, "a|b.c||")], "k int, v string")
    assert [r["v"] for r in qy.explode_multivalue(raw, "k", "v", "|").collect()] == ["a", "b.c", "", ""]


def test_extract_dimension(spark):
    wide = spark.createDataFrame(
        [(1, 10, "Engineering"), (2, 20, "HR"), (3, 10, "Engineering"), (4, None, None)],
        "emp_id int, dept_id int, dept_name string",
    )
    dimension, fact = qy.extract_dimension(wide, "dept_id", ["dept_name"])
    assert sorted(tuple(r) for r in dimension.collect()) == [(10, "Engineering"), (20, "HR")]
    assert fact.columns == ["emp_id", "dept_id"] and fact.count() == 4


def test_fd_violations_count_null_as_value(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", None), ("c", 5), ("d", None)], "k string, v int"
    )
    got = {r["k"]: r["distinct_values"] for r in qy.fd_violations(df, ["k"], "v").collect()}
    assert got == {"b": 2, "c": 2}


def test_check_rules_pass_unknown(spark):
    df = spark.createDataFrame(
        [(1, "M", 30), (2, "X", 30), (3, None, None), (4, "F", 80), (5, "Q", 17)],
        "emp_id int, gender string, age int",
    )
    valid, rejected = qy.check_rows(df, qy.checks_of("employee"))
    assert {r["emp_id"] for r in valid.collect()} == {1, 3}
    assert {r["emp_id"]: r["failed_rules"] for r in rejected.collect()} == {
        2: ["gender"], 4: ["age"], 5: ["gender", "age"],
    }


def test_all_declared_checks(spark, company):
    for table in ("salary_bonus", "employee", "leave", "payroll"):
        valid, rejected = qy.check_rows(company[table], qy.checks_of(table))
        assert valid.count() == company[table].count() and rejected.count() == 0
    bad = spark.createDataFrame(
        [(Decimal("50000"), Decimal("60000"), "PROCESSING")],
        "gross_amount decimal(10,2), deductions decimal(10,2), payment_status string",
    )
    assert qy.check_rows(bad, qy.checks_of("payroll"))[1].first()["failed_rules"] == ["payroll_status"]


def test_null_unique_and_orphans(spark):
    df = spark.createDataFrame([(1, "x", 9), (2, "x", 1), (3, None, None), (4, None, 2)], "id int, mail string, fk int")
    parents = spark.createDataFrame([(1,), (2,)], "pk int")
    assert qy.not_null_violations(df, ["mail", "fk"]).count() == 2
    assert [tuple(r) for r in qy.unique_violations(df, ["mail"]).collect()] == [("x", 2)]
    assert [r["id"] for r in qy.orphan_rows(df, parents, "fk", "pk").collect()] == [1]


def test_no_orphans_in_the_fixture(company):
    keys = [k for k in FOREIGN_KEYS if k.parent not in ("authors", "books")]
    assert {r["orphans"] for r in qy.orphan_counts(company, keys).collect()} == {0}


def test_orphans_are_counted_without_joins(spark):
    tables = {
        "team": spark.createDataFrame([(1,), (1,), (2,), (None,)], "id bigint"),
        "person": spark.createDataFrame(
            [(1, 1, 10), (2, 3, 11), (3, None, None)] + [(k, 3, 99) for k in range(4, 40)], "id int, team int, boss bigint"
        ),
        "badge": spark.createDataFrame([(1, "a"), (77, "b"), (None, None)], "owner bigint, kind string"),
        "kind": spark.createDataFrame([("a",)], "name string"),
        "empty": spark.createDataFrame([], "team bigint"),
    }
    keys = [
        ForeignKey("person", "team", "team", "id"),
        ForeignKey("person", "boss", "person", "id"),
        ForeignKey("badge", "owner", "person", "id"),
        ForeignKey("badge", "kind", "kind", "name"),
        ForeignKey("empty", "team", "team", "id"),
    ]
    counts = qy.orphan_counts(tables, keys)
    assert {tuple(r) for r in counts.collect()} == {
        ("person", "team", 37), ("person", "boss", 36), ("badge", "owner", 1), ("badge", "kind", 1), ("empty", "team", 0),
    }
    assert "Join" not in counts._jdf.queryExecution().optimizedPlan().toString()  # no parent is broadcast


def test_delete_department_reaches_all_levels(spark, company):
    gone = spark.createDataFrame([(3,)], "job_id bigint")
    after = qy.delete_with_references(company, "job_department", gone)
    assert after["job_department"].count() == 4
    assert {r["salary_id"] for r in after["salary_bonus"].collect()} == {100, 101, 102, 105, 106, 107}
    staff = {r["emp_id"]: (r["job_id"], r["salary_id"]) for r in after["employee"].collect()}
    assert len(staff) == 12 and staff[1005] == (None, None) and staff[1000] == (1, 100)
    pays = {r["payroll_id"]: (r["job_id"], r["salary_id"]) for r in after["payroll"].collect()}
    assert len(pays) == 14 and pays[2008] == (None, None) and pays[2000] == (1, 100)
    assert after["leave"].count() == 4


def test_delete_employee_cascades(spark, company):
    gone = spark.createDataFrame([(1000,), (1005,)], "emp_id bigint")
    after = qy.delete_with_references(company, "employee", gone)
    counts = {n: df.count() for n, df in after.items()}
    assert counts == {
        "job_department": 5, "salary_bonus": 8, "employee": 10, "qualification": 5, "leave": 2, "payroll": 10,
    }


def test_delete_leave_nulls_the_payroll_reference(spark, company):
    linked = company.payroll.selectExpr(
        "* EXCEPT (leave_id)", "CASE WHEN emp_id = 1000 THEN 3000 WHEN emp_id = 1001 THEN 3001 END AS leave_id"
    )
    gone = spark.createDataFrame([(1000,)], "emp_id bigint")
    after = qy.delete_with_references(company.replacing(payroll=linked), "employee", gone)
    assert {r["leave_id"] for r in after["payroll"].where("emp_id = 1001").collect()} == {3001}
    assert after["payroll"].where("emp_id = 1000").count() == 0


def test_order_of_deletes_follows_from_the_keys():
    key = qy.ForeignKey
    links = [key("c", "b", "b", "b", "cascade"), key("b", "a", "a", "a", "cascade"), key("c", "a", "a", "a", "cascade"), key("x", "y", "y", "y")]
    assert qy.delete_order("a", links) == [["a"], ["b"], ["c"]] and qy.delete_order("b", links) == [["b"], ["c"]]
    ring = [*links, key("a", "c", "c", "c", "cascade"), key("d", "c", "c", "c", "cascade"), key("d", "d", "d", "d", "cascade")]
    assert qy.delete_order("b", ring) == [["a", "b", "c"], ["d"]]


def test_delete_in_a_table_that_refers_to_itself(spark):
    """Staff below a deleted person go at every level, also in a ring; approvals become NULL."""
    staff = [(1, None), (2, 1), (3, 2), (4, 3), (5, None), (6, 5), (7, 8), (8, 9), (9, 7), (10, 4), (10, 4)]
    tables = {
        "staff": spark.createDataFrame(staff, "id bigint, boss bigint"),
        "leave": spark.createDataFrame([(100, 3, 5), (101, 5, 3), (102, 6, 10), (103, 6, None), (104, None, 2)], "leave bigint, id bigint, approver bigint"),
    }
    links = (
        qy.ForeignKey("staff", "boss", "staff", "id", "cascade"),
        qy.ForeignKey("leave", "id", "staff", "id", "cascade"),
        qy.ForeignKey("leave", "approver", "staff", "id", "set null"),
    )
    keys = {"staff": "id", "leave": "leave"}

    def after(*gone):
        rows = qy.delete_with_references(tables, "staff", spark.createDataFrame([(g,) for g in gone], "id bigint"), links, keys)
        return {r["id"] for r in rows["staff"].collect()}, {r["leave"]: r["approver"] for r in rows["leave"].collect()}

    assert after(2) == ({1, 5, 6, 7, 8, 9}, {101: None, 102: None, 103: None, 104: None})
    assert after(8) == ({1, 2, 3, 4, 5, 6, 10}, {100: 5, 101: 3, 102: 10, 103: None, 104: 2})
    assert after(99)[0] == {r[0] for r in staff}


def test_dependencies_with_nulls_and_a_hot_group(spark):
    rows = [("a", 1, None)] * 50 + [("a", 2, None), ("b", 1, "x"), ("b", 1, "x"), ("c", None, "y"), ("c", 3, "y"), (None, 4, "z"), (None, 5, "z"), ("d", None, None)]
    df = spark.createDataFrame(rows, "k string, v int, w string")
    found = {r["k"]: r["distinct_values"] for r in qy.fd_violations(df, ["k"], "v").collect()}
    assert found == {"a": 2, "c": 2, None: 2}
    report = {(r["determinant"], r["dependent"]): r["violations"] for r in qy.dependency_report(df, {("k",): ("v", "w"), ("w",): ("k",)}).collect()}
    assert report == {("k", "v"): 3, ("k", "w"): 0, ("w", "k"): 1}
    plan = qy.dependency_report(df, {("k",): ("v", "w")})._jdf.queryExecution().executedPlan().toString()
    assert "distinct" not in plan.lower()


def test_unique_over_several_columns(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "a", 1), (1, "b", 0), (None, "a", 0), (None, "a", 1)], "x int, y string, _hash int")
    assert [tuple(r) for r in qy.unique_violations(df, ["x", "y"]).collect()] == [(1, "a", 2)]
    assert qy.unique_violations(df.limit(0), ["x"]).count() == 0
