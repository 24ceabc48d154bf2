"""Change jobs on the fixture, with the five trigger cases."""

from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rosterlake import labels, session
from rosterlake.operators import changes as ch

from .fixtures import AS_OF

STEP = "salary_id bigint, new_amount decimal(10,2), step int"


def raises(spark, rows):
    return spark.createDataFrame([(i, a and Decimal(a), s) for i, a, s in rows], STEP)


def test_raise_passes_and_is_logged(spark, company):
    out = ch.guard_no_decrease(company.salary_bonus, raises(spark, [(100, "99750", 1)]), ["step"], AS_OF, "hr")
    assert out.rows.where("salary_id = 100").first()["amount"] == Decimal("99750.00")
    log = out.audit.first()
    assert tuple(log) == (
        100, Decimal("95000.00"), Decimal("99750.00"), Decimal("4750.00"), "hr", AS_OF, labels.RAISE_REASON,
    )
    assert out.rejected.count() == 0 and out.rows.count() == 8


def test_cut_is_blocked(spark, company):
    out = ch.guard_no_decrease(company.salary_bonus, raises(spark, [(101, "67500", 1)]), ["step"], AS_OF, "hr")
    assert out.audit.count() == 0
    assert out.rows.where("salary_id = 101").first()["amount"] == Decimal("75000.00")
    assert out.rejected.first()["message"] == (
        "SALARY CUT BLOCKED! Current: $75000 Attempted: $67500 Decrease of $7500."
        " Contact HR Department for override."
    )


@pytest.mark.parametrize("sliced", [False, True])
def test_several_changes_of_one_row(many_slices, company, sliced, monkeypatch):
    if sliced:
        monkeypatch.setattr(ch, "over_order", lambda *a, **k: _sliced(*a, **k))
    spark = many_slices
    batch = raises(
        spark, [(103, "90000", 1), (103, "86000", 2), (103, "90000", 3), (103, "91000.50", 4), (103, "100", 5)]
    )
    out = ch.guard_no_decrease(company.salary_bonus, batch, ["step"], AS_OF, "hr")
    log = sorted((float(r["old_amount"]), float(r["new_amount"])) for r in out.audit.collect())
    assert log == [(85000.0, 90000.0), (90000.0, 91000.5)]
    cuts = sorted((float(r["old_amount"]), float(r["new_amount"])) for r in out.rejected.collect())
    assert cuts == [(90000.0, 86000.0), (91000.5, 100.0)]
    assert out.rows.where("salary_id = 103").first()["amount"] == Decimal("91000.50")


def _sliced(df, order_by, frames, partition_by=()):
    from rosterlake.operators.ordered import over_order

    return over_order(df, order_by, frames, partition_by, block_rows=2)


def test_unknown_pay_rows_are_found(spark, company):
    batch = raises(spark, [(999, "1", 1), (100, "99000", 2)])
    assert [r["salary_id"] for r in ch.unknown_keys(company.salary_bonus, batch, "salary_id").collect()] == [999]


def test_leave_batch(spark, company):
    rows = [
        (1, date(2024, 6, 6), date(2024, 6, 7), "PENDING"),
        (2, date(2024, 6, 11), date(2024, 6, 6), None),
        (3, date(2024, 6, 11), None, None),
    ]
    batch = spark.createDataFrame(rows, "leave_id bigint, leave_start date, leave_end date, status string")
    out = ch.validate_leave(batch)
    assert {r["leave_id"]: r["status"] for r in out.rows.collect()} == {1: "PENDING", 3: "PENDING"}
    assert [(r["leave_id"], r["failed_rules"]) for r in out.rejected.collect()] == [(2, [labels.DATES_INVALID])]


def payroll_batch(spark, rows):
    return spark.createDataFrame(
        [(i, AS_OF, Decimal(g), x and Decimal(x), n and Decimal(n), e) for i, g, x, n, e in rows],
        """payroll_id bigint, payroll_date date, gross_amount decimal(10,2), deductions decimal(10,2),
        net_amount decimal(10,2), emp_id bigint""",
    )


def test_payroll_variance_warns_and_keeps(spark, company):
    batch = payroll_batch(
        spark,
        [
            (1, "150000", "30000", None, 1000),
            (2, "114000", None, None, 1000),  # exactly 20 percent: no warning
            (3, "114000.01", "1", "5", 1000),
            (4, "100", "10", None, 77),  # unknown employee: no check, net stays open
        ],
    )
    out = ch.validate_payroll(batch, company.employee, company.salary_bonus, AS_OF)
    assert {r["payroll_id"]: r["net_amount"] for r in out.rows.collect()} == {
        1: Decimal("120000.00"), 2: Decimal("114000.00"), 3: Decimal("5.00"), 4: None,
    }
    audit = {r["payroll_id"]: r["message"] for r in out.audit.collect()}
    assert audit == {
        1: "Payroll variance: 57.89% (Expected: $95000, Actual: $150000)",
        3: "Payroll variance: 20% (Expected: $95000, Actual: $114000.01)",
    }
    assert out.rows.columns == batch.columns


def test_archive(spark, company):
    keys = spark.createDataFrame([(1003,), (1004,), (4,), (None,)], "emp_id bigint")
    out = ch.archive_deleted(company.employee, keys, AS_OF, "hr")
    assert {r["emp_id"] for r in out.audit.collect()} == {1003, 1004}
    assert {(r["archived_date"], r["archived_by"], r["archive_reason"]) for r in out.audit.collect()} == {
        (AS_OF, "hr", labels.ARCHIVE_REASON)
    }
    assert out.rows.count() + out.audit.count() == 12


def test_directory_update_is_restricted(spark, company):
    change = spark.createDataFrame(
        [(1000, "Jon", "Doe", None, "555-9999", 5, 1)],
        "emp_id bigint, first_name string, last_name string, email string, phone string, job_id bigint, age int",
    )
    row = ch.update_directory(company.employee, change).where("emp_id = 1000").first()
    assert (row["first_name"], row["email"], row["phone"]) == ("Jon", None, "555-9999")
    assert (row["job_id"], row["age"]) == (1, 35)


def test_latest_change_wins(spark, company):
    batch = raises(spark, [(100, "1", 1), (100, "3", 3), (100, "2", 2), (101, "9", 1)])
    last = ch.latest_change(batch, "salary_id", ["step"], ["new_amount"])
    assert {r["salary_id"]: float(r["new_amount"]) for r in last.collect()} == {100: 3.0, 101: 9.0}


def hire(spark, rows):
    return spark.createDataFrame(
        rows,
        """no int, first_name string, last_name string, gender string, age int, email string,
        phone string, job_id bigint, salary_id bigint""",
    )


def test_hires(spark, company):
    batch = hire(
        spark,
        [
            (1, "Ann", "One", "F", 30, "ann@example.com", None, 1, 100),
            (2, None, "Two", "F", 30, "two@example.com", None, 1, 100),
            (3, "Cy", "Three", "X", 30, "cy@example.com", None, 1, 100),
            (4, "Di", "Four", "F", 17, "di@example.com", None, 1, 100),
            (5, "Ed", "Five", "M", 40, "john.doe@example.com", None, 1, 100),
            (6, "Fay", "Six", "F", 40, "ann@example.com", None, 1, 100),
            (7, "Gus", "Seven", None, None, None, None, 2, None),
            (8, "Hal", "Eight", "X", 1, "hal@example.com", None, 2, None),
            (9, "Hal", "Nine", "M", 50, "hal@example.com", None, 2, None),
        ],
    )
    out = ch.add_employees(company.employee, batch, "no", AS_OF)
    hired = {r["emp_id"]: (r["first_name"], r["last_name"], r["hire_date"]) for r in out.audit.collect()}
    assert hired == {
        1012: ("Ann", "One", AS_OF), 1013: ("Gus", "Seven", AS_OF), 1014: ("Hal", "Nine", AS_OF),
    }
    assert {r["no"]: r["reject_code"] for r in out.rejected.collect()} == {
        2: labels.NAMES_REQUIRED, 3: labels.GENDER_INVALID, 4: labels.AGE_INVALID, 5: ch.EMAIL_EXISTS,
        6: ch.EMAIL_EXISTS, 8: labels.GENDER_INVALID,
    }
    assert out.rows.count() == 15 and out.audit.count() + out.rejected.count() == 9


def test_first_hire_into_an_empty_table(spark, company):
    batch = hire(spark, [(1, "Ann", "One", "F", 30, None, None, 1, 100)])
    out = ch.add_employees(company.employee.where("false"), batch, "no", AS_OF)
    assert [r["emp_id"] for r in out.rows.collect()] == [1000]


def test_qualifications_need_an_employee(spark, company):
    batch = spark.createDataFrame([(1000, "Docker"), (55, "Docker")], "emp_id bigint, qual_title string")
    out = ch.add_qualifications(batch, company.employee, AS_OF)
    assert [(r["emp_id"], r["grant_date"]) for r in out.rows.collect()] == [(1000, AS_OF)]
    assert [r["emp_id"] for r in out.rejected.collect()] == [55]


def test_leave_decisions(spark, company):
    batch = spark.createDataFrame(
        [(3002, "APPROVED", 1003), (3000, "REJECTED", 1004), (3001, "MAYBE", 1), (9, "APPROVED", 1), (3003, None, 7)],
        "leave_id bigint, status string, approved_by bigint",
    )
    out = ch.decide_leave(company.leave, batch)
    assert {r["leave_id"]: (r["status"], r["approved_by"]) for r in out.rows.collect()} == {
        3000: ("REJECTED", 1004), 3001: ("APPROVED", 1003), 3002: ("APPROVED", 1003), 3003: ("PENDING", 7),
    }
    assert {r["leave_id"]: r["reject_code"] for r in out.rejected.collect()} == {
        3001: labels.STATUS_INVALID, 9: ch.LEAVE_UNKNOWN,
    }
    changed = ch.status_changes(company.leave, out.rows).collect()
    assert {r["leave_id"] for r in changed} == {3000, 3002, 3003}


def test_leave_requests(spark):
    batch = spark.createDataFrame(
        [(1, date(2024, 6, 11), date(2024, 6, 15)), (2, date(2024, 6, 11), date(2024, 6, 9)),
         (3, date(2024, 6, 11), date(2024, 6, 10)), (4, date(2024, 6, 11), None)],
        "emp_id bigint, leave_start date, leave_end date",
    )
    out = ch.request_leave(batch)
    assert {r["emp_id"]: r["result"] for r in out.rows.collect()} == {
        1: "SUCCESS: Leave request submitted (5 days)", 4: "SUCCESS: Leave request submitted ( days)",
    }
    assert {r["emp_id"]: r["result"] for r in out.rejected.collect()} == {
        2: "ERROR: End date must be after start date", 3: "ERROR: leave_dates",
    }


def test_payroll_amounts(spark, company):
    pay = company.employee.join(company.salary_bonus.selectExpr("salary_id", "amount AS gross"), "salary_id")
    bulk = ch.bulk_payroll(pay, AS_OF)
    assert bulk.count() == 12
    row = bulk.where("emp_id = 1000").first()
    assert (row["deductions"], row["net_amount"], row["payment_status"]) == (
        Decimal("19000.00"), Decimal("76000.00"), "PROCESSED",
    )
    done = ch.process_payroll(payroll_batch(spark, [(1, "95000", None, None, 1000)])).first()
    assert (done["deductions"], done["net_amount"]) == (Decimal("28500.00"), Decimal("66500.00"))


def test_notices_skip_unknown_employees(spark, company):
    batch = payroll_batch(spark, [(1, "95000", "1", "66500.50", 1001), (2, "1", "1", "1", 77)])
    got = ch.payroll_notices(batch, company.employee).collect()
    assert [r["notice"] for r in got] == ["Notification: Payroll processed for Jane Smith - Net: $66500.5"]


def test_every_proposal_is_logged_refused_or_equal(spark, company):
    batch = raises(spark, [(100, "99000", 1), (100, None, 2), (999, "5", 3), (100, "99000", 4), (101, "1", 5), (None, "7", 6)])
    out = ch.guard_no_decrease(company.salary_bonus, batch, ["step"], AS_OF, "hr")
    refused = sorted((r["salary_id"] or 0, r["reject_code"]) for r in out.rejected.collect())
    assert refused == [(0, ch.SALARY_UNKNOWN), (100, ch.AMOUNT_MISSING), (101, labels.CUT_REFUSED), (999, ch.SALARY_UNKNOWN)]
    equal = 1
    assert out.audit.count() + len(refused) + equal == 6
    assert out.rows.count() == company.salary_bonus.count()


def test_repeated_changes_leave_a_snapshot_with_unique_keys(spark, company):
    decisions = spark.createDataFrame(
        [(3000, "APPROVED", 1, 2), (3000, "REJECTED", 5, 3), (3000, "APPROVED", 9, 1), (3000, "REJECTED", 5, 3), (9, None, 1, 1)],
        "leave_id bigint, status string, approved_by bigint, step int",
    )
    out = ch.decide_leave(company.leave, decisions, ["step"])
    row = out.rows.where("leave_id = 3000").collect()
    assert [(r["status"], r["approved_by"]) for r in row] == [("REJECTED", 5)]
    codes = sorted((r["approved_by"], r["reject_code"]) for r in out.rejected.collect())
    assert codes == [(1, ch.LEAVE_UNKNOWN), (1, ch.SUPERSEDED), (5, ch.SUPERSEDED), (9, ch.SUPERSEDED)]
    change = spark.createDataFrame(
        [(1000, "Jon", "Doe", None, "1", 1), (1000, "Jo", "Doe", "e", "2", 2)],
        "emp_id bigint, first_name string, last_name string, email string, phone string, step int",
    )
    got = ch.update_directory(company.employee, change, ["step"])
    assert got.count() == company.employee.count()
    assert got.where("emp_id = 1000").first()["first_name"] == "Jo"


def test_audit_ids_follow_the_log(spark, company):
    batch = raises(spark, [(100, "99000", 1), (101, "99000", 2)])
    rows = ch.guard_no_decrease(company.salary_bonus, batch, ["step"], AS_OF, "hr").audit
    log = ch.audit_rows(rows, "salary_audit_log", ["salary_id"])
    assert [(r["audit_id"], r["salary_id"]) for r in log.orderBy("audit_id").collect()] == [(1, 100), (2, 101)]
    more = ch.audit_rows(rows, "salary_audit_log", ["salary_id"], log)
    assert sorted(r["audit_id"] for r in more.collect()) == [3, 4]


def many_rows_a_leave(spark):
    leave = spark.range(4000).selectExpr("id AS leave_id", "'PENDING' AS status", "CAST(NULL AS BIGINT) AS approved_by")
    decisions = spark.range(20000).selectExpr(
        "IF(id % 500 = 7, NULL, id % 5000) AS leave_id",
        "IF(id % 3 = 0, 'APPROVED', 'REJECTED') AS status",
        "id AS approved_by",
        "IF(id < 5000, NULL, CAST(id / 10000 AS INT)) AS step",
    )
    return leave, decisions


def small_tasks(monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 2000, raising=False)
    monkeypatch.setattr(ch, "BROADCAST_ROWS", 1000, raising=False)


def test_a_large_batch_of_decisions_is_dealt_to_tasks_of_bounded_size(spark, monkeypatch):
    small_tasks(monkeypatch)
    leave, decisions = many_rows_a_leave(spark)
    rows = ch.decide_leave(leave, decisions, ["step"]).rows
    assert rows.rdd.getNumPartitions() == 12
    want = {}
    for r in decisions.where("leave_id < 4000").collect():
        rank = (-1 if r["step"] is None else r["step"], r["status"], r["approved_by"])
        want[r["leave_id"]] = max(want.get(r["leave_id"], rank), rank)
    got = {r["leave_id"]: (r["status"], r["approved_by"]) for r in rows.collect()}
    assert rows.count() == len(got) == 4000
    assert got == {k: want[k][1:] if k in want else ("PENDING", None) for k in range(4000)}


def test_a_small_batch_of_decisions_leaves_the_snapshot_where_it_is(spark):
    leave, decisions = many_rows_a_leave(spark)
    plan = ch.decide_leave(leave, decisions.limit(3), ["step"]).rows._jdf.queryExecution().toString()
    assert "RepartitionByExpression" not in plan


def test_rejects_of_a_large_batch_are_whole_and_dealt(spark, monkeypatch):
    small_tasks(monkeypatch)
    leave, decisions = many_rows_a_leave(spark)
    batch = decisions.union(decisions.where("approved_by IN (2, 17345)"))
    rejected = ch.decide_leave(leave, batch, ["step"]).rejected
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [leave_id" in plan and "Aggregate [leave_id#" in plan and "_times" not in plan
    codes = Counter(r["reject_code"] for r in rejected.collect())
    known = batch.where("leave_id < 4000")
    assert codes == {
        ch.SUPERSEDED: known.count() - known.select("leave_id").distinct().count(),
        ch.LEAVE_UNKNOWN: batch.where("leave_id >= 4000 OR leave_id IS NULL").count(),
    }
    again = rejected.where("approved_by IN (2, 17345)").groupBy("approved_by", "reject_code").count().collect()
    assert {tuple(r) for r in again} == {(2, ch.SUPERSEDED, 2), (17345, ch.SUPERSEDED, 1)}


def test_rejects_of_a_large_batch_come_from_one_pass(spark, monkeypatch):
    small_tasks(monkeypatch)
    leave, decisions = many_rows_a_leave(spark)
    batch = decisions.withColumn("status", F.expr("IF(approved_by % 50 = 3, 'MAYBE', status)"))
    rejected = ch.decide_leave(leave, batch, ["step"]).rejected
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2 and plan.count("Window [") == 1  # snapshot and batch
    last = {}
    for r in batch.where("status <> 'MAYBE' AND leave_id < 4000").collect():
        rank = (-1 if r["step"] is None else r["step"], r["status"], r["approved_by"])
        last[r["leave_id"]] = max(last.get(r["leave_id"], rank), rank)
    want = []
    for r in batch.collect():
        if r["status"] == "MAYBE":
            want.append((*r, labels.STATUS_INVALID))
        elif r["leave_id"] is None or r["leave_id"] >= 4000:
            want.append((*r, ch.LEAVE_UNKNOWN))
        elif last[r["leave_id"]][2] != r["approved_by"]:
            want.append((*r, ch.SUPERSEDED))
    assert rejected.columns == [*batch.columns, "reject_code"]
    assert Counter(map(tuple, rejected.collect())) == Counter(want)


def test_decisions_without_a_leave_do_not_meet_in_one_task(spark, monkeypatch):
    small_tasks(monkeypatch)
    leave, decisions = many_rows_a_leave(spark)
    nowhere = decisions.withColumn("leave_id", F.expr("IF(approved_by % 3 > 0, NULL, leave_id)"))
    status = F.expr("CASE approved_by % 7 WHEN 1 THEN 'PENDING' WHEN 2 THEN NULL ELSE status END")
    batch = nowhere.withColumn("status", status)
    rejected = ch.decide_leave(leave, batch, ["step"]).rejected
    unknown = rejected.where("leave_id IS NULL AND reject_code = 'LEAVE_NOT_FOUND'")
    assert unknown.select(F.spark_partition_id()).distinct().count() == batch.rdd.getNumPartitions() > 1
    got = Counter((r["status"], r["approved_by"]) for r in unknown.collect())
    want = batch.where("leave_id IS NULL AND (status IS NULL OR status <> 'PENDING')").collect()
    assert got == Counter((r["status"] or labels.PENDING, r["approved_by"]) for r in want)
    invalid = rejected.where(F.col("reject_code") == labels.STATUS_INVALID)
    assert invalid.count() == batch.where("status = 'PENDING'").count()
