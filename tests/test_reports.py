"""Reports on the fixture with worked results, refreshes, the payroll run and streams."""

from datetime import date
from decimal import Decimal

import pytest

from rosterlake import labels
from rosterlake.plans import matches, monitoring, nested, pay_summary, views
from rosterlake.session import new_path
from rosterlake.streaming.validation import read_committed, stream_validate_leave, stream_validate_payroll

from .fixtures import AS_OF


def by(df, *columns):
    return {r[0]: tuple(r)[1:] if len(columns) > 2 else r[1] for r in df.select(*columns).collect()}


def test_budget_rollup(company):
    got = {r["department"]: r for r in pay_summary.budget_with_total(company).collect()}
    total = got.pop("GRAND TOTAL")
    assert total["headcount"] == 12 and total["salary_budget"] == Decimal("830000.00")
    assert sum(r["salary_budget"] for r in got.values()) == total["salary_budget"]
    assert got["Engineering"]["avg_salary"] == Decimal("81666.67")
    assert {r["level_type"] for r in got.values()} == {"Department"}


def test_shares_sum_to_100(company):
    shares = [r["pct_of_total_payroll"] for r in pay_summary.payroll_expense(company).collect()]
    assert abs(sum(shares) - 100) < Decimal("0.05")


def test_top_paid_keeps_ties(company):
    got = pay_summary.top_paid(company, 3).collect()
    # 95000, 85000 and twice 75000
    assert [(r["row_num"], r["rank_no"], r["dense_rank_no"]) for r in got] == [
        (1, 1, 1), (2, 2, 2), (3, 3, 3), (4, 3, 3),
    ]


def test_top_paid_per_department(company):
    got = pay_summary.top_paid_per_department(company, 1).collect()
    assert {(r["job_id"], r["emp_id"]) for r in got} == {
        (1, 1000), (2, 1003), (2, 1004), (3, 1005), (4, 1008), (4, 1009), (5, 1010),
    }


def test_running_total_ends_at_the_sum(company):
    rows = pay_summary.pay_running_totals(company).collect()
    assert rows[-1]["running_total"] == Decimal("830000.00") and rows[-1]["cumulative_count"] == 12
    assert rows[0]["moving_avg"] == Decimal("85000.00")  # 95000, 85000, 75000


def test_empty_department_is_kept(company):
    fuller = company.replacing(
        job_department=company.job_department.unionByName(
            company.job_department.limit(1).selectExpr("* EXCEPT (job_id, dept_name)", "9L AS job_id", "'Legal' AS dept_name")
        )
    )
    budget = by(pay_summary.salary_budget(fuller), "dept_name", "employee_count", "total_salary")
    assert budget["Legal"] == (0, None)
    example = by(matches.departments_with_example(fuller), "dept_name", "employee_count", "example_employee")
    assert example["Legal"] == (0, "No employees")
    cube = {(r["department"], r["gender"]): r for r in pay_summary.pay_by_department_and_gender(fuller).collect()}
    assert cube["Legal", None]["employee_count"] == 0  # a NULL gender is not the margin
    assert cube["Legal", "BOTH"]["employee_count"] == 0
    assert cube["TOTAL", "BOTH"]["employee_count"] == 12


def test_weighted_and_safe_department_figures(company):
    weighted = by(matches.department_payroll(company), "dept_name", "headcount", "avg_salary")
    safe = by(matches.department_payroll(company, per_payroll_row=False), "dept_name", "headcount", "avg_salary")
    # John Doe has three payroll rows, so 95000 counts three times
    assert weighted["Engineering"] == (3, Decimal("87000.00"))
    assert safe["Engineering"] == (3, Decimal("81666.67"))
    literal = by(views.department_summary(company, AS_OF), "dept_name", "headcount", "total_payroll_records")
    assert literal["Engineering"] == (5, 5)
    once = by(views.department_summary(company, AS_OF, per_payroll_row=False), "dept_name", "headcount", "total_payroll_records")
    assert once["Engineering"] == (3, 5)


def test_staff_and_leave_has_all_three_kinds(spark, company):
    orphan = spark.createDataFrame([(77, 4000, "SICK", date(2024, 5, 1))], "emp_id bigint, leave_id bigint, leave_type string, leave_start date")
    more = company.replacing(leave=company.leave.unionByName(orphan, allowMissingColumns=True))
    rows = matches.staff_and_leave(more).collect()
    assert len(rows) == 13
    named = {r["emp_id"]: (r["employee_name"], r["leave_type"], r["last_leave_start"]) for r in rows}
    assert named[77] == ("ORPHANED LEAVE", "SICK", "2024-05-01")
    assert named[1002] == ("Michael Johnson", "N/A", "Never")
    assert named[1005] == ("Emily Davis", "SICK", "2024-03-05")


def test_profile_counts_children_apart(company):
    got = by(views.employee_profile(company), "emp_id", "total_leave_requests", "qualification_count", "payroll_records")
    assert got[1000] == (1, 2, 3) and got[1011] == (0, 0, 1)


def test_leave_view_and_statistics(company):
    got = by(views.leave_management(company, AS_OF), "leave_id", "days_requested", "status_description", "approved_by_manager")
    assert got[3000] == (3, "Approved by Manager", "Sarah Williams")
    assert got[3002] == (1, "Awaiting Approval", "Sarah Williams")
    finance = {r["dept_name"]: r for r in views.leave_statistics(company, AS_OF).collect()}["Finance"]
    assert (finance["total_leave_requests"], finance["approved_count"], finance["pending_count"]) == (2, 1, 1)
    assert finance["avg_leave_duration"] == Decimal("7.50")  # 15 days and an open one


def test_qualification_ages(company):
    got = by(views.employee_qualifications(company, AS_OF), "qual_id", "years_since_certification", "certification_status")
    assert got[5007] == (3, "Renewal Recommended") and got[5000][0] == 14


def test_approval_chain(company):
    got = {(r["hierarchy"], r["lvl"]): (r["role"], int(r["paths"])) for r in nested.approval_chain(company).collect()}
    assert got[("  Sarah Williams", 2)] == ("Approver", 4)
    assert len(got) == 12  # eleven who approve nobody, one approver reached four times
    assert ("Sarah Williams", 1) not in got


def test_high_pay_insert(company):
    rows = nested.payroll_of_high_pay(company, AS_OF).collect()
    # average of the pay rows is 71250
    assert {r["emp_id"] for r in rows} == {1000, 1001, 1002, 1005}
    john = next(r for r in rows if r["emp_id"] == 1000)
    assert (john["deductions"], john["net_amount"]) == (Decimal("14250.00"), Decimal("80750.00"))


def test_daily_audit(company):
    row = monitoring.daily_audit(company, AS_OF).first()
    assert (row["missing"], row["warnings"], row["status"]) == (0, 0, "SUCCESS")
    later = monitoring.daily_audit(company, date(2024, 7, 1)).first()
    assert (later["missing"], later["status"], later["records_affected"]) == (12, "FAILED", 12)


def test_leave_monitoring(company):
    assert monitoring.upcoming_leave(company, date(2024, 2, 3)).first()[0] == 0
    assert monitoring.upcoming_leave(company, date(2024, 2, 4)).first()[0] == 1
    assert monitoring.overdue_leave(company, date(2024, 3, 5)).first()[0] == 1
    assert monitoring.approved_from(company, date(2024, 2, 10)).first()[0] == 2
    assert labels.VARIANCE_LIMIT == 20 and labels.AUDIT_LIMIT == 50


def test_refresh_keeps_the_former_copy(spark, company):
    base = new_path(spark, "summary")
    first = views.refresh(views.monthly_payroll(company, AS_OF), base)
    assert views.latest_refresh(spark, base) == 1
    paid = first.agg({"payroll_records": "sum"}).first()[0]
    second = views.refresh(views.monthly_payroll(company.replacing(payroll=company.payroll.where("emp_id = 1000")), AS_OF), base)
    assert views.latest_refresh(spark, base) == 2
    assert second.agg({"payroll_records": "sum"}).first()[0] == 3
    assert first.agg({"payroll_records": "sum"}).first()[0] == paid == 14
    assert views.current_summary(spark, base).count() == 1
    # a copy without its commit marker is neither read nor overwritten
    company.payroll.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{base}/refresh_no=3"
    )
    assert views.latest_refresh(spark, base) == 2
    third = views.refresh(views.monthly_payroll(company, AS_OF), base, ("payroll_month",))
    assert views.latest_refresh(spark, base) == 4
    assert third.agg({"payroll_records": "sum"}).first()[0] == 14


def test_views_are_usable_in_sql(spark, company):
    assert len(views.register_views(company, AS_OF)) == 7
    assert spark.sql("SELECT count(*) FROM vw_employee_profile").first()[0] == 12


def test_payroll_run(spark, company):
    batch = company.payroll.where("payroll_id >= 2003").selectExpr(
        "* EXCEPT (payroll_id, gross_amount, net_amount)",
        "payroll_id + 1000 AS payroll_id",
        "CAST(gross_amount * IF(emp_id = 1004, 2, 1) AS DECIMAL(10,2)) AS gross_amount",
        "CAST(NULL AS DECIMAL(10,2)) AS net_amount",
    )
    run = monitoring.payroll_run(company, batch, AS_OF, new_path(spark, "monthly"))
    assert run.processed.count() == 12
    assert [(r["audit_id"], r["emp_id"]) for r in run.audit.collect()] == [(1, 1004)]
    assert run.checks.first()["warnings"] == 1
    assert run.report.agg({"payroll_records": "sum"}).first()[0] == 26


def test_stream_of_payroll_files(spark, company):
    source, out, progress = (new_path(spark, n) for n in ("arriving", "out", "progress"))
    batch = company.payroll.selectExpr(
        "* EXCEPT (gross_amount, net_amount)", "CAST(gross_amount * IF(emp_id = 1000, 2, 1) AS DECIMAL(10,2)) AS gross_amount",
        "CAST(NULL AS DECIMAL(10,2)) AS net_amount",
    )

    def arrive(rows):
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(batch.schema).parquet(source)
        query = stream_validate_payroll(stream, company.employee, company.salary_bonus, out, progress, AS_OF)
        query.awaitTermination()

    arrive(batch.where("emp_id <= 1005"))
    arrive(batch.where("emp_id > 1005"))
    accepted = read_committed(spark, out, "accepted")
    assert accepted.count() == 14 and accepted.select("batch_id").distinct().count() == 2
    assert accepted.where("net_amount IS NULL").count() == 0
    audit = read_committed(spark, out, "audit").collect()
    assert {r["emp_id"] for r in audit} == {1000} and sorted(r["audit_id"] for r in audit) == list(range(1, len(audit) + 1))
    # nothing new arrives: nothing is stored again
    query = stream_validate_payroll(
        spark.readStream.schema(batch.schema).parquet(source), company.employee, company.salary_bonus, out, progress, AS_OF
    )
    query.awaitTermination()
    assert read_committed(spark, out, "accepted").count() == 14


def test_stream_of_leave_files(spark, company):
    source, out, progress = (new_path(spark, n) for n in ("arriving", "out", "progress"))
    company.leave.selectExpr(
        "* EXCEPT (leave_end, status)", "IF(leave_id = 3001, DATE '2000-01-01', leave_end) AS leave_end",
        "CAST(NULL AS STRING) AS status",
    ).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    stream_validate_leave(stream, out, progress).awaitTermination()
    accepted = read_committed(spark, out, "accepted")
    assert {r["status"] for r in accepted.collect()} == {"PENDING"} and accepted.count() == 3
    assert [r["leave_id"] for r in read_committed(spark, out, "rejected").collect()] == [3001]


def test_a_stopped_run_goes_on(spark, company, monkeypatch):
    """Finished steps are not made again; the run ends with the rows of one without a stop."""
    from rosterlake.plans import monitoring, runs

    base, made = new_path(spark, "monthly"), []
    check, audit = monitoring.check_variance, monitoring.daily_audit
    monkeypatch.setattr(monitoring, "check_variance", lambda *a: made.append("validated") or check(*a))

    def lost(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(monitoring, "daily_audit", lost)
    with pytest.raises(RuntimeError):
        monitoring.payroll_run(company, company.payroll, AS_OF, base, "june")
    assert {r["step"] for r in runs.Run(spark, f"{base}-runs", "june").steps().collect()} == {"validated", "processed", "audit"}
    monkeypatch.setattr(monitoring, "daily_audit", audit)
    run = monitoring.payroll_run(company, company.payroll, AS_OF, base, "june")
    again = monitoring.payroll_run(company, company.payroll, AS_OF, base, "june")
    assert made == ["validated"] and run.processed.count() == again.processed.count() == 14
    assert [r["step"] for r in again.steps.collect()] == ["validated", "processed", "audit", "checks", "report"]
    other = monitoring.payroll_run(company, company.payroll, AS_OF, base)
    assert other.checks.collect() == run.checks.collect() and len(made) == 2
    assert runs.remove_old_runs(spark, f"{base}-runs", keep=1) == ["june"] and len(runs.runs_of(spark, f"{base}-runs")) == 1
    assert other.audit.count() >= 0


def test_figures_come_from_one_scan(company):
    from rosterlake.plans import monitoring

    plan = monitoring.leave_figures(company, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("leave_start#") and plan.count("Aggregate") == 1 and plan.count("Filter") == 1
