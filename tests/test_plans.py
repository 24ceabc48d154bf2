"""Shape of the physical plans of all registered queries."""

import re

import pytest

from checks.registry import all_checks, runner

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")
EAGER = ("t01", "t02", "v08", "v11")  # they run jobs of their own while the plan is built


def plan_of(spark, name):
    df = runner(all_checks()[name])(spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold",)
    for n in names:
        spark.conf.set(n, "-1")  # as if no table were small
    found = {n: plan_of(spark, n) for n in all_checks() if not n.startswith(EAGER)}
    for n in names:
        spark.conf.unset(n)
    return found


def test_no_cross_join_and_no_python(plans):
    bad = {n: w for n, p in plans.items() for w in FORBIDDEN if w in p}
    assert bad == {}


def test_windows_without_groups_are_over_totals(plans):
    """Only slice and block totals are gathered in one task."""
    lone = re.compile(r"(Window \[[^\n]*)\n[^\n]*\n[^\n]*SinglePartition")
    single = {
        n
        for n, p in plans.items()
        for window in lone.findall(p)
        if "_slice" not in window and "_block" not in window  # one row per slice or block
    }
    assert single <= {"ag05_top_paid"}  # the k largest distinct amounts


def test_pruning_and_pushdown(plans):
    expense = plans["ag08_payroll_expense"]
    assert "o_orderpriority" not in expense and "o_orderdate" not in expense
    assert re.search(r"PushedFilters: \[[^\]]*o_orderdate", plans["mo01_missing_payroll"])
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,25.0)]" in plans["s01_load_table"]


def test_top_per_group_is_cut_before_the_shuffle(spark, plans, monkeypatch):
    from rosterlake import session

    written = []

    def recorded(df, name="stage", write=session.materialize):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(session, "materialize", recorded)
    for name in ("w04_top_per_group", "rp02_top_paid_per_department"):
        written.clear()
        plan_of(spark, name)
        assert any("WindowGroupLimit" in p for p in written)
    for name in ("o05_top_k", "vw11_top_earners", "mo07_recent_executions"):
        assert "TakeOrderedAndProject" in plans[name]
