"""Skew-safe joins give the rows of the plain joins they replace."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.registry import all_checks, runner
from rosterlake import session
from rosterlake.operators import joins as j
from rosterlake.operators.grouping import margin, rollup_sums, with_share, with_total


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def sides(spark):
    one = spark.createDataFrame([(i, f"n{i}") for i in range(20)] + [(None, "none")], "id bigint, name string")
    many = [(3 if i % 3 else i % 25, i) for i in range(200)] + [(None, 900), (None, 901)]
    return one, spark.createDataFrame(many, "fk bigint, item bigint")


def test_outer_to_many(sides):
    one, many = sides
    plain = one.join(many, F.col("id") == F.col("fk"), "left").select("id", "name", "fk", "item")
    got = j.outer_to_many(one, many, "id", "fk").select("id", "name", "fk", "item")
    assert rows(got) == rows(plain)


def test_full_outer_to_many(sides):
    one, many = sides
    plain = one.join(many, F.col("id") == F.col("fk"), "full").select("id", "name", "fk", "item")
    got = j.full_outer_to_many(one, many, "id", "fk").select("id", "name", "fk", "item")
    assert rows(got) == rows(plain)


def test_matching_and_without(sides):
    one, many = sides
    used = {3} | {i % 25 for i in range(0, 200, 3)}
    assert {r["id"] for r in j.matching(one, many, "id", "fk").collect()} == used & set(range(20))
    left = {r["id"] for r in j.without(one, many, "id", "fk").collect()}
    assert left == (set(range(20)) - used) | {None}


def test_flag_existing(sides):
    one, many = sides
    got = {r["id"]: r["hit"] for r in j.flag_existing(one, many, "id", "hit", "fk").collect()}
    assert got[3] is True and got[None] is False and len(got) == 21


def test_null_safe_matches_null(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    got = j.null_safe(left, right, ["k"])
    assert got.columns == ["k", "v", "w"]
    assert rows(got) == Counter({(None, 1, 10): 1, ("a", 2, 20): 1})


def test_totals_and_shares(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 4)], "k string, v bigint")
    got = with_total(with_total(df, "v", "per", ["k"]), "v", "all")
    assert rows(got) == Counter({("a", 1, 4, 8): 1, ("a", 3, 4, 8): 1, (None, 4, 4, 8): 1})
    zero = spark.createDataFrame([(0,), (0,)], "v bigint")
    assert {r["pct"] for r in with_share(zero, "v", "pct").collect()} == {None}


def test_margin_keeps_null_of_the_data(spark):
    df = spark.createDataFrame([("M",), ("M",), (None,)], "gender string")
    got = df.rollup("gender").agg(margin("gender", "BOTH").alias("label"), F.count("*").alias("n"))
    assert rows(got.select("label", "n")) == Counter({("M", 2): 1, (None, 1): 1, ("BOTH", 3): 1})


def test_rollup_sums_are_those_of_rollup(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    df = spark.range(1000).selectExpr(
        "IF(id % 10 = 3, NULL, id % 7) AS a", "IF(id % 9 = 1, NULL, id % 11) AS b", "CAST(id % 50 AS DECIMAL(4,1)) AS v"
    )
    got = rollup_sums(df, ["a", "b"], "v")
    want = df.rollup("a", "b").agg(F.grouping_id().cast("bigint").alias("level"), F.sum("v").alias("v"))
    assert got.columns == want.columns and rows(got) == rows(want)
    assert rows(rollup_sums(df.where("a > 99"), ["a", "b"], "v")) == Counter()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "RepartitionByExpression [a" in plan and ", 10" in plan


def test_registered_rollup_groups_its_details_once(spark):
    plan = runner(all_checks()["a07_rollup_two"])(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    assert "Expand" not in plan.toString()
