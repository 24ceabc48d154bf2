"""ALL and ANY with empty sets and NULLs, and the hierarchy walk."""

from collections import Counter
from decimal import Decimal

import pytest


from rosterlake.operators.hierarchy import approval_levels
from rosterlake.operators.subqueries import average_of, greater_than_all, greater_than_any


def _values(df):
    return sorted((r[0] for r in df.collect()), key=lambda v: (v is None, v))


def test_greater_than_all(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "x int")
    some = spark.createDataFrame([(2,), (5,)], "y int")
    assert _values(greater_than_all(df, "x", some, "y")) == [9]
    assert _values(greater_than_all(df, "x", some.where("y > 99"), "y")) == [1, 5, 9, None]
    with_null = spark.createDataFrame([(2,), (None,)], "y int")
    assert _values(greater_than_all(df, "x", with_null, "y")) == []


def test_greater_than_any(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "x int")
    some = spark.createDataFrame([(2,), (5,), (None,)], "y int")
    assert _values(greater_than_any(df, "x", some, "y")) == [5, 9]
    assert _values(greater_than_any(df, "x", some.where("y > 99"), "y")) == []
    only_null = spark.createDataFrame([(None,)], "y int")
    assert _values(greater_than_any(df, "x", only_null, "y")) == []


def test_average_of_empty_table_is_null(spark):
    df = spark.createDataFrame([(Decimal(1),)], "x decimal(8,2)")
    assert df.where(df.x > average_of(df.where("x > 5"), "x")).count() == 0


def test_levels_count_every_path(spark):
    seeds = [1, 2, 3]
    links = [(1, 4), (1, 4), (2, 4), (4, 5), (4, 6), (6, 4), (3, None), (None, 5)]
    level = Counter(seeds)
    want = {(n, 1): c for n, c in level.items()}
    for lvl in range(2, 6):
        nxt = Counter()
        for child, parent in links:
            if child in level and parent is not None:
                nxt[parent] += level[child]
        level = nxt
        want.update({(n, lvl): c for n, c in level.items()})
    got = approval_levels(
        spark.createDataFrame([(s,) for s in seeds], "node bigint"),
        spark.createDataFrame(links, "child bigint, parent bigint"),
    )
    assert {(r["node"], r["lvl"]): int(r["paths"]) for r in got.collect()} == want
