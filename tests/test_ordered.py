"""Numbering, frames and ranks against brute force, with a group that holds most rows."""

import random
from decimal import Decimal

import pytest

from rosterlake.operators import ordered as o

SCHEMA = "grp string, val decimal(12,2), id bigint"


def sample(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        grp = rng.choice(["hot", "hot", "hot", "a", "b", None])
        val = None if rng.random() < 0.05 else Decimal(rng.choice([500, 500, rng.randint(-900, 900)])) / 100
        rows.append((grp, val, i))
    rng.shuffle(rows)
    return rows


def in_order(rows, descending):
    """NULL is the largest value: first when descending, last when ascending."""

    def key(row):
        val = row[1]
        if descending:
            return (0, 0, row[2]) if val is None else (1, -val, row[2])
        return (1, 0, row[2]) if val is None else (0, val, row[2])

    return sorted(rows, key=key)


def groups(rows, grouped):
    keys = {r[0] if grouped else "all" for r in rows}
    return {k: [r for r in rows if not grouped or r[0] == k] for k in keys}


def brute(rows, descending, grouped):
    want = {}
    for members in groups(rows, grouped).values():
        line = in_order(members, descending)
        vals = [r[1] for r in line]
        for i, row in enumerate(line):
            known = [v for v in vals[: i + 1] if v is not None]
            earlier = [v for v in vals[:i] if v is not None]
            near = [v for v in vals[max(0, i - 2) : i + 3] if v is not None]
            mean = None
            if near:
                total, count = sum(near) * 100, len(near)
                size = (2 * abs(int(total)) + count) // (2 * count)
                mean = Decimal(size if total >= 0 else -size) / 100
            want[row[2]] = (
                i + 1,
                sum(known) if known else None,
                max(earlier) if earlier else None,
                vals[i - 1] if i else None,
                vals[i + 3] if i + 3 < len(vals) else None,
                mean,
            )
    return want


FRAMES = {
    "n": o.position(),
    "total": o.running_sum("val"),
    "top": o.largest_before("val"),
    "prev": o.previous("val"),
    "next3": o.following("val", 3),
    "near": o.moving_mean("val", 2, 2),
}


@pytest.mark.parametrize("grouped", [False, True])
@pytest.mark.parametrize("descending", [False, True])
def test_frames_over_slices_and_blocks(many_slices, grouped, descending):
    rows = sample(1)
    df = many_slices.createDataFrame(rows, SCHEMA).repartition(7)
    order = ["-val" if descending else "val", "id"]
    keys = ["grp"] if grouped else []
    got = o.over_order(df, order, FRAMES, keys, block_rows=16)
    assert got.columns == ["grp", "val", "id", *FRAMES]
    found = {r["id"]: tuple(r[n] for n in FRAMES) for r in got.collect()}
    assert found == brute(rows, descending, grouped)


@pytest.mark.parametrize("block_rows", [1, 4, 1024])
def test_block_size_does_not_matter(many_slices, block_rows):
    rows = sample(2, 60)
    df = many_slices.createDataFrame(rows, SCHEMA)
    got = o.over_order(df, ["-val", "id"], FRAMES, ["grp"], block_rows=block_rows)
    assert {r["id"]: tuple(r[n] for n in FRAMES) for r in got.collect()} == brute(rows, True, True)


def test_numbers_cover_several_partitions(many_slices):
    df = many_slices.range(1000).selectExpr("id", "'hot' AS grp")
    numbered = o.number_rows(df, ["grp", "-id"])
    assert sorted((r["row_num"], r["id"]) for r in numbered.collect()) == [
        (i + 1, 999 - i) for i in range(1000)
    ]
    # the rows of the one group were stored by more than one task
    files = {f for f in numbered.inputFiles()}
    assert len(files) > 1


def ranks(rows, grouped):
    want = {}
    for members in groups(rows, grouped).values():
        vals = [r[1] for r in in_order(members, True)]
        distinct = list(dict.fromkeys(vals))
        for row in members:
            want[row[2]] = (vals.index(row[1]) + 1, distinct.index(row[1]) + 1)
    return want


@pytest.mark.parametrize("grouped", [False, True])
def test_ranks_with_ties_and_nulls(many_slices, grouped):
    rows = sample(4)
    df = many_slices.createDataFrame(rows, SCHEMA)
    keys = ["grp"] if grouped else []
    got = o.rank_rows(df, "val", {"rank": "r", "dense_rank": "d"}, keys)
    assert {x["id"]: (x["r"], x["d"]) for x in got.collect()} == ranks(rows, grouped)


@pytest.mark.parametrize("slices", [1, 7, 60])
@pytest.mark.parametrize("grouped", [False, True])
def test_ranks_over_many_slices(many_slices, grouped, slices):
    """Groups and values that cover several slices, slices of one row, and empty ones."""
    rows = [("hot", Decimal(5), i) for i in range(60)] + [("hot", Decimal(i % 3), 100 + i) for i in range(30)]
    rows += [(None, None, 200 + i) for i in range(20)] + [("z", Decimal(i), 300 + i) for i in range(25)]
    df = many_slices.createDataFrame(rows, SCHEMA)
    got = o.rank_rows(df, "val", {"rank": "r", "dense_rank": "d"}, ["grp"] if grouped else [], slices=slices)
    assert {x["id"]: (x["r"], x["d"]) for x in got.collect()} == ranks(rows, grouped)


def test_ranks_are_not_joined_by_value(many_slices):
    df = many_slices.range(1000).selectExpr("id % 10 AS grp", "id % 7 AS val", "id")
    plan = o.rank_rows(df, "val", {"rank": "r"}, ["grp"])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("val" not in line and "grp" not in line and "_slice" in line or "Join Inner, (_slice" in line for line in joins)


@pytest.mark.parametrize("grouped", [False, True])
@pytest.mark.parametrize("by", ["rank", "dense_rank"])
def test_top_ranked_keeps_all_ties(many_slices, grouped, by):
    rows = sample(5)
    df = many_slices.createDataFrame(rows, SCHEMA)
    keys = ["grp"] if grouped else []
    got = o.top_ranked(df, "val", 3, {"rank": "r", "dense_rank": "d"}, keys, by)
    place = 0 if by == "rank" else 1
    want = {i: v for i, v in ranks(rows, grouped).items() if v[place] <= 3}
    assert {x["id"]: (x["r"], x["d"]) for x in got.collect()} == want


def test_share_of_group(many_slices):
    df = many_slices.createDataFrame([("a", Decimal(1), 1), ("a", Decimal(3), 2), ("b", Decimal(5), 3)], SCHEMA)
    got = o.rank_rows(df, "val", {"rank": "r"}, ["grp"], share="pct")
    assert {r["id"]: float(r["pct"]) for r in got.collect()} == {1: 25.0, 2: 75.0, 3: 100.0}


def test_assigned_keys_follow_each_other(many_slices):
    df = many_slices.range(200).repartition(6)
    got = o.assign_keys(df, ["-id"], "key", 5000).collect()
    assert sorted((r["key"], r["id"]) for r in got) == [(5000 + i, 199 - i) for i in range(200)]


def test_sides_are_broadcast_by_counted_rows(spark, monkeypatch):
    from rosterlake import session

    def plan(side):
        return spark.range(10**6).join(side, "id")._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(session.small_side(spark.range(10)))
    monkeypatch.setattr(session, "BROADCAST_ROWS", 9)
    assert "broadcast" not in plan(session.small_side(spark.range(10)))


def test_empty_input(many_slices):
    df = many_slices.createDataFrame([], SCHEMA)
    assert o.over_order(df, ["val", "id"], FRAMES, ["grp"]).count() == 0
    assert o.rank_rows(df, "val", {"rank": "r"}).count() == 0
