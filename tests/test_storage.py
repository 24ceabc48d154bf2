"""Commits of several tables, key ranges across batches, snapshots in buckets."""

import threading

import pytest
from pyspark.sql import functions as F

from rosterlake.operators.changes import apply_updates, audit_rows
from rosterlake.session import new_path
from rosterlake.sources.commits import CommitLog
from rosterlake.sources.ledger import KeyLedger
from rosterlake.sources.records import Records
from rosterlake.sources.snapshots import BucketedSnapshot, ConcurrentChange


def failing(rows):
    """The rows, whose computation fails."""
    return rows.withColumn("x", F.raise_error(F.lit("lost")).cast("bigint"))


def values(df, column="x"):
    return sorted(r[column] for r in df.collect())


def test_records_are_written_once(spark):
    records = Records(spark, new_path(spark, "records"))
    assert records.names() == [] and records.all() == {}
    assert records.put("a", {"n": 1}) and not records.put("a", {"n": 2}) and records.put("b", {"n": 3})
    assert records.names() == ["a", "b"] and [r["n"] for r in records.all().values()] == [1, 3]


def test_a_batch_that_fails_between_two_tables_is_not_seen(spark):
    log = CommitLog(spark, new_path(spark, "log"))
    rows = spark.range(3).withColumnRenamed("id", "x")
    log.commit(0, {"accepted": rows, "audit": rows.limit(1)})
    more = rows.selectExpr("x + 10 AS x")
    with pytest.raises(Exception, match="lost"):
        log.commit(1, {"accepted": more, "audit": failing(more)})
    # the first table of the batch is stored, but neither is seen
    assert values(log.read("accepted")) == [0, 1, 2] and values(log.read("audit")) == [0]
    assert log.commit(1, {"accepted": more, "audit": more})
    assert values(log.read("accepted")) == [0, 1, 2, 10, 11, 12] and values(log.read("audit")) == [0, 10, 11, 12]
    # a repeated batch is not stored again
    assert not log.commit(1, {"accepted": more, "audit": more})
    assert log.read("accepted").count() == 6 and log.committed() == ["0", "1"]
    assert {r["batch_id"] for r in log.read("accepted").collect()} == {"0", "1"}


def test_reading_before_the_first_commit(spark):
    log = CommitLog(spark, new_path(spark, "log"))
    with pytest.raises(ValueError, match="no batch"):
        log.read("accepted")
    assert log.read("accepted", spark.range(1).schema).count() == 0
    log.commit("first", {"accepted": spark.range(0)})
    assert log.read("accepted").count() == 0


def test_ranges_follow_each_other_and_are_kept(spark):
    ledger = KeyLedger(spark, new_path(spark, "keys"))
    assert [ledger.reserve("leave", b, n) for b, n in (("a", 5), ("b", 0), ("c", 2), ("a", 5), ("d", 1))] == [3000, 3005, 3005, 3000, 3007]
    assert ledger.reserve("other", "a", 3, start=1) == 1
    with pytest.raises(ValueError, match="has 5 keys"):
        ledger.reserve("leave", "a", 6)
    with pytest.raises(KeyError):
        ledger.reserve("undeclared", "a", 1)


def test_writers_at_once_get_ranges_of_their_own(spark):
    base, got = new_path(spark, "keys"), {}
    threads = [threading.Thread(target=lambda i=i: got.update({i: KeyLedger(spark, base).reserve("leave", i, 10)})) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got.values()) == [3000, 3010, 3020, 3030]


def test_audit_ids_of_two_batches_and_a_repeated_one(spark):
    ledger = KeyLedger(spark, new_path(spark, "keys"))

    def batch(name, rows):
        rows = rows.selectExpr("id AS payroll_id", "id AS emp_id")
        return audit_rows(rows, "payroll_audit", ["payroll_id"], first=ledger.reserve("payroll_audit", name, rows.count()))

    first, second, again = batch("a", spark.range(4)), batch("b", spark.range(10, 13)), batch("a", spark.range(4))
    assert values(first, "audit_id") == values(again, "audit_id") == [1, 2, 3, 4] and values(second, "audit_id") == [5, 6, 7]


def snapshot(spark, rows=200, buckets=32):
    df = spark.range(rows).selectExpr("id AS k", "id * 2 AS x", "'t' AS name")
    return BucketedSnapshot.create(df, new_path(spark, "snapshot"), "k", buckets)


def update(rows, batch):
    return apply_updates(rows, batch, "k", ["x"])


def test_a_batch_rewrites_the_buckets_of_its_keys(spark):
    stored = snapshot(spark)
    batch = spark.range(10).selectExpr("id * 7 AS k", "-1L AS x")
    before = stored.manifest()
    touched = stored.change(batch, update)
    after = stored.manifest()
    assert 1 <= len(touched) <= 10 and after["rewritten"] == [str(b) for b in touched]
    same = {b for b in before["buckets"] if before["buckets"][b] == after["buckets"][b]}
    assert len(same) == 32 - len(touched)
    want = {k: -1 if k % 7 == 0 and k < 70 else 2 * k for k in range(200)}
    assert {r["k"]: r["x"] for r in stored.read().collect()} == want
    assert {r["k"]: r["x"] for r in stored.read(version=0).collect()} == {k: 2 * k for k in range(200)}
    assert stored.read().columns == ["k", "x", "name"] and stored.version == 1


def test_keys_come_and_go(spark):
    stored = snapshot(spark, rows=1, buckets=4)
    new = spark.createDataFrame([(5, 50, "n"), (6, 60, "n"), (None, 7, "n")], "k bigint, x bigint, name string")
    stored.change(new, lambda rows, batch: rows.unionByName(batch))
    assert values(stored.read(), "k") == [0, 5, 6]
    stored.change(new.select("k"), lambda rows, batch: rows.join(batch, "k", "left_anti"))
    assert values(stored.read(), "k") == [0]
    assert stored.change(new.limit(0), update) == [] and stored.version == 2
    stored.change(spark.range(1).selectExpr("id AS k"), lambda rows, batch: rows.limit(0))
    assert stored.read().count() == 0


def test_a_failed_batch_leaves_the_snapshot(spark):
    stored = snapshot(spark, rows=20, buckets=4)
    with pytest.raises(Exception, match="lost"):
        stored.change(spark.range(3).selectExpr("id AS k", "0L AS x"), lambda rows, batch: failing(rows))
    assert stored.version == 0 and values(stored.read(), "k") == list(range(20))


def test_batches_at_once(spark):
    """A batch builds on one that was quicker elsewhere; in the same bucket it is refused."""
    stored = snapshot(spark, rows=40, buckets=8)
    bucket = {r["k"]: r["b"] for r in stored.read().select("k", stored.bucket_of("k", 8).alias("b")).collect()}
    mine, near = 0, next(k for k in range(1, 40) if bucket[k] == bucket[0])
    far = next(k for k in range(40) if bucket[k] != bucket[0])

    def row(k, x):
        return spark.createDataFrame([(k, x)], "k bigint, x bigint")

    def slow(other):
        def apply(rows, batch):
            BucketedSnapshot(spark, stored.base).change(row(other, -2), update)
            return update(rows, batch)

        return apply

    stored.change(row(mine, -1), slow(far))
    found = {r["k"]: r["x"] for r in stored.read().collect()}
    assert found[mine] == -1 and found[far] == -2 and stored.version == 2
    with pytest.raises(ConcurrentChange):
        stored.change(row(mine, -3), slow(near))
    found = {r["k"]: r["x"] for r in stored.read().collect()}
    assert found[mine] == -1 and found[near] == -2


def test_old_copies_are_forgotten(spark):
    stored = snapshot(spark, rows=50, buckets=2)
    for x in (1, 2, 3):
        stored.change(spark.range(50).selectExpr("id AS k", f"{x}L AS x"), update)
    assert stored.forget(keep=2) == 2 and stored.forget(keep=2) == 0
    assert set(values(stored.read())) == {3} and set(values(stored.read(version=2))) == {2}
    with pytest.raises(ValueError, match="already"):
        BucketedSnapshot.create(stored.read(), stored.base, "k", 2)
