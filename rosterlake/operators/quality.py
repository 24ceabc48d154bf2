"""Normalization and constraint jobs: each returns rows that pass, fail, or a new table."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..session import materialize, small_side
from ..sources.schemas import FOREIGN_KEYS, ForeignKey
from .joins import flag_existing, matching, null_safe, without

c = F.col

def checks_of(table: str) -> dict[str, Column]:
    """CHECK rules of a declared table."""
    # The CHECK rules of the declared tables.
    if table == "salary_bonus":
        return {"salary_positive": c("amount") > 0, "bonus_non_negative": c("bonus_amount") >= 0}
    if table == "employee":
        return {
            "gender": c("gender").isin("M", "F"),
            "age": (c("age") >= 18) & (c("age") <= 75),
        }
    if table == "leave":
        return {
            "leave_status": c("status").isin("PENDING", "APPROVED", "REJECTED"),
            "leave_dates": (c("leave_end") >= c("leave_start")) | c("leave_end").isNull(),
        }
    if table == "payroll":
        return {
            "payroll_gross": c("gross_amount") > 0,
            "payroll_deductions": c("deductions") >= 0,
            "payroll_status": c("payment_status").isin("PENDING", "PROCESSED", "PAID"),
        }
    return {}


# --- normal forms -----------------------------------------------------------------------


def explode_multivalue(df: DataFrame, key: str, column: str, sep: str = ",") -> DataFrame:
    """First normal form: one row per value of a separated list, with its place from 1."""
    values = F.split(F.col(column), re.escape(sep), -1)
    return df.select(key, F.posexplode(values).alias("_at", column)).select(
        key, (F.col("_at") + 1).alias("place"), F.trim(F.col(column)).alias(column)
    )


def extract_dimension(
    df: DataFrame, determinant: str, dependents: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Second and third normal form: (dimension of distinct dependents, remaining fact)."""
    dimension = df.select(determinant, *dependents).dropna(subset=[determinant]).distinct()
    return dimension, df.drop(*dependents)


def _broken(dependent: str) -> Column:
    """Does a group have more than one value of a column? NULL counts as a value.

    Smallest, largest and whether there is a NULL: figures that tasks combine before the shuffle.
    """
    value = F.col(dependent)
    mixed = F.bool_or(value.isNull()) & F.bool_or(value.isNotNull())
    return F.coalesce(F.min(value) != F.max(value), F.lit(False)) | mixed


def fd_violations(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    """Determinant values with more than one dependent value; NULL counts as a value.

    The determinants that break the dependency are found first, from figures of fixed size per
    determinant; only their rows are then brought together by value.
    """
    keys = list(determinant)
    broken = df.groupBy(*keys).agg(_broken(dependent).alias("_broken")).where("_broken").select(*keys)
    values = null_safe(df.select(*keys, dependent), small_side(broken), keys, "left_semi").distinct()
    return values.groupBy(*keys).agg(F.count("*").alias("distinct_values"))


def dependency_report(df: DataFrame, dependencies: Mapping[Sequence[str], Sequence[str]]) -> DataFrame:
    """(determinant, dependent, violations) for several dependencies.

    ``dependencies`` maps determinant columns to the columns that should follow from them; the
    table is read once for each determinant, whatever the number of its dependents.
    """
    parts = []
    for determinant, dependents in dependencies.items():
        groups = df.groupBy(*determinant).agg(*[_broken(d).alias(f"_broken_{i}") for i, d in enumerate(dependents)])
        found = [
            F.struct(F.lit(",".join(determinant)).alias("determinant"), F.lit(d).alias("dependent"), F.count_if(f"_broken_{i}").alias("violations"))
            for i, d in enumerate(dependents)
        ]
        parts.append(groups.agg(F.array(*found).alias("found")).select(F.inline("found")))
    return reduce(DataFrame.unionByName, parts)


# --- row rules --------------------------------------------------------------------------


def with_failed_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the names of the failed rules. A rule fails on FALSE only: unknown passes."""
    failed = [F.when(~rule, F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*failed)))


def check_rows(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``failed_rules``)."""
    checked = with_failed_rules(df, rules)
    passed = F.size("failed_rules") == 0
    return checked.where(passed).drop("failed_rules"), checked.where(~passed)


def not_null_violations(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows with a NULL in a required column, with the names of those columns."""
    return check_rows(df, {name: F.col(name).isNotNull() for name in columns})[1]


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; keys with a NULL are exempt.

    Nearly all keys occur once, so only their 64-bit hashes are counted first; the keys of
    hashes met again are then counted themselves, which makes the result exact.
    """
    names = list(columns)
    keyed = df.select(*names).dropna().withColumn("_hash", F.xxhash64(*names))
    again = keyed.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash")
    return (
        keyed.join(small_side(again), "_hash", "left_semi")
        .groupBy(*names)
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def orphan_rows(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    return without(child.where(F.col(fk).isNotNull()), parent, fk, pk)


def _links_by_type(tables, keys: Iterable[ForeignKey]) -> dict[DataType, list[ForeignKey]]:
    """Foreign keys by the type in which child and parent are compared."""
    found: dict[DataType, list[ForeignKey]] = {}
    for link in keys:
        both = tables[link.child].select(link.column).union(tables[link.parent].select(link.key))
        found.setdefault(both.schema[0].dataType, []).append(link)
    return found


def _places(entries: Sequence[tuple[int, str, int | None]], kind: DataType) -> Column:
    """(domain, key, slot) of a row for each of its columns that hold (no slot) or use a key."""
    return F.array(
        *[
            F.struct(
                F.lit(domain).alias("domain"),
                F.col(column).cast(kind).alias("key"),
                F.lit(slot).cast("int").alias("slot"),
            )
            for domain, column, slot in entries
        ]
    )


def orphan_counts(tables, keys: Iterable[ForeignKey]) -> DataFrame:
    """Orphans per foreign key.

    Keys of parents and children are brought together in one aggregate, which is combined before
    the shuffle: a hot key is one row per task, and no parent is held whole in memory, as a
    broadcast would be. The links of a parent key share its rows and are counted side by side.
    Each table is read once as a child and once as a parent.
    """
    results = []
    for kind, links in _links_by_type(tables, keys).items():
        domains = {p: i for i, p in enumerate(dict.fromkeys((k.parent, k.key) for k in links))}
        read: dict[tuple[str, bool], list[tuple[int, str, int | None]]] = {}
        for (parent, column), domain in domains.items():
            read.setdefault((parent, True), []).append((domain, column, None))
        slots = dict.fromkeys(domains.values(), 0)
        placed = []
        for link in links:
            domain = domains[link.parent, link.key]
            read.setdefault((link.child, False), []).append((domain, link.column, slots[domain]))
            placed.append((link, domain, slots[domain]))
            slots[domain] += 1
        parts = [tables[table].select(F.inline(_places(own, kind))) for (table, _), own in read.items()]
        uses = [F.count_if(F.col("slot") == s).alias(f"uses_{s}") for s in range(max(slots.values()))]
        met = reduce(DataFrame.unionAll, parts).dropna(subset=["key"]).groupBy("domain", "key")
        orphans = met.agg(F.bool_or(F.col("slot").isNull()).alias("held"), *uses).where("NOT held")
        named = [
            F.struct(
                F.lit(link.child).alias("child"),
                F.lit(link.column).alias("fk"),
                F.coalesce(F.sum(F.when(F.col("domain") == domain, F.col(f"uses_{s}"))), F.lit(0)).alias("orphans"),
            )
            for link, domain, s in placed
        ]
        results.append(orphans.agg(F.array(*named).alias("found")).select(F.inline("found")))
    return reduce(DataFrame.unionByName, results)


# --- deletes along foreign keys -----------------------------------------------------------


def cascade_delete(child: DataFrame, fk: str, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows that remain after the delete of parents."""
    return without(child, deleted, fk, key)


def set_null_on_delete(child: DataFrame, fk: str, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows with the reference to a deleted parent set to NULL."""
    flagged = flag_existing(child, deleted, fk, "_gone", key)
    return flagged.withColumn(fk, F.when(~F.col("_gone"), F.col(fk))).select(*child.columns)


# Primary keys of the declared tables that no other table refers to.
_PRIMARY_KEY = {k.parent: k.key for k in FOREIGN_KEYS} | {
    "qualification": "qual_id",
    "payroll": "payroll_id",
    "book_orders": "order_id",
}


def delete_order(table: str, links: Sequence[ForeignKey]) -> list[list[str]]:
    """Tables that a delete in ``table`` can reach, parents before children.

    Tables that delete in each other in a ring, or in themselves, form one entry together.
    """
    children: dict[str, list[str]] = {}
    for link in links:
        children.setdefault(link.parent, []).append(link.child)

    def reach(start: str) -> set[str]:
        seen, todo = {start}, [start]
        while todo:
            for child in children.get(todo.pop(), []):
                if child not in seen:
                    seen.add(child)
                    todo.append(child)
        return seen

    reached = {t: reach(t) for t in reach(table)}
    rings = {frozenset(u for u in reached if u in reached[t] and t in reached[u]) for t in reached}
    # a ring that reaches another one reaches more tables than it
    return [sorted(ring) for ring in sorted(rings, key=lambda ring: (-len(reached[min(ring)]), min(ring)))]


def _deleted_keys(tables, ring: Sequence[str], links: Sequence[ForeignKey], primary: Mapping[str, str], gone: dict[str, DataFrame]) -> None:
    """Add to ``gone`` the keys that cascading deletes remove in the tables of a ring.

    What earlier tables delete comes first. Within the ring, the keys found last are followed
    until there are none; each round is written, and reads only rows of children of its keys.
    """

    def lost(link: ForeignKey, parents: DataFrame) -> DataFrame:
        key = primary[link.child]
        found = matching(tables[link.child].select(*{key, link.column}), parents, link.column, primary[link.parent])
        return found.select(F.col(key))

    found: dict[str, DataFrame] = {t: gone[t] for t in ring if t in gone}
    for link in links:
        if link.child in ring and link.parent not in ring and link.parent in gone:
            more = lost(link, gone[link.parent])
            found[link.child] = found[link.child].union(more) if link.child in found else more
    inner = [k for k in links if k.child in ring and k.parent in ring]
    if not inner:
        gone |= found
        return
    gone |= {t: materialize(keys.distinct(), "deleted") for t, keys in found.items()}
    last = {t: gone[t] for t in found}
    while last:
        new: dict[str, DataFrame] = {}
        for link in inner:
            if link.parent in last:
                more = lost(link, last[link.parent])
                new[link.child] = new[link.child].union(more) if link.child in new else more
        last = {}
        for child, keys in new.items():
            fresh = keys.distinct() if child not in gone else without(keys.distinct(), gone[child], primary[child])
            fresh = materialize(fresh, "deleted")
            if not fresh.isEmpty():
                last[child] = fresh
                gone[child] = gone[child].union(fresh) if child in gone else fresh


def delete_with_references(
    tables,
    table: str,
    keys: DataFrame,
    foreign_keys: Sequence[ForeignKey] = FOREIGN_KEYS,
    primary_keys: Mapping[str, str] = _PRIMARY_KEY,
) -> dict[str, DataFrame]:
    """New snapshots of ``table`` and all tables that keys tie to it, after deleting keys.

    The order follows from ``foreign_keys``: cascading deletes are passed on from parents to
    children, in rings (a table that refers to itself, say) until no further key is
    found; then references to deleted keys are set to NULL. Children of other keys restrict
    nothing here: see ``orphan_rows``.
    """
    cascading = [k for k in foreign_keys if k.on_delete == "cascade"]
    gone = {table: keys.select(F.col(primary_keys[table]))}
    for ring in delete_order(table, cascading):
        _deleted_keys(tables, ring, cascading, primary_keys, gone)
    tied, before = {table}, set()
    while tied != before:
        before = set(tied)
        tied |= {n for k in foreign_keys if {k.parent, k.child} & before for n in (k.parent, k.child)}
    snapshot = {}
    for name in sorted(tied):
        rows = tables[name]
        if name in gone:
            rows = without(rows, gone[name], primary_keys[name])
        for link in foreign_keys:
            if link.child == name and link.parent in gone and link.on_delete == "set null":
                rows = set_null_on_delete(rows, link.column, gone[link.parent], primary_keys[link.parent])
        snapshot[name] = rows
    return snapshot
