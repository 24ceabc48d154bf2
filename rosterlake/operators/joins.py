"""Joins that stay balanced when one key holds a large part of the rows.

Spark splits a skewed partition of an inner join on either side, but of an outer, semi or
anti join only on the preserved side. The forms below put the large side where it can be
split, or reduce it to its distinct keys first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL keys; map-side combine removes a hot key before the shuffle."""
    return df.select(*columns).dropna(subset=list(columns)).distinct()


def null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same name in which NULL matches NULL."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    condition: Column = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{c}" for c in on])


def matching(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right`` (IN / EXISTS)."""
    keys = _keys(right, [right_key or key]).toDF(key)
    return left.join(keys, key, "left_semi")


def without(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right`` (NOT EXISTS); NULL keys stay."""
    keys = _keys(right, [right_key or key]).toDF(key)
    return left.join(keys, key, "left_anti")


def flag_existing(
    left: DataFrame, right: DataFrame, key: str, flag: str, right_key: str | None = None
) -> DataFrame:
    """Add a boolean: does the key of the row occur in ``right``?"""
    keys = _keys(right, [right_key or key]).toDF(key).withColumn("_hit", F.lit(True))
    return left.join(keys, key, "left").withColumn(flag, F.col("_hit").isNotNull()).drop("_hit")


def outer_to_many(one: DataFrame, many: DataFrame, one_key: str, many_key: str) -> DataFrame:
    """Left outer join of a table with unique keys to its many rows.

    ``one LEFT JOIN many`` cannot split a key that holds most of ``many``. The matched part
    as an inner join can, and can broadcast ``one``; rows without a match are added after.
    ``many`` keeps its key column under its own name, which must differ from those of ``one``.
    """
    matched = one.join(many, F.col(one_key) == F.col(many_key), "inner")
    unmatched = without(one, many, one_key, many_key)
    return matched.unionByName(unmatched, allowMissingColumns=True)


def full_outer_to_many(one: DataFrame, many: DataFrame, one_key: str, many_key: str) -> DataFrame:
    """Full outer join of unique keys and their many rows, splittable like `outer_to_many`."""
    many_side = many.join(one, F.col(one_key) == F.col(many_key), "left")
    unmatched = without(one, many, one_key, many_key)
    return many_side.unionByName(unmatched, allowMissingColumns=True)
