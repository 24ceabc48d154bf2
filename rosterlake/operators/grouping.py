"""Shares of totals, margin labels, totals of groups and sums by levels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import percent
from ..session import small_side, tasks_for
from .joins import null_safe


def with_total(
    df: DataFrame,
    value: str,
    name: str,
    per: Sequence[str] = (),
) -> DataFrame:
    """Add the total of a column over all rows, or over the rows of each group.

    A partial aggregate and a scalar subquery (or a join to the groups' totals, which are
    broadcast if counted to be few) take the place of a window, which would move all rows of a
    group into one task.
    """
    total = F.sum(value)
    if not per:
        return df.withColumn(name, df.agg(total.alias(name)).scalar())
    return null_safe(df, small_side(df.groupBy(*per).agg(total.alias(name))), per)


def with_share(
    df: DataFrame,
    value: str,
    name: str,
    per: Sequence[str] = (),
    digits: int = 2,
) -> DataFrame:
    """Add 100 * value / total, rounded; NULL when the total is zero."""
    totalled = with_total(df, value, "_total", per)
    return totalled.withColumn(name, percent(value, "_total", digits)).drop("_total")


def margin(column: str, label: str) -> Column:
    """Label of a ROLLUP or CUBE margin. A NULL of the data itself is not relabelled."""
    return F.when(F.grouping(column) == 1, F.lit(label)).otherwise(F.col(column))


def rollup_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sums of a column by ROLLUP of ``keys``, with the grouping id as ``level``.

    For keys of which nearly every combination is a group of its own. The rows are dealt by all
    keys to tasks of bounded size; each level is then summed from the one below, and the lowest
    one is not grouped again.
    """
    every = list(keys)
    sums = df.repartition(tasks_for(df), *every).groupBy(*every).agg(F.sum(value).alias(value))
    kind = sums.agg(F.sum(value)).schema[0].dataType
    levels = [sums.select(*every, F.lit(0).cast("bigint").alias("level"), F.col(value).cast(kind))]
    for i in reversed(range(len(every))):
        level = F.lit((1 << (len(every) - i)) - 1).cast("bigint").alias("level")
        # grouped by the level too: the total of an empty table has no row, as with ROLLUP
        sums = sums.groupBy(*every[:i], level).agg(F.sum(value).cast(kind).alias(value))
        levels.append(sums)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels)
