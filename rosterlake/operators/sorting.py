"""Sort keys with NULL as the largest value: last when ascending, first when descending."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_keys(names: Iterable[str]) -> list[Column]:
    """Sort columns from names; a leading ``-`` means descending."""
    return [
        F.col(n[1:]).desc_nulls_first() if n.startswith("-") else F.col(n).asc_nulls_last()
        for n in names
    ]


def sort_by(df: DataFrame, *names: str) -> DataFrame:
    """Global sort. End the list with a unique key: range partitioning then can split ties."""
    return df.orderBy(*sort_keys(names))


def top(df: DataFrame, n: int, *names: str) -> DataFrame:
    """First ``n`` rows in the given order; every task keeps only n rows."""
    return sort_by(df, *names).limit(n)
