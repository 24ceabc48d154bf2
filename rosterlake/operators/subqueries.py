"""Comparisons with a subquery, as scalar subqueries over one-row aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _set_facts(values: DataFrame, column: str) -> Column:
    """Row count, NULL count, smallest and largest value of a subquery column."""
    c = F.col(column)
    facts = F.struct(
        F.count("*").alias("n"),
        F.count_if(c.isNull()).alias("nulls"),
        F.min(c).alias("low"),
        F.max(c).alias("high"),
    )
    return values.agg(facts.alias("facts")).scalar()


def greater_than_all(df: DataFrame, column: str, values: DataFrame, values_column: str) -> DataFrame:
    """Rows with ``column > ALL (values)``: every row when the set is empty, none when it
    holds a NULL, as the comparison then is unknown."""
    facts = _set_facts(values, values_column)
    return df.where(
        (facts["n"] == 0) | ((facts["nulls"] == 0) & (F.col(column) > facts["high"]))
    )


def greater_than_any(df: DataFrame, column: str, values: DataFrame, values_column: str) -> DataFrame:
    """Rows with ``column > ANY (values)``: above the smallest non-NULL value, none for an
    empty set."""
    return df.where(F.col(column) > _set_facts(values, values_column)["low"])


def average_of(df: DataFrame, column: str) -> Column:
    """Average of a column as a scalar subquery, NULL for an empty table."""
    count = F.nullif(F.count(column), F.lit(0))
    return df.agg((F.sum(column) / count).alias("average")).scalar()
