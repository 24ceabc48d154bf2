"""Registered queries and their SQL, collected from the check modules."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.session import local_scratch
from rosterlake.sources.adapter import star_tables
from rosterlake.sources.loading import Tables


class Check(NamedTuple):
    query: Callable[[Tables], DataFrame]
    sql: str | None


def plain(df: DataFrame) -> DataFrame:
    """Result types that both engines print alike: bigint, double, text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def all_checks() -> dict[str, Check]:
    from . import change_checks, expression_checks, operator_checks, report_checks, staff_checks

    found: dict[str, Check] = {}
    for module in (staff_checks, report_checks, expression_checks, operator_checks, change_checks):
        for name, check in module.CHECKS.items():
            if name in found:
                raise ValueError(f"registered twice: {name}")
            found[name] = Check(*check)
    return found


def runner(check: Check) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        local_scratch(spark)
        return plain(check.query(star_tables(spark, folder)))

    return run
