"""Reading base tables, filling defaults, appending and rewriting snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .schemas import DEFAULTS, TODAY, declared_schema


class Tables:
    """Named tables, each one a DataFrame or a function that opens it on first use."""

    def __init__(self, **frames: DataFrame | Callable[[], DataFrame]):
        self._frames = dict(frames)
        self.folder: str | None = None

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            frame = self._frames[name]
        except KeyError:
            raise AttributeError(f"no table named {name}") from None
        if not isinstance(frame, DataFrame):
            frame = self._frames[name] = frame()
        return frame

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def replacing(self, **frames: DataFrame | Callable[[], DataFrame]) -> "Tables":
        return Tables(**{**self._frames, **frames})


def load_table(
    spark: SparkSession, folder: str, name: str, schema: StructType | str | None = None
) -> DataFrame:
    """Scan one Parquet table; Catalyst prunes its columns and pushes filters into it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def load_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> Tables:
    return Tables(**{n: (lambda n=n: load_table(spark, folder, n)) for n in names})


def with_defaults(
    df: DataFrame, defaults: Mapping[str, object], as_of: dt.date | None = None
) -> DataFrame:
    """Add omitted columns with their default. A column that is present keeps its NULLs."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    missing = {
        name: today if value is TODAY else F.lit(value)
        for name, value in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the declared types in declared order; undeclared columns go, omitted ones are NULL."""
    columns: list[Column] = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*columns)


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Target followed by new rows, matched by column name; omitted columns become NULL."""
    typed = rows.select(
        *[F.col(f.name).cast(f.dataType) for f in target.schema.fields if f.name in rows.columns]
    )
    return target.unionByName(typed, allowMissingColumns=True)


def rows_of(spark: SparkSession, table: str, rows: list[tuple], columns: list[str]) -> DataFrame:
    """Literal rows of a declared table with its defaults filled in (for fixtures)."""
    schema = declared_schema(table)
    given = StructType([schema[c] for c in columns])
    return with_defaults(spark.createDataFrame(rows, given), DEFAULTS.get(table, {}))


def insert_select(target: DataFrame, table: str, query: DataFrame) -> DataFrame:
    """Target plus the rows of a query, after the declared defaults of the table."""
    return append_rows(target, with_defaults(query, DEFAULTS.get(table, {})))


def create_table_as(df: DataFrame, path: str, empty: bool = False) -> DataFrame:
    """Write a query as a new table; ``empty`` keeps only its schema."""
    (df.where(F.lit(False)) if empty else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_count_inventory(tables: Mapping[str, DataFrame], label: str = "tbl") -> DataFrame:
    """One row per table: its name and row count. Parquet answers from metadata."""
    counts = [
        df.agg(F.count("*").alias("total")).select(F.lit(name).alias(label), "total")
        for name, df in tables.items()
    ]
    stacked = counts[0]
    for part in counts[1:]:
        stacked = stacked.unionByName(part)
    return stacked
