"""Small helpers that the operators share: input columns, folds, row numbers."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.session import local_scratch, new_path

T = TypeVar("T")


_kept: dict[object, object] = {}


def kept(token: object, make: Callable[[], T]) -> T:
    """What a worker process keeps for its next tasks: one thing at a time, so that a later
    stage does not find the tables of an earlier one beside its own."""
    if token not in _kept:
        _kept.clear()
        _kept[token] = make()
    return _kept[token]


def giving_back(run: Callable) -> Callable:
    """A task's function that returns freed memory to the system at its end.

    Workers serve one stage after the other. Allocators keep what a stage has freed, which would
    stay beside what the next one needs.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key's text modulo ``folds``; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def in_fold(key: Column, folds: int, which: int) -> Column:
    """Whether a row is in the fold; a row without a key is in none."""
    return F.coalesce(fold(key, folds) == which, F.lit(False))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once as compressed Parquet in shared storage."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with more underscores if a column has it already."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Let Python workers of this machine import this package from where the driver has it, and
    give a local session a folder for intermediate tables.

    On a cluster whose workers do not see that folder, give the package with ``--py-files``.
    """
    local_scratch(spark)
    environment, folder = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if folder not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([folder, *filter(None, paths)])
