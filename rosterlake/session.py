"""Session helpers: building a local session, shared scratch space, counted sides and tasks."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest number of counted rows of a join side that is sent to all executors.
BROADCAST_ROWS = 1 << 16
# Rows that a task gets on average where tables are dealt to a counted number of tasks.
TASK_ROWS = 1 << 18

_scratch_by_app: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(app: str = "rosterlake", cores: str | int = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the one spark-submit gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    local_scratch(spark)
    return spark


def local_scratch(spark: SparkSession) -> None:
    """Give a local session without ``spark.checkpoint.dir`` a folder until the process ends.

    For tests, benchmarks and trials: there the driver and the executors are one process, so a
    temporary folder is shared by definition. Sessions on a cluster are left as they are.
    """
    context = spark.sparkContext
    if context.master.split("[")[0] == "local" and spark.conf.get("spark.checkpoint.dir", None) is None:
        _scratch_by_app.setdefault(context.applicationId, tempfile.TemporaryDirectory(prefix="rosterlake-"))


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, below the shared folder of spark.checkpoint.dir."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and context.applicationId in _scratch_by_app:
        shared = _scratch_by_app[context.applicationId].name
    if shared is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{shared.rstrip('/')}/rosterlake/{context.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that nothing has been written to yet."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in shared storage and read it back.

    Fixes values that depend on the physical layout (partition numbers), cuts the lineage,
    and survives the loss of executors. Readers prune columns as in any other table.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame) -> DataFrame:
    """A join side, written once, counted, and marked for broadcast if it has few rows.

    For sides of keys with a few figures. A larger side is returned unmarked, for a shuffled
    join. Where the side is small, the other one is not shuffled by a key that few values make
    up. Writing and counting run while the plan is built.
    """
    stored = materialize(df, "side")
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def tasks_for(*frames: DataFrame) -> int:
    """How many tasks of about ``TASK_ROWS`` rows the rows of all frames make up.

    For ``repartition`` with a number, which adaptive execution leaves as it is. Partitions
    without one are merged until there is one per core or 64 MB of compressed rows in each, so
    the sorts and hash maps of a task grow with the table. Counting runs while the plan is built;
    Parquet answers from metadata.
    """
    return max(1, math.ceil(sum(df.count() for df in frames) / TASK_ROWS))
