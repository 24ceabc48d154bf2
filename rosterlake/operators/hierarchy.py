"""Walks along parent links to a fixed depth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

PATHS = "decimal(38,0)"


def approval_levels(seeds: DataFrame, links: DataFrame, depth: int = 5) -> DataFrame:
    """(node, lvl, paths): nodes reached from the seeds, with the number of ways per level.

    ``seeds`` has a ``node`` column, ``links`` has ``child`` and ``parent``, one row per link.
    A walk that repeats a node once per path grows with the product of the link counts. Here
    parallel links and equal nodes of a level are merged and carry their multiplicity, so a
    level never has more rows than there are nodes, and nothing is lost. The merged links and
    each level that another one starts from are written once, while the plan is built.
    """
    edges = (
        links.dropna(subset=["child", "parent"])
        .groupBy("child", "parent")
        .agg(F.count("*").cast("decimal(18,0)").alias("_links"))
    )
    edges = materialize(edges, "links")
    level = seeds.groupBy("node").agg(F.count("*").cast(PATHS).alias("paths"))
    levels = [level.withColumn("lvl", F.lit(1))]
    for lvl in range(2, depth + 1):
        ways = (F.col("paths") * F.col("_links")).cast(PATHS)
        level = materialize(level, "level")
        levels[-1] = level.withColumn("lvl", F.lit(lvl - 1))
        level = (
            level.join(edges, F.col("node") == F.col("child"))
            .groupBy(F.col("parent").alias("node"))
            .agg(F.sum(ways).cast(PATHS).alias("paths"))
        )
        levels.append(level.withColumn("lvl", F.lit(lvl)))
    return reduce(DataFrame.unionByName, levels).select("node", "lvl", "paths")
