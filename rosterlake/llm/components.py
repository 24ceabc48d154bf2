"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.session import materialize


def _step(edges: DataFrame, small: bool) -> DataFrame:
    """One star step: every node's neighbours are tied to the smallest one it sees.

    In the large step a node ties its larger neighbours, in the small step its smaller ones and
    itself, each to the smallest node among its neighbours and itself.
    """
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m"))
    lowest = lowest.select("a", F.least("a", "m").alias("m"))
    tied = both.join(lowest, "a")
    if small:
        found = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select("a", F.col("m").alias("b")))
    else:
        found = tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    found = found.filter("a <> b")
    return found.distinct() if small else found


def connected_components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of the links (a, b).

    Large and small star steps alternate until nothing changes, which needs about as many rounds
    as the logarithm of the longest path. Each round is written to shared storage, so a lost
    executor costs no more than the round. NULL ends and loops are left out; without links the
    result is empty.
    """
    edges = links.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialize(edges.distinct(), "links")
    state = None
    while True:
        edges = materialize(_step(_step(edges, False), True), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = now
