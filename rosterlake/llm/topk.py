"""Exact top-k inner products with block bounds.

Vectors are integers. Rows of near ids form blocks; a block has a forward index (its vectors)
and, per component, the largest and smallest value. A query's bound for a block is the sum over
components of the most that the component can add. Per query, blocks are visited from the
highest bound down and scored through the forward index until the bound falls below the k-th
score found. Pruned blocks can not change the result.

Queries are sent to all tasks in groups of bounded size. A task carries each query's best rows
from one chunk of blocks to the next; the tasks' best rows are merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.session import materialize

BLOCK = 64  # vectors
CHUNK = 8192  # vectors that are searched together
GROUP = 4096  # queries that are sent to all tasks at once
_EXACT = float(1 << 53)


def integer_vectors(df: DataFrame, is_query: Column, key: str, vector: str, scale: int) -> DataFrame:
    """id, v = floor(scale * component), q; rows with a NULL key or unusable vector go."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    usable = F.col(key).isNotNull() & F.col(vector).isNotNull()
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(usable & finite).select(
        F.col(key).cast("long").alias("id"),
        F.transform(parts, lambda x: F.floor(x * scale)).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
    )


def as_matrix(vectors: pa.Array) -> np.ndarray:
    """One row per vector; short ones are filled with zeros."""
    first = vectors.offsets.to_numpy().astype(np.int64)
    values = vectors.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(first)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    inside = np.arange(out.shape[1]) < lengths[:, None]
    out[inside] = values[first[0] : first[-1]]
    return out


def widen(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1]))) if matrix.shape[1] < width else matrix


class Best:
    """The best rows found so far for each query of a group."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.ids, self.queries, self.k = ids, queries, k
        self.scores = [np.zeros(0, np.int64) for _ in ids]
        self.found = [np.zeros(0, np.int64) for _ in ids]

    def search(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        """Go through a chunk's blocks, for each query from the highest bound down."""
        width = max(matrix.shape[1], self.queries.shape[1])
        order = np.argsort(ids, kind="stable")
        ids, matrix, queries = ids[order], widen(matrix[order], width), widen(self.queries, width)
        peak = float(np.abs(matrix).max(initial=0)) * float(np.abs(queries).max(initial=0))
        # doubles are exact while no sum can leave 53 bits; else 64-bit integers are used
        kind = np.float64 if peak * max(width, 1) < _EXACT else np.int64
        matrix, queries = matrix.astype(kind), queries.astype(kind)
        begin = np.arange(0, len(ids), BLOCK)
        most, least = np.maximum.reduceat(matrix, begin), np.minimum.reduceat(matrix, begin)
        bounds = np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T
        visit = np.argsort(-bounds, axis=1, kind="stable")
        for q, query in enumerate(queries):
            scores, found = self.scores[q], self.found[q]
            for b in visit[q]:
                if len(scores) == self.k and bounds[q, b] < scores[-1]:
                    break
                rows = slice(begin[b], begin[b] + BLOCK)
                own = ids[rows] != self.ids[q]
                scores = np.concatenate([scores, (matrix[rows] @ query)[own].astype(np.int64)])
                found = np.concatenate([found, ids[rows][own]])
                best = np.lexsort((found, -scores))[: self.k]
                scores, found = scores[best], found[best]
            self.scores[q], self.found[q] = scores, found

    def rows(self) -> pa.RecordBatch:
        counts = [len(x) for x in self.found]
        columns = [np.repeat(self.ids, counts), np.concatenate(self.found), np.concatenate(self.scores)]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["query_id", "vec_id", "score"])


def top_k(
    df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: int = 1024
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query, exactly.

    Queries are the rows for which ``is_query`` holds, candidates all rows with another key; ties
    go to the smaller key. Vectors that are NULL or hold NULL or non-finite components, and rows
    without a key, take no part; a shorter vector is filled with zeros. Rows that repeat a key
    are separate candidates and one query, that with the smallest vector. Scores must fit 64 bits. An empty table or one
    without queries gives no rows; other columns are ignored. The integer vectors are written
    once, and the queries read in groups of about ``GROUP``, while the plan is built.
    """
    spark = df.sparkSession
    base = materialize(integer_vectors(df, is_query, key, vector, scale), "vectors")
    queries = base.filter("q").groupBy("id").agg(F.min("v").alias("v"))
    groups = -(-queries.count() // GROUP)
    schema = "query_id bigint, vec_id bigint, score bigint"

    def search(group) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(*group.value, k)
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(at, CHUNK)
                    best.search(part.column(0).to_numpy(), as_matrix(part.column(1)))
            yield best.rows()

        return base.select("id", "v").mapInArrow(run, schema)

    found = [spark.createDataFrame([], schema)]
    for g in range(groups):
        rows = queries.filter(F.pmod(F.xxhash64("id"), F.lit(groups)) == g).orderBy("id").collect()
        if rows:
            ids = np.array([r["id"] for r in rows], np.int64)
            vectors = as_matrix(pa.array([r["v"] for r in rows], pa.list_(pa.int64())))
            part = search(spark.sparkContext.broadcast((ids, vectors)))
            found.append(part if groups == 1 else materialize(part, "found"))
    merged = found[0] if len(found) == 1 else found[1]
    for part in found[2:]:
        merged = merged.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
