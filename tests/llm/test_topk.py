import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import topk
from rosterlake.llm.tables import read_table

from .conftest import FOLDER


def brute(rows, k, is_query):
    usable = {}
    candidates = []
    for key, vector in rows:
        if key is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints = [math.floor(1024 * float(np.float32(x))) for x in vector]
        candidates.append((key, ints))
        if is_query(key):
            usable[key] = min(usable.get(key, ints), ints)
    out = []
    for key, own in usable.items():
        scores = sorted((-sum(a * b for a, b in zip(own, v)), c) for c, v in candidates if c != key)[:k]
        out += [(key, i + 1, c, -s) for i, (s, c) in enumerate(scores)]
    return sorted(out)


def found(frame, k=10):
    return sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 100 == 0, k).collect())


@pytest.mark.parametrize("scale", [1.0, 2e5])
def test_equals_comparing_all_pairs(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "CHUNK", 40)
    monkeypatch.setattr(topk, "GROUP", 3)
    random = np.random.default_rng(5)
    rows = [(i * 10, [float(x) for x in np.round(random.normal(size=4), 1) * scale]) for i in range(120)]
    rows += [(3, None), (None, [1.0] * 4), (4, [1.0, None, 1.0, 1.0]), (5, [float("nan")] * 4), (100, [float("inf")] * 4)]
    rows += [(200, [0.0] * 4), (200, [0.0] * 4), (70, [9.0] * 4), (6, []), (7, [5.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit("x")).withColumn("v", F.lit(1))
    assert found(frame) == brute(rows, 10, lambda key: key % 100 == 0)


def test_pruning_skips_blocks():
    ids, matrix = np.arange(640), np.repeat(np.arange(10, 0, -1), 64)[:, None] * 100
    best = topk.Best(np.array([-1]), np.array([[1]]), 3)
    best.search(ids, matrix)
    assert best.found[0].tolist() == [0, 1, 2] and best.scores[0].tolist() == [1000] * 3


def test_tables(spark):
    frame = read_table(spark, FOLDER, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    assert found(frame) == brute(rows, 10, lambda key: key % 100 == 0)
    assert found(frame.limit(0)) == [] and found(frame.filter("vec_id % 100 = 1")) == []
    assert found(frame.filter("vec_id < 5"), 10) == brute(rows[:5], 10, lambda key: key == 0)
