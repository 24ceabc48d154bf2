from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import toxicity
from rosterlake.llm.tables import in_fold, read_table
from rosterlake.llm.toxicity import best_cut, score_toxicity, sequences, sums, tag, train
from rosterlake.llm.words import IS_TERM, words_in


def words_of(*texts):
    raw = [t.encode() for t in texts]
    return words_in(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), table=IS_TERM)


def test_sequences_end_with_sentences_and_texts():
    begin, length = sequences(words_of("a b. c", "d e f\ng", "", "x " * 130))
    assert length.tolist() == [2, 1, 3, 1, 64, 64, 2] and begin.tolist() == [0, 2, 3, 6, 7, 71, 135]


def test_marginals_are_those_of_all_paths():
    random = np.random.default_rng(3)
    length = np.array([1, 4, 2, 6])
    begin = np.cumsum(length) - length
    emission, pair = random.normal(size=13), random.normal(size=(2, 2))
    inside, pairs = sums(emission, begin, length, pair)
    expected, expected_pairs = np.zeros(13), np.zeros((2, 2))
    for b, n in zip(begin, length, strict=True):
        weights, paths = [], list(product((0, 1), repeat=int(n)))
        for path in paths:
            total = sum(emission[b + t] for t in range(n) if path[t]) + sum(pair[path[t - 1], path[t]] for t in range(1, n))
            weights.append(np.exp(total))
        for path, weight in zip(paths, np.array(weights) / sum(weights), strict=True):
            for t in range(n):
                expected[b + t] += weight * path[t]
                if t:
                    expected_pairs[path[t - 1], path[t]] += weight
    assert np.allclose(inside, expected) and np.allclose(pairs, expected_pairs)


def test_cut_between_labels():
    assert best_cut(np.array([0.0, 1.0, 5.0, 6.0]), np.array([0, 0, 1, 1])) == 3.0
    assert best_cut(np.array([2.0]), np.array([1])) == 0.0


def test_held_out_labels_and_spans(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    held_out = in_fold(F.col("doc_id"), 5, 0)
    found = score_toxicity(docs, labels, ~held_out).join(labels, "doc_id")
    rows = found.filter(held_out).collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.96
    toxic, clean = ([r.score for r in rows if r.toxic == side] for side in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.9
    spans = [r.text[s.start : s.end] for r in found.collect() for s in r.toxic_spans]
    assert spans and all(s[:1].isalnum() and s[-1:].isalnum() for s in spans)
    assert all(bool(r.toxic_spans) == (r.predicted == 1) for r in rows)


def trained():
    """A field that takes the word ``bad`` for toxic."""
    texts = ["bad", "good", "fine words here", "so bad it is"]
    rows = []
    for text in texts * 20:
        words = words_of(text)
        rows.append((toxicity.buckets(toxicity.features(words)), np.array([w == "bad" for w in text.split()], np.int8)))
    return train(rows)


def test_long_texts_are_scored_in_parts(monkeypatch):
    field = trained()
    texts = pa.array(["fine été. " * 40 + "bad", None, "", "good. " * 100, "bad été bad. " * 30])
    whole, spans = tag(field, texts)
    monkeypatch.setattr(toxicity, "RUN_BYTES", 64)
    parts, cut = tag(field, texts)
    assert np.allclose(whole, parts) and np.array_equal(np.concatenate(spans)[:, :3], np.concatenate(cut)[:, :3])
    assert whole[0] > 0.5 and whole[1] == whole[2] == 0 and whole[3] < 0.5 and whole[4] > 0.5
    row, start, end, _ = np.concatenate(spans)[0]
    assert (row, texts[0].as_py()[int(start) : int(end)]) == (0, "bad")


def test_odd_documents(spark, odd_docs):
    labels = [(1, 1, 1), (1, 0, 0), (6, 0, 0), (None, 1, 1), (7, None, None), (8, 5, 5), (3, 1, 1), (999, 1, 0), (2, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    odd = odd_docs.withColumn("toxic_spans", F.lit(1)).withColumn("_tagged", F.lit("x"))
    found = score_toxicity(odd, labels)
    rows = found.collect()
    assert len(rows) == odd.count() and found.columns.count("score") == 1 and "_tagged" in found.columns
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert {r.score for r in rows if not (r.text or "").strip()} == {0.0}
    assert all(r.score < 1e-6 for r in score_toxicity(odd, labels, F.lit(False)).collect())
    assert score_toxicity(odd.limit(0), labels).count() == 0


@pytest.mark.parametrize("side", (0, 1))
def test_labels_of_one_kind(spark, odd_docs, side):
    labels = spark.createDataFrame([(1, side), (6, side)], "doc_id bigint, toxic int")
    assert {r.predicted for r in score_toxicity(odd_docs, labels).collect()} == {0}
