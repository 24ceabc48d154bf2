import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rosterlake.llm import quality
from rosterlake.llm.quality import BUCKETS, REPEATED, Model, features, score_quality, train
from rosterlake.llm.tables import in_fold, read_table


def test_features_belong_to_their_document():
    both, owner = features(pa.array(["ab cd ab cd", None, "ab cd ab cd", "A"]))
    bags = [sorted(both[owner == d].tolist()) for d in range(4)]
    assert bags[0] == bags[2] and bags[1] == [] and len(bags[3]) == 1
    assert bags[0].count(REPEATED) >= 1 and both.max() < BUCKETS and both.min() >= 0
    # 4 words, 3 pairs, 9 + 8 runs of three and four bytes, and one pair that is repeated
    assert len(bags[0]) == 4 + 3 + 9 + 8 + 1


def test_scores_are_means_over_all_features(monkeypatch):
    """Against the plain mean of the features' weights, with runs of any size."""
    random = np.random.default_rng(1)
    names = ["ab", "cd", "été", "x" * 30, "a,b", "c"]
    texts = [" ".join(random.choice(names, n)) + " \n" * (n % 3) for n in (0, 1, 2, 5, 40, 3000, 7, 900)] + [None, "", " ", "z" * 3000]
    model = Model(random.normal(size=BUCKETS).astype(np.float32), 0.25)
    bucket, owner = features(pa.array(texts))
    sums, counts = np.bincount(owner, model.weight[bucket], len(texts)), np.bincount(owner, minlength=len(texts))
    expected = 1 / (1 + np.exp(-(sums / np.maximum(counts, 1) + 0.25)))
    for size in (64, 1000, 1 << 20):
        monkeypatch.setattr(quality, "RUN_BYTES", size)
        assert np.allclose(model.score(pa.array(texts)), expected, atol=1e-6), size


def test_memory_does_not_follow_the_text():
    """Eight times the text takes about as much memory."""
    model, peaks = Model(np.zeros(BUCKETS, np.float32), 0.0), []
    for size in (1 << 20, 8 << 20):
        words = np.random.default_rng(1).integers(97, 123, size, dtype=np.uint8)
        words[::6] = 32
        text = pa.array([words.tobytes().decode()])
        tracemalloc.start()
        model.score(text)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0] and peaks[1] < 60 << 20


def test_training_without_both_labels():
    assert train([]).score(pa.array(["a"])).tolist() == [0.5]
    one = (np.array([3]), np.array([1.0]), 1)
    assert train([one]).score(pa.array(["a", None]))[0] > 0.99


def test_held_out_accuracy(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    held_out = in_fold(F.col("doc_id"), 3, 1)
    found = score_quality(docs, labels, ~held_out).join(labels, "doc_id").filter(held_out)
    rows = found.select("quality", "score", "predicted").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    ranked = np.mean([a > b for a in good for b in bad])
    assert ranked > 0.97 and np.mean([r.predicted == r.quality for r in rows]) > 0.93


def test_odd_documents(spark, odd_docs):
    labels = [(1, 1, 0), (1, 0, 0), (6, 0, 0), (6, 0, 1), (None, 1, 0), (7, None, 0), (8, 5, 0), (3, 1, 0), (999, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = score_quality(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    assert {r.score for r in score_quality(odd_docs, labels, F.lit(False)).collect()} == {0.5}
    assert score_quality(odd_docs.limit(0), labels).count() == 0
