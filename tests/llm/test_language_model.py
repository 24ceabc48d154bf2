import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterlake.llm import language_model
from rosterlake.llm.elias_fano import STEPS, EliasFano, Trie, dequantise, mapped, quantise
from rosterlake.llm.language_model import score_texts
from rosterlake.llm.tables import in_fold, read_table

from .conftest import FOLDER
from .test_words import plain_words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**45), max_size=400))
def test_elias_fano_gives_its_elements_back(values):
    values = np.array(sorted(values), np.uint64)
    coded = EliasFano.encode(values)
    assert coded.access(np.arange(len(values))).tolist() == values.tolist()


@pytest.mark.parametrize("size,step", [(1, 1), (5000, 1), (20_000, 37), (9000, 10**9)])
def test_successor_search(size, step):
    random = np.random.default_rng(size)
    values = np.cumsum(random.integers(1, step + 1, size)).astype(np.uint64)
    coded = EliasFano.encode(values)
    wanted = np.sort(random.integers(0, int(values[-1]) + 5, 3000).astype(np.uint64))
    at, equal = coded.successor(wanted)
    assert at.tolist() == np.searchsorted(values, wanted).tolist()
    assert equal.tolist() == np.isin(wanted, values).tolist()
    assert len(coded.high) * 8 + len(coded.low) * 8 <= size * (4 + math.log2(int(values[-1]) / size + 2)) + 64


def test_quantised_shares_are_rounded_down():
    shares = np.array([1.0, 0.5, 0.3, 1e-9])
    found = dequantise(quantise(shares))
    assert (found <= shares * (1 + 1e-9)).all() and (found >= shares * 2 ** (-1 / STEPS) * (1 - 1e-6)).all()


def test_levels_are_mapped_and_leave_no_file(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    array = mapped(np.arange(10))
    assert isinstance(array, np.memmap) and array.tolist() == list(range(10))
    assert not list(tmp_path.iterdir())


def test_trie_probabilities_sum_to_one():
    context = np.array([3, 3, 3, 9, 9], np.uint64)
    word, count = np.array([1, 4, 6, 1, 2]), np.array([5, 1, 2, 1, 1])
    total = np.array([8, 8, 8, 2, 2])
    trie = Trie(context, word, count, total, 0.75)
    known, share, left = trie.lookup(np.repeat(np.array([3, 5, 9], np.uint64), 7), np.tile(np.arange(7), 3))
    assert known.reshape(3, 7).all(1).tolist() == [True, False, True]
    sums = share.reshape(3, 7).sum(1) + left.reshape(3, 7)[:, 0]
    assert sums == pytest.approx([1, 1, 1], abs=2e-3) and (sums <= 1 + 1e-9).all()


def brute(rows, trained):
    """Scores by plain counting."""
    tokens = [plain_words(r.text) + [None] for r in rows]
    count = Counter(w for x, t in zip(tokens, trained) if t for w in x)
    total, distinct = sum(count.values()), len(count)
    norm = total + 0.5 * (distinct + 1)
    pairs = Counter()
    for x, t in zip(tokens, trained):
        if t:
            pairs.update(zip([None, *x[:-1]], x))
    kinds = Counter(v for v, _ in pairs)
    out = []
    for x in tokens:
        base = score = 0
        for v, w in zip([None, *x[:-1]], x):
            p = (count[w] + 0.5) / norm
            base += math.log10(p)
            if count[v]:
                p = max(pairs[v, w] - 0.75, 0) / count[v] + 0.75 * kinds[v] / count[v] * p
            score += math.log10(p)
        out.append((len(x), sum(count[w] > 0 for w in x), total, base, score))
    return out


def test_odd_documents(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", 20)
    training = F.coalesce(F.col("doc_id") != 7, F.lit(False))
    found = score_texts(odd_docs, training).collect()
    rows = odd_docs.collect()
    expected = brute(rows, [r.doc_id is not None and r.doc_id != 7 for r in rows])
    order = lambda r: tuple((x is None, x) if x is None or isinstance(x, int) else round(x, 4) for x in r)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=lambda r: str(order(r)))
    want = sorted(((r.doc_id, *e[:4]) for r, e in zip(rows, expected)), key=lambda r: str(order(r)))
    for a, b in zip(got, want, strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)
    assert all(r.score <= 0 for r in found)


def test_scores_of_documents(spark):
    docs = read_table(spark, FOLDER, "documents")
    training = ~in_fold(F.col("doc_id"), 5, 1)
    found = {r.doc_id: r for r in score_texts(docs, training).collect()}
    rows = docs.collect()
    trained = [zlib.crc32(str(r.doc_id).encode()) % 5 != 1 for r in rows]
    held_out = [0.0, 0.0]
    for row, known, (n_tokens, n_known, total, base, score) in zip(rows, trained, brute(rows, trained)):
        own = found[row.doc_id]
        assert (own.n_tokens, own.n_known, own.train_tokens) == (n_tokens, n_known, total)
        assert own.base_score == pytest.approx(base, rel=1e-9)
        # contexts that are split and 16-bit codes move a score a little
        assert own.score == pytest.approx(score, rel=0.03)
        held_out[0] += 0 if known else own.base_score
        held_out[1] += 0 if known else own.score
    assert held_out[1] > held_out[0]


@pytest.mark.parametrize("tasks", [1, 9])
def test_splitting_contexts_changes_no_score(spark, monkeypatch, tasks):
    """A context with a third of the tokens and few followers, dealt over many parts."""
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(language_model, "partitions", lambda spark: tasks)
    texts = [f"hot {'abc'[i % 3]} w{i % 90} w{i % 7} hot a hot" for i in range(300)] + ["hot w5 unseen hot w80", "hot hot"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.score for r in score_texts(docs, F.col("doc_id") < 300).collect()}
    for row, (*_, score) in zip(docs.collect(), brute(docs.collect(), [i < 300 for i in range(len(texts))])):
        assert found[row.doc_id] == pytest.approx(score, rel=1e-3)


def test_blocks_of_many_documents(spark):
    """One Arrow batch, and so one block, of more documents than 16 bits number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "100000")
    try:
        docs = spark.range(0, 70_000, 1, 1).selectExpr("id AS doc_id", "elt(id % 3 + 1, 'a', 'b c', '') AS text")
        scored = score_texts(docs, F.lit(True)).groupBy((F.col("doc_id") % 3).alias("kind"))
        found = scored.agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).collect()
    finally:
        spark.conf.set(name, before)
    assert sum(r.n for r in found) == 70_000
    assert all(r.low == pytest.approx(r.high) and r.high < 0 for r in found)


def test_no_training_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in score_texts(docs, F.lit(False)).collect()}
    assert found[1].base_score == found[1].score == 0 and found[1].n_known == 0 and found[2].n_tokens == 1
    assert score_texts(docs.limit(0), F.lit(True)).count() == 0
