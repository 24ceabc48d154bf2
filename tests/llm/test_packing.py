import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterlake.llm import packing
from rosterlake.llm.queries import word_tokenizer
from rosterlake.llm.tables import read_table

from .conftest import FOLDER


def check(rows, texts, window=4096):
    """All pieces are right; returns the share of padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(word_tokenizer())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    assert set(by_doc) == set(texts)
    for key, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for row in sorted(by_doc[key], key=lambda r: r.start):
            assert row.start == at and row.doc_tokens == len(ids) and row.length > 0
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    padded = total = 0
    for rows in by_sequence.values():
        at = 0
        for row in sorted(rows, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= window
        total += at
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded / max(total + padded, 1)


def test_documents(spark):
    docs = read_table(spark, FOLDER, "documents")
    rows = packing.pack(docs, word_tokenizer()).collect()
    assert check(rows, {r.doc_id: r.text for r in docs.collect()}) < 0.03


def test_odd_documents(spark, odd_docs):
    docs = odd_docs.withColumn("doc_id", F.monotonically_increasing_id()).coalesce(1)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    check(packing.pack(docs, word_tokenizer()).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert packing.pack(odd_docs, word_tokenizer()).filter("doc_id is null").count() == 2
    assert packing.pack(odd_docs.limit(0), word_tokenizer()).count() == 0


def test_equal_lengths_leave_everything_to_cuts(spark):
    text = " ".join(["word"] * 2999)  # 3000 ids: no combination fills a window
    docs = spark.createDataFrame([(i, text) for i in range(40)], "doc_id bigint, text string").repartition(3)
    rows = packing.pack(docs, word_tokenizer()).collect()
    assert check(rows, {i: text for i in range(40)}) < 0.05
    assert len({r.sequence_id for r in rows}) <= 31


def test_combinations_are_all_ways_to_fill_a_window():
    found = {tuple(r) for r in packing.combinations(12).tolist()}
    assert found == {(a, b, 12 - a - b) for a in range(13) for b in range(a + 1) if a and 0 <= 12 - a - b <= b}


def test_least_squares_is_nonnegative_and_optimal():
    random = np.random.default_rng(3)
    matrix, target = random.integers(0, 3, (12, 40)).astype(float), random.integers(0, 50, 12).astype(float)
    x = packing.nonnegative_least_squares(matrix, target)
    gradient = matrix.T @ (matrix @ x - target)
    assert (x >= 0).all() and (gradient > -1e-5).all() and abs(gradient @ x) < 1e-4


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=32, max_size=32))
def test_plan_uses_no_tail_twice(counts):
    histogram = np.array([0, *counts])
    plan = packing.plan_combinations(histogram)
    assert (plan.used <= histogram).all()
    fill = defaultdict(int)
    places = set()
    for b in range(1, 33):
        sequence, slot = packing.place(plan, np.full(histogram[b], b), np.arange(histogram[b]))
        assert (sequence >= 0).sum() == plan.used[b]
        for s, place in zip(sequence[sequence >= 0].tolist(), slot.tolist()):
            fill[s] += b
            places.add((s, place))
    assert len(places) == plan.used.sum() and set(fill) == set(range(plan.sequences))
    assert all(v == 32 for v in fill.values())


@pytest.mark.parametrize("size,cut", [(10, 3), (5000, 16), (4096, 4095)])
def test_checksum_of_what_follows_a_cut(size, cut):
    ids = np.random.default_rng(size).integers(0, 49_000, size).astype("<u4")
    whole, start = (np.array([packing.crc(x)], np.uint64) for x in (ids, ids[:cut]))
    assert packing.rest_crc(whole, start, np.array([4 * (size - cut)])).tolist() == [packing.crc(ids[cut:])]
    begin, length = np.array([0, 3, size, 1]), np.array([size, size - 5, 0, 2])
    found, cells = packing.start_crcs(ids.astype(np.uint32), begin, length)
    runs = [ids[b : b + n] for b, n in zip(begin, length)]
    assert found.tolist() == [packing.crc(r[:i]) for r in runs for i in range(16, len(r), 16)]
    assert cells.sum() == len(found)


def plain(definition, texts, end=2):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def encoded(definition, texts):
    ids, first = packing.WordEncoder(definition).encode(pa.array(texts), 2)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


ODD = ["it's, dogs' 'tis!?", "Ünïcode… İstanbul, ſt ½% a≮ é, x́.", "w1, 12.5% (a) [b]; c: d​. 한국어, ß», a_b_ --x--"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab1é,.'!<| \ńİ½", max_size=30), max_size=4))
def test_ids_are_those_of_whole_texts(texts):
    texts = [*texts, *ODD, None, ""]
    assert encoded(word_tokenizer(), texts) == plain(word_tokenizer(), texts)


def test_other_definitions():
    """A definition that keeps capitals, and one that does not part letters from signs."""
    stated = json.loads(word_tokenizer())
    stated["normalizer"]["normalizers"].pop()
    kept = json.dumps(stated)
    stated["pre_tokenizer"]["pretokenizers"][0] = {"type": "WhitespaceSplit"}
    joined = json.dumps(stated)
    texts = ["Hello World, Hello; hello", *ODD, "a, b."]
    for definition in (kept, joined):
        assert encoded(definition, texts) == plain(definition, texts)
