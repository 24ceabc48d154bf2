import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rosterlake.llm import collocations as module
from rosterlake.llm.collocations import FILTER_BITS, _bitmap, _in_bitmap, collocations, frequent_prefixes


def brute(docs, least, limit=2000, longest=4, covered=80):
    """Rows of (lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    counts = defaultdict(Counter)
    for lang, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                counts["und" if lang is None else lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    found = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        rows = []
        for p, a in candidates.items():
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [c for q, c in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * c >= covered * a for c in longer):
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:limit], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(found)


def rows(found):
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("small", (1, 8, 2048))
def test_quicksort_counts_all_prefixes(monkeypatch, small):
    monkeypatch.setattr(module, "SMALL", small)
    random = np.random.default_rng(5)
    columns = random.integers(1, 6, (700, 4)).astype(np.uint32)
    columns[random.random(700) < 0.3, 3] = 0
    columns[random.random(700) < 0.2, 2:] = 0
    weight = random.integers(1, 4, 700)
    expected = Counter()
    for row, n in zip(columns.tolist(), weight.tolist(), strict=True):
        for size in range(2, 5):
            if all(row[:size]):
                expected[tuple(row[:size])] += n
    at, length, count = frequent_prefixes(columns, weight, 20)
    found = {tuple(columns[a, :k].tolist()): int(c) for a, k, c in zip(at, length, count, strict=True)}
    assert found == {p: c for p, c in expected.items() if c >= 20} and len(found) == len(at)


def test_bitmap_has_its_keys_only(spark):
    keys = np.array([0, 1, 2**63, 2**64 - 1, 2**39, 2**40, 12345 << 39, 3 << 39, 32768 << 39, 32769 << 39], np.uint64)
    table = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key bigint")
    bits = _bitmap(table, FILTER_BITS)
    assert _in_bitmap(bits, keys, FILTER_BITS).all()
    others = np.arange(4, 30_000, 7, dtype=np.uint64) << np.uint64(39)
    others = others[~np.isin(others >> np.uint64(39), keys >> np.uint64(39))]
    assert not _in_bitmap(bits, others, FILTER_BITS).any()


def corpus():
    random = np.random.default_rng(2)
    names = ["The", "of", "cat", "New York", "été bleu", "a", "big", "dog"]
    docs = []
    for i in range(300):
        words = random.choice(names, 40, p=[0.3, 0.2, 0.1, 0.1, 0.05, 0.1, 0.1, 0.05])
        text = " ".join(w + random.choice(["", "", "", ",", ".", "\t", "\n"]) for w in words)
        docs.append(([None, "en", "und", "fr"][i % 4], text))
    return docs + [("en", "one very common passage of words") for _ in range(90)] + [("xx", None), ("xx", ""), ("yy", "a a a"), (None, " ,. ")]


def test_against_all_phrases(spark):
    docs = corpus()
    table = spark.createDataFrame([(lang, text, 1, 2) for lang, text in docs], "lang string, text string, n int, score int")
    expected = brute(docs, 5)
    assert rows(collocations(table.repartition(4), least=5)) == expected and len(expected) > 40
    assert rows(collocations(table, least=5, limit=3)) == brute(docs, 5, 3)
    assert collocations(table.limit(0)).count() == 0


def test_hot_beginnings_and_small_runs(spark, monkeypatch):
    """All words are hot and split over the shards by one, two or three words more."""
    docs = corpus()
    table = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    before = module.partitions
    monkeypatch.setattr(module, "partitions", lambda session: 40 * before(session))
    assert rows(collocations(table, least=5)) == brute(docs, 5)


def test_long_texts_are_read_in_parts(monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["A b. c d, e " * 30, None])], names=["l", "t"])
    (whole,) = module._runs(iter([batch]))
    monkeypatch.setattr(module, "RUN_BYTES", 40)
    parts = list(module._runs(iter([batch])))
    assert len(parts) > 5 and np.array_equal(np.concatenate([p.keys for p in parts]), whole.keys)
    assert np.array_equal(np.concatenate([p.linked for p in parts])[:-1], whole.linked[:-1])


def test_odd_documents(spark, odd_docs):
    found = rows(collocations(odd_docs, least=2))
    assert found == brute([(r.lang, r.text) for r in odd_docs.collect()], 2)
