import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rosterlake.llm import lexical
from rosterlake.llm.lexical import Block, length_terms, ranked_search, share
from rosterlake.llm.words import find_words, word_hashes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """(item, rank, document, score) by scoring every document for every item."""
    bags = [(key, Counter(terms(text))) for key, text in docs if terms(text)]
    number, total = len(bags), sum(sum(b.values()) for _, b in bags)
    frequency = Counter(t for _, b in bags for t in b)
    found = []
    for item, text in items:
        scores = []
        for key, bag in bags:
            m = 25 + (75 * sum(bag.values()) * number) // total
            score = 0
            for t in terms(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * number + 2) / (2 * frequency[t] + 1)))
                    score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0))
        for rank, (score, absent, key) in enumerate(sorted(scores)[:k], 1):
            found.append((item, rank, None if absent else key, -score))
    return sorted(found, key=str)


def rows(found):
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_plan_gives_plain_sums_and_shares(seed):
    random = np.random.default_rng(seed)
    queries = [random.integers(0, 40, random.integers(1, 60)) for _ in range(12)] + [np.array([3, 3, 5])] * 2
    plan = share(queries)
    parts, document = random.integers(1, 99, (41, 7)), np.arange(7)
    block = Block(np.arange(len(queries)), np.zeros(41, np.uint64), plan)
    cells = [(d, t) for d in document for t in range(40)]
    found = block.scores(
        np.array([parts[t, d] for d, t in cells]), np.array([d for d, _ in cells]), np.array([t for _, t in cells]), 7
    )
    assert np.array_equal(found, np.stack([parts[q].sum(0) for q in queries]))
    assert len(plan.pairs) > 0 and sum(map(len, plan.tops)) + len(plan.pairs) < sum(len(set(q.tolist())) for q in queries)
    assert all(a < plan.leaves + j and b < plan.leaves + j for j, (a, b) in enumerate(plan.pairs))


def test_long_texts_are_counted_in_parts(monkeypatch):
    hashes = np.sort(word_hashes(find_words(pa.array(["alpha beta"]))))
    block = Block(np.zeros(1, np.int64), hashes, share([np.array([0, 1])]))
    texts = pa.array(["Alpha, gamma-beta " * 50, None, "", "beta", "x" * 300, "alpha;" * 40])
    whole = block.counts(texts)
    monkeypatch.setattr(lexical, "RUN_BYTES", 32)
    assert all(np.array_equal(a, b) for a, b in zip(whole, block.counts(texts), strict=True))
    assert whole[0].tolist() == [150, 0, 0, 1, 1, 40] and sorted(whole[3].tolist()) == [1, 40, 50, 50]


def test_length_terms_beyond_64_bits():
    big = length_terms(np.array([1 << 40, 3]), 1 << 20, 1 << 41)
    assert big.tolist() == [25 + 75 * (1 << 60) // (1 << 41), 25]


def test_odd_documents_and_items(spark, odd_docs):
    texts = ["alpha beta w3 w4 w4", "alpha beta w3 w4 w4", None, "", "!!", "ÉTÉ 123 été", "one two Two", "nothing here"]
    items = [(i, t) for i, t in enumerate(texts)] + [(None, "zeta iota"), (1, "one")]
    table = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS key", "2 AS rank", "3 AS doc_id")
    found = ranked_search(odd_docs, table, k=3)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == brute([(r.doc_id, r.text) for r in odd_docs.collect()], items, 3)
    for left, right in ((odd_docs.limit(0), table), (odd_docs, table.limit(0))):
        assert ranked_search(left, right).count() == 0
    assert ranked_search(odd_docs, odd_docs, item_key="doc_id", k=1).columns[0] == "item_doc_id"


def test_blocks_of_queries_and_small_runs(spark, monkeypatch):
    """Several blocks, equal items, ties at the border, many documents with equal scores."""
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 12)
    docs = [(i, f"red {'blue ' * (i % 5)} w{i % 11} green" + " red" * (i % 3)) for i in range(400)] + [(i, "red blue") for i in range(400, 900)]
    items = [(i, t) for i, t in enumerate(["red blue", "red blue", "blue w3 w4 green", "green green red", "w10", "w1 w2 w3 blue"])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    found = ranked_search(d, spark.createDataFrame(items, "item_id bigint, text string"), k=7)
    assert rows(found) == brute(docs, items, 7)
