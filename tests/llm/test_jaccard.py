import random
from collections import defaultdict

import pytest

from rosterlake.llm import jaccard
from rosterlake.llm.components import connected_components
from rosterlake.llm.jaccard import near_duplicates

from .test_decontamination import plain_shingles


def joined(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def brute(rows, percent=80):
    sets = [plain_shingles(r.text) for r in rows]
    by_shingle = defaultdict(list)
    for i, own in enumerate(sets):
        for s in own:
            by_shingle[s].append(i)
    pairs = {(a, b) for own in by_shingle.values() for a in own for b in own if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    roots = joined(range(len(rows)), links)
    least = defaultdict(lambda: None)
    for i, r in roots.items():
        keys = [k for k in (least[r], rows[i].doc_id) if k is not None]
        least[r] = min(keys, default=None)
    return sorted(((row.doc_id, len(sets[i]), least[roots[i]]) for i, row in enumerate(rows)), key=str)


def found(docs, **form):
    return sorted((tuple(r) for r in near_duplicates(docs, **form).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    source = random.Random(seed)
    nodes = list(range(60))
    links = [(source.choice(nodes), source.choice(nodes)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    links += [(200, 200 + i) for i in range(40)]
    frame = spark.createDataFrame([*links, (None, 5), (5, None)], "a bigint, b bigint")
    expected = joined({n for link in links for n in link}, links)
    in_links = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.root for r in connected_components(frame).collect()} == {n: r for n, r in expected.items() if n in in_links}
    assert connected_components(frame.limit(0)).count() == 0


def test_odd_documents(spark, odd_docs):
    assert found(odd_docs) == brute(odd_docs.collect())
    assert found(odd_docs.limit(0)) == []


def varied(source, words, edits):
    words = list(words)
    for _ in range(edits):
        words[source.randrange(len(words))] = f"e{source.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("pairs", [1 << 22, 0])
def test_groups_of_near_copies_and_shared_passages(spark, monkeypatch, pairs):
    """Chains around the threshold, a large group, a passage in many documents; also in small turns."""
    monkeypatch.setattr(jaccard, "PAIRS", pairs)
    monkeypatch.setattr(jaccard, "PER_ENTRY", 64 if pairs else 0)
    monkeypatch.setattr(jaccard, "TESTED", 50)
    monkeypatch.setattr(jaccard, "HELD", 3000)
    monkeypatch.setattr(jaccard, "RANKED", 300)
    source = random.Random(7)
    texts = []
    base = [f"b{i}" for i in range(80)]
    texts += [varied(source, base, source.randrange(4)) for _ in range(60)]
    for g in range(25):
        own = [f"g{g}w{i}" for i in range(source.randrange(3, 60))]
        for _ in range(source.randrange(1, 6)):
            texts.append(varied(source, own, source.randrange(3)))
            own = texts[-1].split() if source.random() < 0.5 else own
    passage = [f"p{i}" for i in range(30)]
    texts += [" ".join([*(f"u{n}x{i}" for i in range(source.randrange(5, 40))), *passage]) for n in range(60)]
    order = list(range(len(texts)))
    source.shuffle(order)
    docs = spark.createDataFrame([(k, texts[i]) for k, i in enumerate(order)], "doc_id bigint, text string").repartition(5)
    assert found(docs) == brute(docs.collect())


@pytest.mark.parametrize("pairs", [1 << 22, 0])
def test_large_buckets_cover_many_rows(spark, monkeypatch, pairs):
    """A family of near copies, chains in it, and a passage, in buckets of many parts."""
    monkeypatch.setattr(jaccard, "PAIRS", pairs)
    monkeypatch.setattr(jaccard, "PER_ENTRY", 0)
    monkeypatch.setattr(jaccard, "PIVOTS", 4)
    source = random.Random(11)
    base = [f"b{i}" for i in range(60)]
    texts = [varied(source, base, source.randrange(1, 4)) for _ in range(150)]
    for _ in range(60):
        texts.append(varied(source, source.choice(texts).split(), 2))
    passage = [f"p{i}" for i in range(30)]
    texts += [" ".join([*(f"u{n}x{i}" for i in range(source.randrange(3, 12))), *passage]) for n in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    assert found(docs, part=9) == brute(docs.collect())


def test_no_row_holds_more_than_a_part(spark):
    source = random.Random(2)
    base = [f"b{i}" for i in range(60)]
    texts = [varied(source, base, 1) for _ in range(100)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    buckets = jaccard.prefix_buckets(frame, 5, 80, 8, part=7).collect()
    assert max(r.parts for r in buckets) > 5 and all(1 <= len(r.classes) <= 7 for r in buckets)
    for name in {r.bucket for r in buckets}:
        own = [r for r in buckets if r.bucket == name]
        assert sorted(r.part for r in own) == list(range(own[0].parts))
        classes = [c for r in own for c in r.classes]
        assert len(set(classes)) == len(classes) > 1


def test_prefixes_meet_under_every_order():
    import numpy as np

    sizes = np.array([0, 1, 4, 5, 6, 10, 99])
    assert jaccard.prefix_size(sizes, 80).tolist() == [0, 1, 1, 2, 2, 3, 20]
