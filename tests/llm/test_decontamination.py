import pytest

from rosterlake.llm import decontamination
from rosterlake.llm.decontamination import contained_items, without_items

from .test_words import plain_words


def plain_shingles(text, n=5):
    words = plain_words(text)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(docs, items, percent=80):
    out = []
    for d, text in docs:
        for i, item in items:
            own, wanted = plain_shingles(text), plain_shingles(item)
            shared = len(own & wanted)
            if wanted and 100 * shared >= percent * len(wanted):
                out.append((d, i, len(wanted), shared))
    return sorted(out, key=str)


@pytest.fixture
def items(spark):
    long = " ".join(f"q{i}" for i in range(60))
    rows = [
        (1, long), (2, "one two"), (3, None), (4, ""), (5, "alpha beta gamma delta epsilon zeta eta theta"),
        (5, "alpha beta gamma delta epsilon zeta eta theta"), (None, "w1 w2 w3 w4 w5 w6"), (6, "never seen before in any text at all"),
    ]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "item_id bigint, text string, doc_id int, hashes string")


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_equals_comparing_all_pairs(spark, odd_docs, items, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_SHINGLES", block)
    words = [f"q{i}" for i in range(60)]
    near = [(20 + k, " ".join(["pre"] * 9 + words[:k] + ["broken"] + words[k + 1 :] + ["post"] * 50)) for k in (0, 3, 30, 59)]
    near += [(40, " ".join(words[: 60 - 11])), (41, " ".join(words[: 60 - 12])), (42, " ".join(words[:47]))]
    docs = odd_docs.unionByName(spark.createDataFrame(near, "doc_id bigint, text string"), True)
    found = sorted((tuple(r) for r in contained_items(docs, items).collect()), key=str)
    pairs = ([(r[0], r.text) for r in frame.collect()] for frame in (docs, items))
    assert found == brute(*pairs)
    kept = without_items(docs, items)
    assert kept.columns == docs.columns
    hits = {r.text for r in docs.collect() if brute([(0, r.text)], [(0, i.text) for i in items.collect()])}
    assert sorted(str(r) for r in kept.collect()) == sorted(str(r) for r in docs.collect() if r.text not in hits)


def test_equal_items_fill_no_block(spark, monkeypatch):
    """Half of the items are equal: they are searched as one and all found."""
    sizes, plain = [], decontamination.ItemBlock.__init__

    def seen(self, rows, percent):
        sizes.append(sum(len(row["hashes"]) for row in rows))
        plain(self, rows, percent)

    monkeypatch.setattr(decontamination.ItemBlock, "__init__", seen)
    monkeypatch.setattr(decontamination, "BLOCK_SHINGLES", 100)
    items = [(i, "a b c d e f g h") for i in range(300)] + [(i, f"i{i} b c d e f") for i in range(300, 600)]
    docs = [(1, "x a b c d e f g h y"), (2, "i400 b c d e f"), (3, "nothing of it")]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame(items, "item_id bigint, text string")
    found = sorted((tuple(r) for r in contained_items(docs, items).collect()), key=str)
    assert found == sorted([(1, i, 4, 4) for i in range(300)] + [(2, 400, 2, 2)], key=str)
    assert [r.doc_id for r in without_items(docs, items).collect()] == [3]
    assert max(sizes) <= 200


def test_empty_tables(spark, odd_docs, items):
    assert contained_items(odd_docs.limit(0), items).count() == 0
    assert contained_items(odd_docs, items.limit(0)).count() == 0
    assert without_items(odd_docs, items.limit(0)).count() == odd_docs.count()
    assert contained_items(odd_docs, items).columns == ["doc_id", "item_id", "n_item", "n_shared"]
