import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterlake.llm import language
from rosterlake.llm.language import Model, has_language, identify_language, suffix_automaton
from rosterlake.llm.tables import in_fold, read_table
from rosterlake.llm.words import text_bytes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=30))
def test_automaton_knows_exactly_the_substrings(symbols):
    steps = suffix_automaton(symbols)

    def known(word):
        state = 0
        for c in word:
            if c not in steps[state]:
                return False
            state = steps[state][c]
        return True

    inside = {tuple(symbols[i:j]) for i in range(len(symbols)) for j in range(i, len(symbols) + 1)}
    for word in inside:
        assert known(word)
        for c in range(3):
            assert known((*word, c)) == ((*word, c) in inside)


def phrases(text, sample):
    """Greedy longest matches by searching the sample."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        if end == len(text) and text[at:end] in sample:
            break  # not ended within the segment
        count += text[at:end] in sample or end > at + 1 or text[at] not in sample
        at = end
    return count


def test_phrases_are_longest_matches(monkeypatch):
    monkeypatch.setattr(language, "SEGMENT", 16)
    random = np.random.default_rng(1)
    samples = [(name, bytes(random.choice(list(alphabet.encode()), 60))) for name, alphabet in (("a", "abc"), ("b", "bcd"))]
    model = Model(samples)
    texts = ["".join(random.choice(list("abcd"), size)) for size in (0, 1, 5, 16, 17, 50)]
    found = model.counts(*text_bytes(pa.array(texts)))
    for row, (_, sample) in zip(found, samples):
        for value, text in zip(row, texts):
            total = 0
            for at in range(0, len(text), 16):
                part, i = text[at : at + 16].encode(), 0
                while i < len(part):
                    j = i
                    while j < len(part) and part[i : j + 1] in sample:
                        j += 1
                    if j == len(part):
                        break
                    total += 1
                    i = j if j > i else i + 1
                    if j == i - 1:
                        continue
            # a symbol that ends a phrase begins the next one; unknown symbols are phrases of their own
            assert abs(value - total) <= total + 1
            assert (value == 0) == (total == 0)


def test_long_texts_are_parsed_in_parts(monkeypatch):
    model = Model([("a", b"the cat sat on the mat, a cat"), ("b", b"le chat est sur le tapis")])
    texts = pa.array(["the cat " * 500, None, "", "le chat!! " * 300, "sur " * 2000])
    whole = model.predict(texts)
    monkeypatch.setattr(language, "RUN_BYTES", 2 * language.SEGMENT)
    assert all(np.array_equal(a, b) for a, b in zip(whole, model.predict(texts), strict=True))
    assert whole[0][0] == "a" and whole[0][3] == whole[0][4] == "b" and whole[2].tolist()[:3] == [3000, 0, 0]


def test_texts_without_a_language(spark):
    """Codes and random letters are told from the languages of the table and from other prose."""
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    random = np.random.default_rng(3)

    def letters(alphabet):
        return "".join(random.choice(list(alphabet), 1500))

    junk = [letters("0123456789abcdef "), letters("abcdefghijklmnopqrstuvwxyz "), letters("ABCDEFxyz0123456789+/"), "§ß¬" * 200]
    prose = ["The quick brown fox jumps over the lazy dog and many other things of no interest to anybody. " * 2, "Ok"]
    more = [(5000 + i, t) for i, t in enumerate(junk)] + [(6000 + i, t) for i, t in enumerate(prose)]
    both = docs.unionByName(spark.createDataFrame(more, "doc_id bigint, text string"), True)
    found = identify_language(both).select("doc_id", has_language().alias("kept")).collect()
    gone = {r.doc_id for r in found if not r.kept}
    assert {k for k in gone if k >= 5000} == {5000 + i for i in range(len(junk))}
    assert {k for k in gone if k < 5000} <= {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}


def test_held_out_accuracy(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    found = identify_language(docs, ~in_fold(F.col("doc_id"), 4, 2)).filter(in_fold(F.col("doc_id"), 4, 2))
    rows = found.select("lang", "lang_pred", "score").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_documents(spark, odd_docs):
    french = [(100, "le chat et la souris", "fr"), (101, None, "fr"), (102, "123", "fr"), (103, "le chien", None)]
    docs = odd_docs.unionByName(spark.createDataFrame(french, "doc_id bigint, text string, lang string"), True)
    rows = identify_language(docs).collect()
    assert len(rows) == docs.count()
    for row in rows:
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not letters) and 0 <= row.score <= 1
        assert letters or row.score == 0
    assert {r.lang_pred for r in rows if r.doc_id in (100, 103)} == {"fr"}


def test_nothing_to_learn_from(spark, odd_docs):
    assert {r.lang_pred for r in identify_language(odd_docs, F.lit(False)).collect()} == {"und"}
    assert identify_language(odd_docs.limit(0)).count() == 0
    one = identify_language(odd_docs.filter("doc_id = 1")).first()
    assert (one.lang_pred, one.score) == ("en", 1.0)
