import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterlake.llm.words import distinct_by_document, find_words, shingles, slices, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0d]+")
TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(TO_LOWER))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé \t\n\x0b 中", max_size=12)), max_size=8))
def test_words_are_runs_without_white_space(texts):
    words = find_words(pa.array(texts, pa.string()))
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]
    expected = [plain_words(t) for t in texts]
    assert found == [w for own in expected for w in own]
    assert words.counts.tolist() == [len(own) for own in expected]
    hashes = word_hashes(words)
    by_word = {}
    for word, value in zip(found, hashes.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_shingles_are_runs_of_five_words_or_the_whole_short_text():
    texts = ["a b c d e f", "b c d e f", "a b", "a b", "b a", "", None, "a a a a a a a"]
    values, first = distinct_by_document(*shingles(find_words(pa.array(texts))))
    sets = [set(values[a:b].tolist()) for a, b in zip(first[:-1], first[1:])]
    assert [len(s) for s in sets] == [2, 1, 1, 1, 1, 0, 0, 1]
    assert sets[1] < sets[0]
    assert sets[2] == sets[3] != sets[4]


def test_slices_and_offsets_change_nothing():
    texts = pa.array([f"w{i} " * (i % 50) for i in range(200)])
    whole = word_hashes(find_words(texts)).tolist()
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    parts = list(slices(iter([batch]), "text", 500))
    assert sum(p.num_rows for p in parts) == 200
    assert [h for p in parts for h in word_hashes(find_words(p.column(0))).tolist()] == whole


def test_words_longer_than_a_segment():
    texts = pa.array(["y" * 3_000_000 + " a", "a"])
    hashes = word_hashes(find_words(texts))
    assert len(hashes) == 3 and hashes[1] == hashes[2] != hashes[0]
    assert hashes.dtype == np.uint64
