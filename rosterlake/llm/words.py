"""Words and word shingles of whole text columns, found with array operations.

A word is a longest run of bytes other than space and 0x09-0x0D. Words are told apart by 64-bit
hashes of their bytes: a polynomial over random byte values, which prefix sums give for all
words of a buffer at once, then mixed. Two different words of a corpus of a billion words share
a hash with a probability of about one in thirty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # text handled at once; a longer document is a slice of its own
SEGMENT_BYTES = 1 << 20  # bytes whose powers are kept; a longer word is a segment of its own
_BASE = np.uint64(0x9E3779B97F4A7C15 // 8 * 8 + 5)
_VALUES = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_STEPS = np.random.default_rng(20240301).integers(1, 2**64, 16, dtype=np.uint64) | np.uint64(1)
_powers = {}

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
IS_TERM = np.zeros(256, bool)  # ASCII letters and digits, and all bytes of other characters
IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values over the whole word (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Bytes of a slice, and the words in them; ``first[d]`` is the first word of document d."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each row begins in them; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def byte_runs(texts: pa.Array, size: int, stops: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts in runs of at most ``size`` bytes: first row, bytes, offsets of the run's rows.

    Short texts are taken whole, several at once. A longer one comes alone, in parts that end
    behind one of the bytes that ``stops`` marks, so that memory does not grow with its length;
    only a stretch without such a byte can make a part longer. Without ``stops`` all parts but the
    last have ``size`` bytes.
    """
    raw, offsets = text_bytes(texts)
    row = 0
    while row < len(texts):
        to = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        if to > row:
            yield row, raw[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
            row = to
            continue
        begin, end = int(offsets[row]), int(offsets[row + 1])
        while begin < end:
            to = min(begin + size, end)
            if to < end and stops is not None:
                found = np.flatnonzero(stops[raw[begin:to]])
                if len(found):
                    to = begin + int(found[-1]) + 1
                else:
                    to = next_stop(raw, to, end, stops)
            yield row, raw[begin:to], np.array([0, to - begin])
            begin = to
        row += 1


def next_stop(raw: np.ndarray, at: int, end: int, stops: np.ndarray) -> int:
    """Behind the first byte from ``at`` on that ``stops`` marks, or ``end``."""
    while at < end:
        found = np.flatnonzero(stops[raw[at : min(at + 4096, end)]])
        if len(found):
            return at + int(found[0]) + 1
        at += 4096
    return end


def find_words(texts: pa.Array, lower: bool = True) -> Words:
    """All words of a string column, A-Z lower-cased if ``lower``."""
    return words_in(*text_bytes(texts), lower)


def words_in(raw: np.ndarray, offsets: np.ndarray, lower: bool = True, table: np.ndarray = IS_WORD) -> Words:
    """All words of texts given by their bytes and where each text begins; ``table`` marks the
    bytes that words are made of."""
    data = LOWER[raw] if lower else raw
    inside = table[raw]
    begins, finishes = inside.copy(), inside.copy()
    if len(raw):
        cut = np.zeros(len(raw) + 1, bool)  # a document's border parts words too
        cut[offsets] = True
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        finishes[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return Words(data, offsets, starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, SEGMENT_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for name, factor in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            to = max(int(np.searchsorted(ends, starts[at] + SEGMENT_BYTES, "right")), at + 1)
            low, high = starts[at], ends[to - 1]
            up, down = _power_table(int(high - low) + 1)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_VALUES[data[low:high]] * up[: high - low], out=sums[1:])
            begin, end = starts[at:to] - low, ends[at:to] - low
            out[at:to] = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
            at = to
    return out


def word_hashes(words: Words) -> np.ndarray:
    return hash_spans(words.data, words.starts, words.ends)


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of ``n`` words, and the first one of each document.

    A document with fewer words has its whole sequence as one run; one without words has none.
    """
    hashes, counts = word_hashes(words), words.counts
    with np.errstate(over="ignore"):
        size = len(hashes)
        runs = np.zeros(size, np.uint64)
        for k in range(n):
            runs[: max(size - k, 0)] += hashes[k:] * _STEPS[k]
        runs = mix(runs + np.uint64(n))
        for d in np.flatnonzero((counts > 0) & (counts < n)):
            own = hashes[words.first[d] : words.first[d + 1]]
            runs[words.first[d]] = mix((own * _STEPS[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own)))[()]
    kept = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(kept)])
    place = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], kept)
    return runs[place], first


def distinct_by_document(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each document, and the first one of each."""
    values = values.copy()
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        values[begin:end].sort()  # one document at a time is faster than all at once by two keys
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[first[:-1][first[:-1] < first[1:]]] = True
    return values[new], np.concatenate([[0], np.cumsum(new)])[first]
