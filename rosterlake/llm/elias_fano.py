"""Elias-Fano coded sequences and the n-gram trie made of them, in memory-mapped levels."""

from __future__ import annotations

import os
import tempfile
from typing import NamedTuple

import numpy as np

SPAN = 4096  # elements that are decoded together
STEPS = 1024  # codes per factor of two of a quantised probability


def _pack_low(values: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(0, np.uint8)
    planes = ((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(planes.ravel(), bitorder="little")


class EliasFano(NamedTuple):
    """A non-decreasing sequence in about 2 + log2(last / size) bits per element.

    ``low`` has the low bits of every element, ``high`` in unary how far the rest of each is above
    the one before. Per ``SPAN`` elements, ``first`` has the first value and ``place`` its bit.
    """

    size: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    place: np.ndarray

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        size = len(values)
        bits = max(int(values[-1]) // size, 1).bit_length() - 1 if size else 0
        low = [
            _pack_low(values[i : i + SPAN] & np.uint64((1 << bits) - 1), bits) for i in range(0, size, SPAN)
        ]
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(size)
        high = np.zeros(int(places[-1]) + 1 if size else 0, np.uint8)
        high[places] = 1
        empty = np.zeros(0, np.uint8)
        return cls(
            size, bits, np.concatenate([empty, *low]), np.packbits(high, bitorder="little"),
            values[::SPAN].copy(), places[::SPAN].copy(),
        )

    def span(self, number: int) -> np.ndarray:
        """The values of one span."""
        begin = number * SPAN
        count = min(SPAN, self.size - begin)
        start = int(self.place[number])
        stop = int(self.place[number + 1]) if number + 1 < len(self.place) else len(self.high) * 8
        ones = np.flatnonzero(np.unpackbits(self.high[start >> 3 : (stop + 7) >> 3], bitorder="little"))
        ones = ones + (start & ~7)
        ones = ones[np.searchsorted(ones, start) :][:count]
        high = (ones - np.arange(begin, begin + count)).astype(np.uint64) << np.uint64(self.bits)
        if not self.bits:
            return high
        at = number * (SPAN * self.bits // 8)
        raw = np.unpackbits(self.low[at : at + (count * self.bits + 7) // 8], bitorder="little")[: count * self.bits]
        weights = np.uint64(1) << np.arange(self.bits, dtype=np.uint64)
        return high | (raw.reshape(count, self.bits).astype(np.uint64) * weights).sum(1, dtype=np.uint64)

    def access(self, index: np.ndarray) -> np.ndarray:
        """The elements at sorted places."""
        out = np.empty(len(index), np.uint64)
        for number, begin, end in _runs(index // SPAN):
            out[begin:end] = self.span(number)[index[begin:end] - number * SPAN]
        return out

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of the sorted values the place of the first element that is not smaller, and
        whether it is equal. Sequences searched this way have no repeated elements."""
        at, equal = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        if not self.size:
            return at, equal
        spans = np.maximum(np.searchsorted(self.first, wanted, "right") - 1, 0)
        for number, begin, end in _runs(spans):
            values = self.span(number)
            place = np.searchsorted(values, wanted[begin:end])
            at[begin:end] = number * SPAN + place
            equal[begin:end] = values[np.minimum(place, len(values) - 1)] == wanted[begin:end]
        return at, equal


def _runs(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(number, begin, end) of the runs of equal numbers."""
    if not len(numbers):
        return []
    begin = np.flatnonzero(np.diff(numbers, prepend=numbers[0] - 1))
    return [(int(numbers[b]), int(b), int(e)) for b, e in zip(begin, np.append(begin[1:], len(numbers)), strict=True)]


def quantise(share: np.ndarray) -> np.ndarray:
    """16-bit codes of shares in (0, 1], rounded down so that sums of shares do not grow."""
    return np.minimum(np.ceil(-np.log2(share) * STEPS - 1e-9), 65535).astype(np.uint16)


def dequantise(code: np.ndarray) -> np.ndarray:
    return np.exp2(-code.astype(np.float64) / STEPS)


def mapped(array: np.ndarray) -> np.ndarray:
    """The array, read through a memory-mapped file of the task's own that has no name any more."""
    if not array.nbytes:
        return array
    handle, path = tempfile.mkstemp(prefix="level-")
    try:
        with os.fdopen(handle, "wb") as file:
            array.tofile(file)
        return np.memmap(path, array.dtype, "r", shape=array.shape)
    finally:
        os.unlink(path)


class Trie:
    """Contexts and their successors with smoothed probabilities.

    Level 1 holds the sorted contexts, where the successors of each begin, and the share of
    probability each leaves to the next lower order. Level 2 holds each context's successors;
    they are stored plus a base per context, the largest value before them, which makes the whole
    level one increasing sequence: a successor is found from its context's base on.
    """

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray, total: np.ndarray, discount: float) -> None:
        """Rows sorted by context and word without repeats; ``total`` is the context's count."""
        begin = np.flatnonzero(np.diff(context, prepend=~context[:1]) != 0)
        size = np.diff(np.append(begin, len(context)))
        last = word[begin + size - 1].astype(np.uint64) + np.uint64(1)
        base = np.cumsum(last) - last
        shares = np.maximum(count - discount, 1e-300) / total
        left = discount * size / total[begin]
        self.contexts = self._level(EliasFano.encode(context[begin]))
        self.bases = self._level(EliasFano.encode(base))
        self.words = self._level(EliasFano.encode(word.astype(np.uint64) + np.repeat(base, size)))
        self.left, self.shares = mapped(quantise(np.minimum(left, 1))), mapped(quantise(np.minimum(shares, 1)))
        self.ends = self._level(EliasFano.encode(begin + size))

    @staticmethod
    def _level(level: EliasFano) -> EliasFano:
        return level._replace(low=mapped(level.low), high=mapped(level.high))

    def lookup(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For rows sorted by context and word: whether the context is known, the share of the
        word in it (0 if it never followed), and the share left to the lower order."""
        at, known = self.contexts.successor(context)
        rows = np.flatnonzero(known)
        share, left = np.zeros(len(context)), np.ones(len(context))
        if len(rows):
            node = at[rows]
            left[rows] = dequantise(self.left[node])
            target = self.bases.access(node) + word[rows].astype(np.uint64)
            place, found = self.words.successor(target)
            found &= place < self.ends.access(node).astype(np.int64)
            share[rows[found]] = dequantise(self.shares[place[found]])
        return known, share, left
