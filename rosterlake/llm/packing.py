"""Packing of tokenised documents into fixed windows by non-negative least squares.

Every document gives full windows and a tail. The tails' lengths form a histogram over bins.
All combinations of up to three bins that fill a window are enumerated, and non-negative least
squares says how often each is to be used so that the histogram is used up. The repeats are
rounded down, what is then left over is first used greedily by further combinations, and the
rest is laid end to end in cells of a bin's width and cut at the window's border. So only the
difference between a tail and its bin is padded.

Tails get their places from their rank within their bin: counts per partition and bin, summed
up in order, give each tail its rank without sorting or gathering a bin anywhere. Token ids do
not leave the task that makes them: tails carry the checksums of their starts at every cell's
border, and the checksum of what follows a cut is computed from them.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import giving_back, kept, written
from .words import Words, find_words, hash_spans, slices, text_bytes

BIN = 16  # tokens
CACHED_WORDS = 1 << 19  # per worker process; the cache starts afresh beyond that
TOGETHER = 64  # words of letters that are encoded as one text
# Fixed value: how a definition says that letters, single digits and other signs are parted.
LETTERS_APART = r"[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGN = np.zeros(256, bool)  # ASCII signs but the apostrophe, which begins endings like 's
_SIGN[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


class WordEncoder:
    """Token ids of texts whose tokenizer never joins words over white space.

    Each distinct word is encoded once, and its ids are looked up by the hash of its bytes. Where
    the definition parts letters from other signs, a word and the signs after it are two words.
    """

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        stated = json.loads(definition)
        normalizer = stated.get("normalizer") or {}
        self.lower = any(n.get("type") == "Lowercase" for n in [normalizer, *normalizer.get("normalizers", [])])
        self.apart = LETTERS_APART in json.dumps(stated.get("pre_tokenizer"))
        suffix = stated["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.hashes, self.begin = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        if len(self.hashes) + len(hashes) > CACHED_WORDS:
            self.clear()
        letters = [i for i, w in enumerate(words) if w.isalpha()] if self.ends.any() else []
        size, parts = np.zeros(len(words), np.int64), [None] * len(words)
        for at, found in self._together(letters, words):
            ends = np.flatnonzero(self.ends[found]) + 1
            if len(ends) == len(at):  # one word each, as white space parts them
                size[at] = np.diff(ends, prepend=0)
                parts[at[0]] = found
        single = [i for i, n in enumerate(size.tolist()) if not n]
        for i, e in zip(single, self._encoded([words[i] for i in single]), strict=True):
            size[i], parts[i] = len(e), e
        # the ids of words that were encoded together are where the first of them is
        order = np.array([i for i in letters if size[i]], np.int64)
        known = np.zeros(len(words), bool)
        known[order] = True
        known[single] = False
        order = np.concatenate([order[known[order]], np.array(single, np.int64)])
        begin = np.empty(len(words), np.int64)
        begin[order] = len(self.ids) + np.cumsum(size[order]) - size[order]
        self.ids = np.concatenate([self.ids, *[parts[i] for i in order.tolist() if parts[i] is not None]])
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.begin, self.size = np.insert(self.begin, at, begin), np.insert(self.size, at, size)

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(e.ids, np.uint32)

    def _together(self, places: list[int], words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Places of words and the ids of all of them, ``TOGETHER`` words at a time."""
        groups = [places[i : i + TOGETHER] for i in range(0, len(places), TOGETHER)]
        yield from zip(groups, self._encoded([" ".join([words[i] for i in g]) for g in groups]), strict=True)

    def parted(self, words: Words) -> Words:
        """The words, those that end with other ASCII signs after a letter or digit as two."""
        if not len(words.starts):
            return words
        plain = np.where(_SIGN[words.data], -1, np.arange(len(words.data)))
        head = np.maximum.accumulate(plain)[words.ends - 1] + 1
        cut = (head > words.starts) & (head < words.ends)
        cut[cut] = _ALNUM[words.data[head[cut] - 1]]
        starts, ends = np.sort(np.concatenate([words.starts, head[cut]])), np.sort(np.concatenate([words.ends, head[cut]]))
        return words._replace(starts=starts, ends=ends, first=np.searchsorted(starts, words.offsets))

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end``, and where each text's ids begin."""
        raw, _ = text_bytes(texts)
        special = b"<|" in raw.tobytes()
        # words of either case may have the same ids, but special tokens, which contain "<|", have not
        words = find_words(texts, lower=self.lower and not special)
        if self.apart and not special:
            words = self.parted(words)
        hashes, first, inverse = np.unique(
            hash_spans(words.data, words.starts, words.ends), return_index=True, return_inverse=True
        )

        def unknown() -> np.ndarray:
            if not len(self.hashes):
                return np.ones(len(hashes), bool)
            return self.hashes[np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)] != hashes

        new = unknown()
        if len(self.hashes) + new.sum() > CACHED_WORDS:
            self.clear()
            new = unknown()
        if new.any():
            spans = zip(words.starts[first[new]].tolist(), words.ends[first[new]].tolist(), strict=True)
            text = raw.tobytes()
            self.learn(hashes[new], [text[a:b].decode() for a, b in spans])
        place = np.searchsorted(self.hashes, hashes)[inverse]
        size, begin = self.size[place], self.begin[place]
        before = np.cumsum(size) - size
        total = int(size.sum())
        source = np.arange(total) + np.repeat(begin - before, size)
        target = np.arange(total) + np.repeat(words.documents(), size)
        out = np.full(total + len(texts), end, np.uint32)
        out[target] = self.ids[source]
        sums = np.concatenate([[0], np.cumsum(size)])
        return out, sums[words.first] + np.arange(len(texts) + 1)


def crc(ids: np.ndarray, running: int = 0) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes(), running)


def _after_zeros() -> list[np.ndarray]:
    """For each power of two, what 2^k zero bytes make of each bit of a CRC-32."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    step = np.concatenate([[np.uint32(0xEDB88320)], bits[:-1]])  # one zero bit
    tables = []
    for k in range(3 + 40):
        if k >= 3:
            tables.append(step)
        step = _apply(step, step)
    return tables


def _apply(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.uint32)
    for bit in range(32):
        out ^= np.where((values >> np.uint32(bit)) & np.uint32(1), table[bit], np.uint32(0)).astype(np.uint32)
    return out


_ZEROS = _after_zeros()


def _halves(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A linear map of 32 bits as look-ups of its lower and upper half."""
    half = np.arange(1 << 16, dtype=np.uint32)
    return _apply(table, half), _apply(table, half << np.uint32(16))


_WORD = _halves(_ZEROS[2])  # four bytes on
_CELL = _halves(_ZEROS[(4 * BIN).bit_length() - 1])  # a cell on
_LOW, _SIXTEEN = np.uint32(0xFFFF), np.uint32(16)


def start_crcs(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ids: checksums of their first BIN, 2 BIN, ... ids short of all, and how many.

    The cells of all runs are summed up together, id by id; then a run's starts follow from its
    cells, cell by cell in all runs at once.
    """
    cells = np.maximum(-(-size // BIN) - 1, 0)
    first = np.cumsum(cells) - cells
    place = np.repeat(begin - first * BIN, cells) + np.arange(cells.sum()) * BIN
    value = np.full(len(place), 0xFFFFFFFF, np.uint32)
    for k in range(BIN):
        value ^= ids[place + k]
        value = _WORD[0][value & _LOW] ^ _WORD[1][value >> _SIXTEEN]
    value ^= np.uint32(0xFFFFFFFF)
    longest = np.argsort(-cells, kind="stable")
    live = np.searchsorted(-cells[longest], -np.arange(1, int(cells.max(initial=0)) + 1), "right")
    for k in range(1, len(live)):
        at = first[longest[: live[k]]] + k
        before = value[at - 1]
        value[at] ^= _CELL[0][before & _LOW] ^ _CELL[1][before >> _SIXTEEN]
    return value, cells


def rest_crc(whole: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of what follows a start, from those of the whole and the start and the bytes that follow."""
    moved = start.astype(np.uint32)
    for k, table in enumerate(_ZEROS):
        moved = np.where((length >> k) & 1, _apply(table, moved), moved) if (length >> k).any() else moved
    return whole.astype(np.uint32) ^ moved


def tokenize(docs: DataFrame, key: str, text: str, definition: str, end: int, window: int) -> DataFrame:
    """What packing has to know of the token ids of every row, written once as compressed Parquet.

    row (unique), part (the task), key, n, full_crc (of each full window), before_full (full
    windows earlier in the part), tail, tail_crc, starts (checksums of the tail's starts), bin (0:
    no tail), in_bin (tails of the bin earlier in the part).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(definition)
    token = hash(definition)

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("tokenizer", token), lambda: WordEncoder(shared.value))
        part = TaskContext.get().partitionId()
        rows, full_before = 0, 0
        in_bin = np.zeros(-(-window // BIN) + 1, np.int64)
        for batch in slices(batches, "text"):
            ids, first = encoder.encode(batch.column(1), end)
            n = np.diff(first)
            full, tail = n // window, n % window
            bins = -(-tail // BIN)
            crcs = [[crc(ids[a + i * window : a + (i + 1) * window]) for i in range(f)] for a, f in zip(first, full)]
            tails = [crc(ids[b - t : b]) for b, t in zip(first[1:], tail)]
            order = np.argsort(bins, kind="stable")
            run_start = np.searchsorted(bins[order], bins[order])
            rank = np.empty(len(n), np.int64)
            rank[order] = np.arange(len(n)) - run_start
            rank += in_bin[bins]
            in_bin += np.bincount(bins, minlength=len(in_bin))
            starts, cells = start_crcs(ids, first[1:] - tail, tail)
            cell_ends = pa.array(np.concatenate([[0], np.cumsum(cells)]), pa.int32())
            columns = {
                "row": pa.array((part << 40) + rows + np.arange(len(n)), pa.int64()),
                "part": pa.array(np.full(len(n), part), pa.int32()),
                "key": batch.column(0),
                "n": pa.array(n, pa.int64()),
                "full_crc": pa.array(crcs, pa.list_(pa.int64())),
                "before_full": pa.array(full_before + np.cumsum(full) - full, pa.int64()),
                "tail": pa.array(tail, pa.int64()),
                "tail_crc": pa.array(tails, pa.int64()),
                "starts": pa.ListArray.from_arrays(cell_ends, pa.array(starts.view(np.int32))),
                "bin": pa.array(bins, pa.int32()),
                "in_bin": pa.array(rank, pa.int64()),
            }
            rows += len(n)
            full_before += int(full.sum())
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"row bigint, part int, key {kind}, n bigint, full_crc array<bigint>, before_full bigint, "
        "tail bigint, tail_crc bigint, starts array<int>, bin int, in_bin bigint"
    )
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return written(texts.mapInArrow(run, schema), "tokens")


def combinations(size: int) -> np.ndarray:
    """All multisets of up to three positive numbers with the sum ``size``, as rows (0: unused)."""
    found = [(size, 0, 0)] + [(a, size - a, 0) for a in range(-(-size // 2), size)]
    for a in range(-(-size // 3), size - 1):
        found += [(a, b, size - a - b) for b in range(max(1, -(-(size - a) // 2)), min(a, size - a - 1) + 1)]
    return np.array(found, np.int64)


def nonnegative_least_squares(matrix: np.ndarray, target: np.ndarray, steps: int | None = None) -> np.ndarray:
    """x >= 0 with the least |matrix x - target|, by the active-set method of Lawson and Hanson."""
    right = matrix.T @ target
    x = np.zeros(matrix.shape[1])
    active: list[int] = []
    tolerance = 1e-9 * max(np.abs(right).max(initial=0), 1)
    for _ in range(steps or 3 * matrix.shape[0]):
        gradient = (target - matrix[:, active] @ x[active]) @ matrix
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        active.append(best)
        while True:
            part = matrix[:, active]
            normal = part.T @ part
            normal[np.diag_indices(len(active))] += 1e-9  # repeated combinations of bins stay solvable
            solved = np.linalg.solve(normal, right[active])
            if (solved > 0).all():
                x[active] = solved
                break
            now = x[active]
            falling = solved <= 0
            step = np.min(now[falling] / np.maximum(now[falling] - solved[falling], 1e-300))
            now = now + step * (solved - now)
            now[falling & (now <= 1e-12 * max(now.max(), 1))] = 0
            x[active] = now
            kept = [a for a in active if x[a] > 0]
            if len(kept) == len(active):  # rounding kept it above zero
                drop = active[int(np.argmin(np.where(falling, now, np.inf)))]
                x[drop] = 0
                kept.remove(drop)
            active = kept
            if not active:
                break
    return x


class Plan(NamedTuple):
    """For each bin, runs of consecutive ranks that go to one slot of one combination.

    Run i covers ranks from ``rank[i]`` on; its tails go to sequences from ``sequence[i]`` on and
    take slot ``slot[i]``. ``begin[b]`` is the first run of bin b, ``used[b]`` its used tails.
    """

    begin: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    slot: np.ndarray
    used: np.ndarray
    sequences: int


def plan_combinations(histogram: np.ndarray) -> Plan:
    """How often each combination is used: least squares, rounded down, then greedily filled up."""
    size = len(histogram) - 1
    rows = combinations(size)
    matrix = np.zeros((size + 1, len(rows)))
    for column in rows.T:
        np.add.at(matrix, (column, np.arange(len(rows))), column > 0)
    repeats = np.zeros(len(rows), np.int64)
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    solved = np.floor(nonnegative_least_squares(matrix[1:], histogram[1:].astype(float)) + 1e-6).astype(np.int64)
    for wanted in (solved, None):  # the solution first, then whatever the leftovers still fill
        for p in np.argsort(-solved, kind="stable"):
            if wanted is not None and not wanted[p]:
                continue
            bins, uses = np.unique(rows[p][rows[p] > 0], return_counts=True)
            times = int((left[bins] // uses).min())
            times = times if wanted is None else min(times, int(wanted[p]))
            repeats[p] += times
            left[bins] -= times * uses
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(size + 1)]
    used, sequences = np.zeros(size + 1, np.int64), 0
    for p in np.flatnonzero(repeats):
        for slot, b in enumerate(rows[p][rows[p] > 0]):
            runs[b].append((int(used[b]), sequences, slot))
            used[b] += repeats[p]
        sequences += int(repeats[p])
    flat = np.array([r for own in runs for r in own], np.int64).reshape(-1, 3)
    begin = np.concatenate([[0], np.cumsum([len(own) for own in runs])])
    return Plan(begin, *flat.T, used, sequences)


def place(plan: Plan, bins: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and slot of each tail; sequence -1 where the tail is left over."""
    sequence, slot = np.full(len(bins), -1, np.int64), np.zeros(len(bins), np.int64)
    for b in np.unique(bins):
        own = np.flatnonzero((bins == b) & (rank < plan.used[b]))
        if len(own):
            runs = slice(plan.begin[b], plan.begin[b + 1])
            run = plan.begin[b] + np.searchsorted(plan.rank[runs], rank[own], "right") - 1
            sequence[own] = plan.sequence[run] + rank[own] - plan.rank[run]
            slot[own] = plan.slot[run]
    return sequence, slot


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = 2,
    window: int = 4096,
) -> DataFrame:
    """Pieces of documents with their places: every token id is in exactly one piece.

    ``tokenizer`` is the text of a tokenizer definition whose pre-tokenizer parts words at white
    space. A document's ids are those of its text, then ``end``; a NULL or empty text has ``end``
    alone. Columns: key, start, length, ids_crc32 (of the ids as little-endian unsigned 32-bit
    numbers), doc_tokens, sequence_id, offset. Offsets of a sequence have no gap; a sequence has
    at most ``window`` ids. Repeated rows and rows without a key are packed each; ties in length
    are placed in the order they are read in; other columns are ignored; an empty table has no
    pieces. Lengths and checksums are written to shared storage while the plan is built.
    ``window`` is a multiple of ``BIN``.
    """
    if window % BIN:
        raise ValueError(f"the window must be a multiple of {BIN}")
    spark = docs.sparkSession
    tokens = tokenize(docs, key, text, tokenizer, end, window)

    counts = tokens.filter("bin > 0").groupBy("part", "bin").agg(F.count("*").alias("tails"))
    histogram = np.zeros(window // BIN + 1, np.int64)
    for row in counts.groupBy("bin").agg(F.sum("tails").alias("tails")).collect():  # one row per bin
        histogram[row["bin"]] = row["tails"]
    plan = spark.sparkContext.broadcast(plan_combinations(histogram))
    planned = plan.value.sequences

    earlier = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("part", "bin", F.coalesce(F.sum("tails").over(earlier), F.lit(0)).alias("base"))

    @F.arrow_udf("sequence bigint, slot bigint")
    def find_place(bins: pa.Array, rank: pa.Array) -> pa.Array:
        found = place(plan.value, bins.to_numpy(), rank.to_numpy())
        return pa.StructArray.from_arrays([pa.array(x) for x in found], ["sequence", "slot"])

    tails = (
        tokens.filter("bin > 0")
        .select("row", "part", "key", "n", "tail", "tail_crc", "starts", "bin", "in_bin")
        .join(ranks, ["part", "bin"])
        .withColumn("place", find_place("bin", F.col("base") + F.col("in_bin")))
        .withColumn("starts", F.when(F.col("place.sequence") < 0, F.col("starts")))
        .select("row", "part", "key", "n", "tail", "tail_crc", "starts", "bin", "place.sequence", "place.slot")
    )
    tails = written(tails, "tails")

    # what is left over is laid end to end in cells: totals per part, summed up, give each part its start
    left = tails.filter("sequence < 0")
    cells = F.col("bin").cast("bigint") * BIN
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part_totals = left.groupBy("part").agg(F.sum(cells).alias("total"))
    part_begin = part_totals.select("part", F.coalesce(F.sum("total").over(by_part), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(cells).over(inside), F.lit(0))
    laid = left.withColumn("at", at).join(part_begin, "part").withColumn("at", F.col("at") + F.col("base"))
    laid = laid.withColumn("first", F.least(F.col("tail"), window - F.col("at") % window))

    @F.arrow_udf("bigint")
    def after_cut(whole: pa.Array, start: pa.Array, length: pa.Array) -> pa.Array:
        found = rest_crc(whole.to_numpy(), start.to_numpy() & 0xFFFFFFFF, 4 * length.to_numpy())
        return pa.array(found.astype(np.int64))

    # tails in one piece and both halves of cut ones: how many ids precede, how many they have
    none = F.lit(0).cast("bigint")
    start_crc = F.col("starts")[(F.col("first") / BIN).cast("int") - 1].cast("bigint").bitwiseAND(0xFFFFFFFF)
    whole = F.array(F.struct(none.alias("skip"), F.col("tail").alias("length"), F.col("tail_crc").alias("c")))
    halves = F.array(
        F.struct(none.alias("skip"), F.col("first").alias("length"), F.col("start_crc").alias("c")),
        F.struct(F.col("first").alias("skip"), (F.col("tail") - F.col("first")).alias("length"), F.col("rest_crc").alias("c")),
    )
    shared = ["key", "n", "tail"]
    cut = laid.filter("first < tail").withColumn("start_crc", start_crc)
    cut = cut.withColumn("rest_crc", after_cut("tail_crc", "start_crc", F.col("tail") - F.col("first")))
    cut = cut.select(*shared, "at", halves.alias("pieces"))
    rest = laid.filter("first = tail").select(*shared, "at", whole.alias("pieces")).unionByName(cut)
    rest = rest.select(*shared, "at", F.explode("pieces").alias("p")).select(
        *shared,
        "p.*",
        (planned + F.floor((F.col("at") + F.col("p.skip")) / window)).cast("bigint").alias("sequence"),
        ((F.col("at") + F.col("p.skip")) % window).alias("slot"),
    )
    filled = tails.filter("sequence >= 0").select(
        *shared, none.alias("skip"), F.col("tail").alias("length"), F.col("tail_crc").alias("c"), "sequence", "slot"
    )
    placed = written(filled.unionByName(rest), "placed")
    in_sequence = Window.partitionBy("sequence").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    pieces = placed.select(
        "key",
        (F.col("n") - F.col("tail") + F.col("skip")).alias("start"),
        "length",
        F.col("c").alias("ids_crc32"),
        F.col("n").alias("doc_tokens"),
        F.col("sequence").alias("sequence_id"),
        F.coalesce(F.sum("length").over(in_sequence), F.lit(0)).alias("offset"),
    )

    # full windows are sequences of their own, numbered after all others
    after = (placed.agg(F.max("sequence")).first()[0] or 0) + 1 if planned or histogram.any() else 0
    full_totals = tokens.groupBy("part").agg(F.sum(F.size("full_crc")).alias("total"))
    full_begin = full_totals.select("part", F.coalesce(F.sum("total").over(by_part), F.lit(0)).alias("base"))
    full = (
        tokens.filter(F.size("full_crc") > 0)
        .select("part", "key", "n", "before_full", F.posexplode("full_crc").alias("i", "c"))
        .join(full_begin, "part")
        .select(
            "key",
            (F.col("i").cast("bigint") * window).alias("start"),
            F.lit(window).cast("bigint").alias("length"),
            F.col("c").alias("ids_crc32"),
            F.col("n").alias("doc_tokens"),
            (after + F.col("base") + F.col("before_full") + F.col("i")).cast("bigint").alias("sequence_id"),
            F.lit(0).cast("bigint").alias("offset"),
        )
    )
    return full.unionByName(pieces).withColumnRenamed("key", key)
