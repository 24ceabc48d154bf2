"""Frequent phrases whose words belong together, counted by sorting suffixes.

Every word occurrence is a suffix: the word and up to three that follow it in its piece. Words and
pairs of words that are too rare for any phrase are found first; suffixes end before them. Equal
suffixes of a share of the text are one pointer with a weight. Pointers are routed by their leading word (by two or three words
where the shorter beginning is hot), so all occurrences of a phrase meet in one shard. A shard
sorts its pointers with multikey three-way quicksort, word by word: the weight of an equal
partition is the count of the phrase so far, and a partition whose weight is below the least
count is abandoned, as nothing in it can be frequent.

Words are told apart by 64-bit hashes of their bytes and their language; the words of the phrases
that are returned are read from the texts in a last pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.session import materialize, small_side

from .tables import giving_back, partitions, written
from .words import byte_runs, mix, word_hashes, words_in

RUN_BYTES = 2 << 20  # text taken apart at once
MERGED = 1 << 20  # words or pairs that a task holds before it sends their counts
FILTER_BITS = 25  # the filters of frequent words and pairs have 2^25 bits, 4 MB
SMALL = 2048  # partitions of so many pointers are sorted at once
EVERY = 16  # every so many positions are counted to find hot beginnings (work only)
_SEPARATES = np.zeros(256, bool)
_SEPARATES[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IS_WORD = ~_SEPARATES
_IS_WORD[[0x20, 0x09]] = False
_STEPS = np.random.default_rng(20250301).integers(1, 2**64, 16, dtype=np.uint64) | np.uint64(1)
_WORD, _LANGUAGE, _BEGINNING = 0, 1, 2  # kinds of counted things


def phrase_key(words: np.ndarray) -> np.ndarray:
    """One key per row of word keys; that of a single word is the word's own."""
    if words.shape[1] == 1:
        return words[:, 0]
    with np.errstate(over="ignore"):
        return mix((words * _STEPS[: words.shape[1]]).sum(1, dtype=np.uint64) + np.uint64(words.shape[1]))


class Tokens:
    """Words of a run of texts: keys, language of each, and whether the next is in the same piece."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, languages: np.ndarray) -> None:
        self.words = words_in(raw, offsets, table=_IS_WORD)
        document = self.words.documents()
        self.language = languages[document]
        with np.errstate(over="ignore"):
            self.keys = mix(word_hashes(self.words) + mix(self.language.view(np.uint64)))
        piece = np.cumsum(_SEPARATES[raw])[self.words.starts] if len(raw) else np.zeros(0, np.int64)
        self.linked = np.zeros(len(self.keys), bool)
        self.linked[:-1] = (document[1:] == document[:-1]) & (piece[1:] == piece[:-1])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Where a word is followed by another of its piece, and the keys of these pairs."""
        at = np.flatnonzero(self.linked)
        return at, phrase_key(np.stack([self.keys[at], self.keys[at + 1]], 1))

    def suffixes(self, longest: int, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word keys (0: none) of all suffixes of two words or more, and their languages; a word
        goes on to the next one where ``follows`` says so."""
        at = np.flatnonzero(follows)
        columns = np.zeros((len(at), longest), np.uint64)
        runs = np.ones(len(at), bool)
        for k in range(longest):
            place = np.minimum(at + k, len(self.keys) - 1)
            columns[runs, k] = self.keys[place[runs]]
            runs = runs & follows[place]
        return columns, self.language[at]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    """Tokens of (language, text) batches; a long text is cut behind separators."""
    for batch in batches:
        languages = batch.column(0).to_numpy()
        for row, raw, offsets in byte_runs(batch.column(1), RUN_BYTES, _SEPARATES):
            yield Tokens(raw, offsets, languages[row : row + len(offsets) - 1])


def _word_counts(texts: DataFrame, shards: int, longest: int) -> DataFrame:
    """kind, language, key, n: words, words per language, and beginnings often met at every
    ``EVERY``-th position. A task sends each of them once, or again after ``MERGED`` others."""

    def rows(kind: int, language: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [np.full(len(key), kind, np.int32), language, key.view(np.int64), n]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "language", "key", "n"])

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            keys, first, place = np.unique(np.concatenate([k for k, *_ in held]), return_index=True, return_inverse=True)
            counts = np.bincount(place, np.concatenate([n for *_, n in held])).astype(np.int64)
            return keys, np.concatenate([x for _, x, _ in held])[first], counts

        for tokens in _runs(batches):
            if not len(tokens.keys):
                continue
            keys, first, counts = np.unique(tokens.keys, return_index=True, return_counts=True)
            held.append((keys, tokens.language[first], counts))
            size += len(keys)
            names, counts = np.unique(tokens.language, return_counts=True)
            yield rows(_LANGUAGE, names, names, counts)
            at = np.arange(0, len(tokens.keys), EVERY)
            for k in range(2, longest):
                at = at[at + k <= len(tokens.keys)]
                at = at[tokens.linked[at + k - 2]]
                if not len(at):
                    break
                found, counts = np.unique(phrase_key(tokens.keys[at[:, None] + np.arange(k)]), return_counts=True)
                often = counts * shards * 8 * EVERY > len(tokens.keys)
                yield rows(_BEGINNING, np.zeros(often.sum(), np.int64), found[often], counts[often] * EVERY)
            if size > 2 * MERGED:
                held = [merged()]
                size = len(held[0][0])
                if size > MERGED:
                    yield rows(_WORD, held[0][1], held[0][0], held[0][2])
                    held, size = [], 0
        if held:
            keys, language, counts = merged()
            yield rows(_WORD, language, keys, counts)

    counted = texts.mapInArrow(run, "kind int, language bigint, key bigint, n bigint")
    return counted.groupBy("kind", "language", "key").agg(F.sum("n").alias("n"))


def _bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A filter of 2^``bits`` bits: whether a slot (leading bits of a key) has one of ``keys``.

    Tasks and executors combine bits; at most 2^(bits - 15) rows of 4 KB reach the driver.
    """
    slot = F.shiftrightunsigned("key", 64 - bits)
    rows = (
        keys.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bitmap"))
        .collect()
    )
    width = 32768 // 8
    out = np.zeros(((1 << bits) // 32768 + 2) * width, np.uint8)
    for r in rows:  # the first bucket is 1 for slots from 1 on; slot 0 is in bucket 0's last place
        begin = r["bucket"] * width
        out[begin : begin + width] |= np.frombuffer(r["bitmap"], np.uint8)[:width]
    return out


def _in_bitmap(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
    bucket = np.where(slot > 0, 1 + (slot - 1) // 32768, 0)
    place = np.where(slot > 0, (slot - 1) % 32768, 0) + bucket * 32768
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _shards_of(columns: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """Suffixes go by their leading word; while that beginning is hot, by one word more."""
    route = columns[:, 0].copy()
    rest = np.flatnonzero(_member(route, hot))
    for k in range(2, columns.shape[1] + 1):
        if not len(rest):
            break
        route[rest] = phrase_key(columns[rest, :k])
        rest = rest[_member(route[rest], hot)]
    return (mix(route) % np.uint64(shards)).astype(np.int32)


def _by_shard(routed: DataFrame, shards: int, run: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``run`` on all rows of each shard; shard i is partition i, so that none gets two of them."""

    @giving_back

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            yield from run(pa.Table.from_batches(parts)).to_batches()

    return routed.repartitionById(shards, "shard").mapInArrow(whole, schema)


def _frequent_pairs(texts: DataFrame, shared, shards: int, least: int) -> DataFrame:
    """key, n of the pairs of words that occur ``least`` times or more.

    Only pairs of words that the filter takes for frequent are counted. Every task sends sorted keys
    with counts, cut into the shards' ranges of keys.
    """

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            shard = (keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
            begin = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            ends = np.append(begin[1:], len(keys))
            parts = [[x[a:b].tobytes() for a, b in zip(begin, ends, strict=True)] for x in (keys, counts.astype(np.uint32))]
            columns = [pa.array(shard[begin].astype(np.int32)), *[pa.array(p, pa.binary()) for p in parts]]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "keys", "counts"])

        for tokens in _runs(batches):
            at, keys = tokens.pairs()
            often = _in_bitmap(shared.value, tokens.keys, FILTER_BITS)
            keys = keys[often[at] & often[at + 1]]
            if len(keys):
                held.append(keys)
            if sum(map(len, held)) > MERGED:
                yield packed()
        if held:
            yield packed()

    def add(table: pa.Table) -> pa.Table:
        keys, counts = (np.concatenate([np.frombuffer(x, kind) for x in table.column(k).to_pylist()]) for k, kind in ((1, np.uint64), (2, np.uint32)))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order].astype(np.int64)
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sums = np.add.reduceat(counts, begin)
        return pa.table({"key": pa.array(keys[begin][sums >= least].view(np.int64)), "n": pa.array(sums[sums >= least])})

    routed = texts.mapInArrow(run, "shard int, keys binary, counts binary")
    return _by_shard(routed, shards, add, "key bigint, n bigint")


def _routed(texts: DataFrame, shared, longest: int, shards: int) -> DataFrame:
    """Packed pointers: for a share of the text and a shard the words met, their languages, and
    rows of places in them with weights. A suffix ends before a pair that is not frequent."""

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, hot = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            columns, language = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            _, first, weight = np.unique(phrase_key(columns), return_index=True, return_counts=True)
            columns, language = columns[first], language[first]
            shard = _shards_of(columns, hot, shards)
            order = np.lexsort((columns[:, 0], shard))
            columns, language, weight, shard = columns[order], language[order], weight[order], shard[order]
            begin = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            rows = []
            for low, high in zip(begin, np.append(begin[1:], len(shard)), strict=True):
                words, place = np.unique(columns[low:high], return_inverse=True)
                place = place.reshape(-1, longest)
                names, number = np.unique(language[low:high], return_inverse=True)
                of = np.zeros(len(words), np.uint32)
                of[place[:, 0]] = number + 1  # every leading word has its language
                kind = np.uint16 if len(words) <= 1 << 16 else np.uint32
                rows.append([x.tobytes() for x in (words, names, of, place.T.astype(kind), weight[low:high].astype(np.uint32))])
            arrays = [pa.array(shard[begin])] + [pa.array(x, pa.binary()) for x in zip(*rows, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["shard", "words", "names", "languages", "places", "weights"])

        for tokens in _runs(batches):
            at, keys = tokens.pairs()
            follows = np.zeros(len(tokens.keys), bool)
            follows[at[_in_bitmap(bitmap, keys, FILTER_BITS)]] = True
            if follows.any():
                held.append(tokens.suffixes(longest, follows))
            if sum(len(c) for c, _ in held) > MERGED // 2:
                yield packed()
        if held:
            yield packed()

    return texts.mapInArrow(run, "shard int, words binary, names binary, languages binary, places binary, weights binary")


def frequent_prefixes(columns: np.ndarray, weight: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey quicksort of rows of word numbers (0: none): every prefix of two words or more
    with a weight of ``least`` or more, as one of its rows, its length and its weight."""
    longest = columns.shape[1]
    pointer = np.arange(len(columns))
    keys = np.ascontiguousarray(columns.T)
    found: list[tuple[int, int, int]] = []
    stack = [(0, len(pointer), 0)]
    while stack:
        low, high, depth = stack.pop()
        own = pointer[low:high]
        total = int(weight[own].sum())
        if total < least:
            continue  # abandoned
        key = keys[depth][own]
        if high - low <= SMALL:
            order = np.argsort(key, kind="stable")
            pointer[low:high] = own = own[order]
            key = key[order]
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            end = np.append(begin[1:], len(key))
            counts = np.add.reduceat(weight[own], begin)
            equal = [(low + int(b), low + int(e), int(n)) for b, e, n in zip(begin, end, counts, strict=True) if n >= least and key[b]]
        else:
            few = np.sort(key[:: max(len(key) // 15, 1)])
            pivot = few[len(few) // 2]
            less, same = key < pivot, key == pivot
            parts = own[less], own[same], own[~(less | same)]
            pointer[low:high] = np.concatenate(parts)
            middle, upper = low + len(parts[0]), low + len(parts[0]) + len(parts[1])
            if low < middle:
                stack.append((low, middle, depth))
            if upper < high:
                stack.append((upper, high, depth))
            n = int(weight[parts[1]].sum())
            equal = [(middle, upper, n)] if pivot and n >= least else []
        for begin, end, n in equal:
            if depth:
                found.append((int(pointer[begin]), depth + 1, n))
            if depth + 1 < longest:
                stack.append((begin, end, depth + 1))
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def _phrases_of(table: pa.Table, hot: np.ndarray, least: int, longest: int) -> pa.Table:
    """The frequent phrases of a shard, and the shard's part of the hot beginnings' counts."""
    parts = [[], [], [], []]
    for row in range(table.num_rows):
        words, names, languages, places, weights = (table.column(k)[row].as_py() for k in range(1, 6))
        weight = np.frombuffer(weights, np.uint32).astype(np.int64)
        words = np.frombuffer(words, np.uint64)
        languages = np.concatenate([[0], np.frombuffer(names, np.int64)])[np.frombuffer(languages, np.uint32)]
        place = np.frombuffer(places, np.uint16 if len(words) <= 1 << 16 else np.uint32).reshape(longest, -1)
        parts[0].append(words)
        parts[1].append(languages)
        parts[2].append(place)
        parts[3].append(weight)
    words, first, place = np.unique(np.concatenate(parts[0]), return_index=True, return_inverse=True)
    language = np.zeros(len(words), np.int64)
    of = np.concatenate(parts[1])
    known = of != 0
    language[place[known]] = of[known]
    starts = np.cumsum([0, *map(len, parts[0])])
    # 0 is the smallest key and means no word: put it in front if no suffix was short
    shift = 0 if len(words) and words[0] == 0 else 1
    columns = np.concatenate([(place + shift).astype(np.uint32)[start:][p] for start, p in zip(starts, parts[2], strict=False)], 1).T
    words, language = (np.concatenate([np.zeros(shift, x.dtype), x]) for x in (words, language))
    weight = np.concatenate(parts[3])

    at, length, count = frequent_prefixes(columns, weight, least)
    keys = np.zeros(len(at), np.uint64)
    for k in range(2, longest + 1):
        keys[length == k] = phrase_key(words[columns[at[length == k], :k]])
    whole = ~_member(keys, hot)
    found = [(at[whole], length[whole], count[whole], np.zeros(whole.sum(), bool))]
    for k in range(2, longest if len(hot) else 0):
        rows = np.flatnonzero(columns[:, k - 1])
        key = phrase_key(words[columns[rows, :k]])
        own = _member(key, hot)
        values, first, where = np.unique(key[own], return_index=True, return_inverse=True)
        sums = np.bincount(where, weight[rows[own]], len(values)).astype(np.int64)
        found.append((rows[own][first], np.full(len(values), k), sums, np.ones(len(values), bool)))
    at, length, count, part = (np.concatenate(x) for x in zip(*found, strict=True))
    chosen = words[columns[at]]
    key = np.zeros(len(at), np.uint64)
    lists: dict[str, list] = {name: [[] for _ in range(len(at))] for name in ("words", "lefts", "rights", "inner")}
    for k in range(2, longest + 1):
        own = np.flatnonzero(length == k)
        if not len(own):
            continue
        key[own] = phrase_key(chosen[own, :k])
        inside = [(b, e) for n in range(2, k) for b in range(k - n + 1) for e in [b + n]]
        made = {
            "words": chosen[own, :k],
            "lefts": np.stack([phrase_key(chosen[own, :c]) for c in range(1, k)], 1),
            "rights": np.stack([phrase_key(chosen[own, c:k]) for c in range(1, k)], 1),
            "inner": np.stack([phrase_key(chosen[own, b:e]) for b, e in inside], 1) if inside else np.zeros((len(own), 0), np.uint64),
        }
        for name, values in made.items():
            for i, row in zip(own.tolist(), values.view(np.int64).tolist(), strict=True):
                lists[name][i] = row
    columns = [language[columns[at, 0]], key.view(np.int64), count, part]
    arrays = [pa.array(c) for c in columns] + [pa.array(lists[n], pa.list_(pa.int64())) for n in ("words", "lefts", "rights", "inner")]
    return pa.Table.from_arrays(arrays, names=["language", "key", "a", "part", "words", "lefts", "rights", "inner"])


def _spelled(texts: DataFrame, needed: DataFrame) -> DataFrame:
    """key, word: how the words of ``needed`` (key) are written, from one more pass over the texts."""
    spark = texts.sparkSession
    bits = 22
    shared = spark.sparkContext.broadcast(_bitmap(needed, bits))

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = np.zeros(0, np.uint64)
        for tokens in _runs(batches):
            keys, first = np.unique(tokens.keys, return_index=True)
            new = _in_bitmap(shared.value, keys, bits) & ~_member(keys, sent)
            keys, first = keys[new], first[new]
            if not len(keys):
                continue
            sent = np.union1d(sent, keys) if len(sent) < MERGED else keys
            data, starts, ends = tokens.words.data, tokens.words.starts[first], tokens.words.ends[first]
            words = [data[b:e].tobytes().decode() for b, e in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(words, pa.string())], names=["key", "word"])

    found = texts.mapInArrow(run, "key bigint, word string").join(needed, "key", "left_semi")
    return found.groupBy("key").agg(F.min("word").alias("word"))


def _exact(column: Column, factor: int) -> Column:
    return column.cast("decimal(20,0)") * F.lit(factor).cast("decimal(10,0)")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 30,
    longest: int = 4,
    limit: int = 2000,
    covered: int = 80,
) -> DataFrame:
    """The ``limit`` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line breaks into pieces, these at spaces and
    tabs into words. A candidate has 2 to ``longest`` words and occurs ``least`` times (a) or more;
    cut into two parts that occur l and r times, its score is floor(2000000 a / (l + r)), the lowest
    of its cuts (the first of equal ones). A candidate goes if a longer one around it has ``covered``
    percent of its occurrences or more. Ranks are by score, a (both descending) and phrase; n is the
    number of words of the language. A NULL language is ``und``; NULL and empty texts have no
    words. Repeated rows count each time; no column but the two is read; an empty table gives no rows.
    ``least`` is at least 2. Counts are exact; arithmetic beyond 64 bits is decimal. A text is
    handled in runs of bounded size, cut behind separators. Several jobs run while the plan is
    built.
    """
    spark = docs.sparkSession
    shards = partitions(spark)
    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    texts = named.filter(F.length("text") > 0).select(F.xxhash64("lang").alias("language"), "text")
    languages = named.select("lang").distinct().select("lang", F.xxhash64("lang").alias("language"))

    counted = materialize(_word_counts(texts, shards, longest).filter((F.col("n") >= least) | (F.col("kind") != _WORD)), "words")
    words = counted.filter(F.col("kind") == _WORD).select("key", F.col("n").alias("f"))
    totals = counted.filter(F.col("kind") == _LANGUAGE).select("language", "n")
    total = totals.agg(F.sum("n")).first()[0] or 0
    # of beginnings that take more than a quarter of a shard there are at most 4 per shard and length
    hot = counted.filter((F.col("kind") != _LANGUAGE) & (F.col("n") * 4 * shards > total)).select("key").collect()
    hot = np.sort(np.array([r["key"] for r in hot], np.int64).view(np.uint64))
    filter_ = spark.sparkContext.broadcast(_bitmap(words, FILTER_BITS))
    pairs = materialize(_frequent_pairs(texts, filter_, shards, least), "pairs")
    shared = spark.sparkContext.broadcast((_bitmap(pairs, FILTER_BITS), hot))

    def sort(table: pa.Table) -> pa.Table:
        return _phrases_of(table, shared.value[1], least, longest)

    schema = (
        "language bigint, key bigint, a bigint, part boolean, words array<bigint>, lefts array<bigint>, "
        "rights array<bigint>, inner array<bigint>"
    )
    sorted_ = written(_by_shard(_routed(texts, shared, longest, shards), shards, sort, schema), "phrases")
    split = (
        sorted_.filter("part")
        .groupBy("key")
        .agg(F.sum("a").alias("a"), *[F.first(c).alias(c) for c in ("language", "words", "lefts", "rights", "inner")])
        .filter(F.col("a") >= least)
    )
    phrases = sorted_.filter("NOT part").drop("part").unionByName(split)

    counts = words.unionByName(phrases.select("key", F.col("a").alias("f")))
    cuts = phrases.select("key", "a", F.posexplode(F.arrays_zip("lefts", "rights")).alias("k", "cut"))
    cuts = cuts.select("key", "a", "k", F.col("cut.lefts").alias("left"), F.col("cut.rights").alias("right"))
    cuts = cuts.join(counts.select(F.col("key").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("key").alias("right"), F.col("f").alias("r")), "right")
    both = F.col("l").cast("decimal(20,0)") + F.col("r")
    score = F.call_function("div", _exact(F.col("a"), 2_000_000), both)
    lowest = cuts.groupBy("key").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    around = phrases.select(F.explode("inner").alias("key"), "a").groupBy("key").agg(F.max("a").alias("around"))
    kept = phrases.join(around, "key", "left").filter(
        F.col("around").isNull() | (_exact(F.col("around"), 100) < _exact(F.col("a"), covered))
    )
    scored = kept.join(lowest, "key").select("language", "key", "words", "a", "cut.l", "cut.r", "cut.score")
    # ties at the border stay until the phrases are spelled out
    window = Window.partitionBy("language").orderBy(F.col("score").desc(), F.col("a").desc())
    scored = scored.withColumn("_rank", F.rank().over(window)).filter(F.col("_rank") <= limit).drop("_rank")
    best = materialize(scored, "best")

    places = best.select(F.col("key").alias("phrase_key"), F.posexplode("words").alias("k", "key"))
    spelled = places.join(_spelled(texts, places.select("key").distinct()), "key")
    spelled = spelled.groupBy(F.col("phrase_key").alias("key")).agg(F.sort_array(F.collect_list(F.struct("k", "word"))).alias("w"))
    result = best.join(spelled, "key").withColumn("phrase", F.array_join(F.col("w.word"), " "))
    window = Window.partitionBy("language").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    result = result.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= limit)
    result = result.join(small_side(languages.join(totals, "language")), "language")
    return result.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
