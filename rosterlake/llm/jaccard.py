"""Similarity join of word shingle sets by prefix filters under several global orders.

Two sets with a Jaccard similarity of at least t can not differ in the first
n - ceil(t n) + 1 members of each under any common order of all shingles: their prefixes share a
member. Here several orders are used. All put rare shingles first, and shingles of like
frequency in an order of their own. Documents are candidates only if their prefixes meet under
every order; candidates are verified on the whole sets.

Equal sets are one class from the start. The classes that share a prefix shingle form a bucket.
What is asked for is which classes hang together, so a class is first compared with the nearest of
a few others of its bucket, and pairs are made only of classes that are not yet known to be
connected. A large bucket is dealt over rows of bounded size: each of them meets the few, and in
the end the rows meet pair by pair. Before whole sets are fetched, sizes and parity bitmaps rule pairs out: a bitmap has a
bit for every hash slot, flipped by each member, so two bitmaps differ in no more bits than the
sets differ in members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.session import materialize, small_side

from .components import connected_components
from .tables import giving_back, partitions
from .words import distinct_by_document, find_words, mix, shingles, slices, text_bytes

ORDERS = (np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3))
RARE = 4  # shingles in fewer documents are of one frequency
RANKED = 1 << 18  # frequent shingles whose frequency all tasks know; it only shapes the orders
HELD = 1 << 20  # shingles that a task gathers before it hands them on
SLOTS = 2048  # bits of a parity bitmap
PIVOTS = 64  # classes of a bucket that the others are first compared with
PART = 2048  # classes of a bucket in one row; a larger bucket covers several rows
PAIRS = 1 << 26  # pairs of unconnected classes whose bitmaps are compared without further rounds
PER_ENTRY = 256  # or so many for each entry of a bucket
TESTED = 1 << 16  # pairs of bitmaps compared at once


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, size: int, kind: type) -> np.ndarray:
    raw = pa.decompress(blob, decompressed_size=size * np.dtype(kind).itemsize, codec="zstd", asbytes=True)
    return np.frombuffer(raw, kind)


def _places(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(32)).astype(np.uint32)


def frequent_shingles(texts: DataFrame, n: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (upper half of the hash) in at least ``RARE`` documents, with log2 of the count.

    All documents are counted. Each task counts in turns of bounded size and sends sorted,
    compressed places; if more than ``RANKED`` are frequent, those of the lowest powers of two
    are left out, which makes the orders coarser and changes no result.
    """

    @giving_back

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            place, times = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            ends = np.searchsorted(place, (np.arange(1, shards) << 32) // shards)
            rows = []
            for s, (p, t) in enumerate(zip(np.split(place, ends), np.split(times, ends), strict=True)):
                if len(p):
                    steps = np.diff(p, prepend=np.uint32(0)).astype(np.uint32)
                    rows.append((s, len(p), _pack(steps), _pack(t.astype(np.uint32))))
            return pa.RecordBatch.from_pydict(dict(zip(("shard", "size", "steps", "times"), zip(*rows, strict=True), strict=True)))

        for batch in slices(batches, "text"):
            held.append(_places(distinct_by_document(*shingles(find_words(batch.column(0)), n))[0]))
            if sum(map(len, held)) >= HELD:
                yield flush()
        if sum(map(len, held)):
            yield flush()

    @giving_back

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, times = [], []
        for batch in batches:
            for row in batch.to_pylist():
                places.append(np.cumsum(_unpack(row["steps"], row["size"], np.uint32), dtype=np.uint64))
                times.append(_unpack(row["times"], row["size"], np.uint32))
        if places:
            place, times = np.concatenate(places), np.concatenate(times).astype(np.int64)
            order = np.argsort(place, kind="stable")
            place, times = place[order], times[order]
            first = np.flatnonzero(np.diff(place, prepend=np.uint64(2**64 - 1)) != 0)
            sums = np.add.reduceat(times, first)
            kept = sums >= RARE
            power = np.floor(np.log2(sums[kept])).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place[first][kept].astype(np.int64)), pa.array(power)], names=["place", "power"])

    counted = texts.mapInArrow(count, "shard bigint, size bigint, steps binary, times binary")
    counted = counted.repartition("shard").mapInArrow(total, "place bigint, power int")
    counted = materialize(counted, "frequent")
    sizes = {r["power"]: r["count"] for r in counted.groupBy("power").count().collect()}
    least, size = 64, 0
    for power in sorted(sizes, reverse=True):
        if size + sizes[power] > RANKED:
            break
        least, size = power, size + sizes[power]
    table = counted.filter(F.col("power") >= least).toArrow()
    place, power = table.column("place").to_numpy().astype(np.uint32), table.column("power").to_numpy()
    order = np.argsort(place)
    return place[order], power[order].astype(np.uint64)


def prefix_size(sizes: np.ndarray, percent: int) -> np.ndarray:
    return np.where(sizes > 0, sizes - (sizes * percent + 99) // 100 + 1, 0)


def _class_of(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each document's set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ ORDERS[0] ^ ORDERS[1]), dtype=np.uint64)])
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def parity_bitmaps(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each document a row of bytes, of which every member has flipped one bit."""
    document = np.repeat(np.arange(len(first) - 1), np.diff(first))
    slot = (mix(values) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(document * SLOTS + slot, minlength=(len(first) - 1) * SLOTS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, SLOTS), axis=1)


def shingle_classes(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """key, text_hash, n_shingles, class, bitmap (NULL for documents without words), written once."""

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, first = distinct_by_document(*shingles(find_words(batch.column(2)), n))
            size = np.diff(first)
            bitmaps = [row.tobytes() if k else None for row, k in zip(parity_bitmaps(values, first), size)]
            columns = [pa.array(size), pa.array(_class_of(values, first), mask=size == 0), pa.array(bitmaps, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], names=["key", "text_hash", "n_shingles", "class", "bitmap"]
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    schema = f"key {kind}, text_hash bigint, n_shingles bigint, class bigint, bitmap binary"
    return materialize(rows.mapInArrow(run, schema), "classes")


def prefix_buckets(texts: DataFrame, n: int, percent: int, shards: int, part: int = PART) -> DataFrame:
    """bucket, part, parts, orders (bits), classes: classes that share a prefix shingle, two at least.

    A task hands prefix shingles on in rows of packed arrays, one per shard of the shingles.
    Buckets with the same classes, of which ``bucket`` is a hash, are one, with all their orders. A
    bucket's sorted classes are cut into ``parts`` rows of at most ``part``. Written once.
    """
    place, power = frequent_shingles(texts, n, shards)
    shared = texts.sparkSession.sparkContext.broadcast((place, power))

    @giving_back

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, power = shared.value
        held: list[tuple[np.ndarray, np.ndarray, int]] = []

        def flush() -> pa.RecordBatch:
            token = np.concatenate([t for t, _, _ in held])
            owner = np.concatenate([c for _, c, _ in held])
            order = np.repeat(np.array([o for *_, o in held], np.uint8), [len(t) for t, _, _ in held])
            held.clear()
            shard = ((token >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
            by = np.lexsort((owner, order, shard))
            ends = np.searchsorted(shard[by], np.arange(1, shards))
            rows = []
            for s, own in enumerate(np.split(by, ends)):
                if len(own):
                    new = np.flatnonzero(np.diff(owner[own], prepend=~owner[own[0]]) | np.diff(order[own], prepend=order[own[0]]))
                    run = np.diff(np.append(new, len(own))).astype(np.uint32)
                    columns = (token[own].astype(np.uint32), run, owner[own][new], order[own][new])
                    rows.append((s, *(c.tobytes() for c in columns)))
            names = ("shard", "tokens", "runs", "classes", "orders")
            return pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=True)))

        for batch in slices(batches, "text"):
            values, first = distinct_by_document(*shingles(find_words(batch.column(0)), n))
            size, owner = np.diff(first), _class_of(values, first)
            known = np.unique(owner, return_index=True)[1]  # one of equal sets
            once = np.zeros(len(size), bool)
            once[known] = True
            document = np.repeat(np.arange(len(size)), size)
            frequency = np.zeros(len(values), np.uint64)
            if len(place):
                at = np.minimum(np.searchsorted(place, _places(values)), len(place) - 1)
                frequency = np.where(place[at] == _places(values), power[at], 0).astype(np.uint64)
            wanted = np.where(once, prefix_size(size, percent), 0)
            for o, seed in enumerate(ORDERS):
                rank = (frequency << np.uint64(58)) | (mix(values ^ seed) >> np.uint64(6))
                chosen = [
                    begin + np.argpartition(rank[begin:end], count - 1)[:count]
                    for begin, end, count in zip(first[:-1].tolist(), first[1:].tolist(), wanted.tolist(), strict=True)
                    if count
                ]
                chosen = np.concatenate([np.zeros(0, np.int64), *chosen])
                held.append((mix(values[chosen]), owner[document[chosen]], o))
            if sum(len(t) for t, _, _ in held) >= HELD:
                yield flush()
        if sum(len(t) for t, _, _ in held):
            yield flush()

    @giving_back

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners = [], []
        for batch in batches:
            for row in batch.to_pylist():
                run = np.frombuffer(row["runs"], np.uint32)
                order = np.repeat(np.frombuffer(row["orders"], np.uint8), run).astype(np.uint64)
                low = np.frombuffer(row["tokens"], np.uint32).astype(np.uint64)
                # shards are few and orders are two, so both fit beside the token
                tokens.append(low | (order << np.uint64(63)) | (np.uint64(row["shard"]) << np.uint64(32)))
                owners.append(np.repeat(np.frombuffer(row["classes"], np.int64), run))
        if not tokens:
            return
        token, owner = np.concatenate(tokens), np.concatenate(owners)
        tokens.clear()
        owners.clear()
        by = np.lexsort((owner, token))
        token, owner = token[by], owner[by]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        token, owner = token[new], owner[new]
        first = np.flatnonzero(np.diff(token, prepend=~token[:1]) != 0)
        size = np.diff(np.append(first, len(token)))
        many = size > 1
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(owner.view(np.uint64)), dtype=np.uint64)])
        same = mix(sums[first + size] - sums[first] + size.astype(np.uint64))[many]
        first, size = first[many], size[many]
        bits = np.uint8(1) << (token[first] >> np.uint64(63)).astype(np.uint8)
        _, kept, inverse = np.unique(same, return_index=True, return_inverse=True)
        flags = np.zeros(len(kept), np.uint8)
        np.bitwise_or.at(flags, inverse, bits)
        first, size, same = first[kept], size[kept], same[kept]
        parts = -(-size // part)
        of = np.repeat(np.arange(len(kept)), parts)
        number = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = first[of] + number * part
        lengths = np.minimum(size[of] - number * part, part)
        for at in range(0, len(of), 1 << 14):
            own = slice(at, at + (1 << 14))
            index = np.arange(lengths[own].sum()) + np.repeat(begin[own] - np.cumsum(lengths[own]) + lengths[own], lengths[own])
            offsets = np.concatenate([[0], np.cumsum(lengths[own])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(owner[index]))
            columns = [same[of[own]].view(np.int64), number[own].astype(np.int32), parts[of[own]].astype(np.int32), flags[of[own]].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), lists], names=["bucket", "part", "parts", "orders", "classes"])

    schema = "shard bigint, tokens binary, runs binary, classes binary, orders binary"
    dealt = texts.mapInArrow(prefixes, schema).repartition("shard")
    met = dealt.mapInArrow(meet, "bucket bigint, part int, parts int, orders int, classes array<bigint>")
    met = met.groupBy("bucket", "part", "parts").agg(F.bit_or("orders").alias("orders"), F.first("classes").alias("classes"))
    return materialize(met, "buckets")


def verified(pairs: DataFrame, docs: DataFrame, text: str, known: DataFrame, percent: int, n: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough, counted on the whole sets.

    The sets are made anew from one text of each class. Written once.
    """

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, first = distinct_by_document(*shingles(find_words(batch.column(0)), n))
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(_class_of(values, first)), lists], names=["class", "members"])

    pairs = materialize(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    hashes = small_side(known.join(wanted, "class", "left_semi").select("text_hash"))
    texts = docs.select(F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    picked = texts.join(hashes, "text_hash", "left_semi").dropDuplicates(["text_hash"])
    sets = materialize(picked.select("text").mapInArrow(run, "class bigint, members array<bigint>"), "sets")

    left = sets.select(F.col("class").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("members").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    similar = pairs.join(left, "a").join(right, "b").filter(100 * shared >= percent * union)
    return materialize(similar.select("a", "b"), "similar")


class Members:
    """The classes of many buckets, those of a bucket next to each other, with their bitmaps."""

    def __init__(self, buckets: pa.Array, orders: np.ndarray, percent: int) -> None:
        ends = buckets.offsets.to_numpy().astype(np.int64)
        rows = buckets.values
        self.classes, self.roots, self.sizes = (
            rows.field(name).to_numpy(zero_copy_only=False)[ends[0] : ends[-1]] for name in ("class", "root", "n")
        )
        raw, where = text_bytes(rows.field("bitmap").slice(ends[0], ends[-1] - ends[0]))
        self.bits = raw.reshape(-1, SLOTS // 8).view(np.uint64) if len(where) > 1 else np.zeros((0, 1), np.uint64)
        self.counts = np.diff(ends)
        self.starts = ends[:-1] - ends[0]
        self.bucket = np.repeat(np.arange(len(self.counts)), self.counts)
        self.orders, self.percent = orders, percent

    def differences(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Differing bits of pairs of different roots, -1 where the sets can not be similar."""
        out = np.full(len(i), -1)
        both, least = self.sizes[i] + self.sizes[j], np.minimum(self.sizes[i], self.sizes[j])
        near = np.flatnonzero((100 * least >= self.percent * (both - least)) & (self.roots[i] != self.roots[j]))
        for at in range(0, len(near), TESTED):
            own = near[at : at + TESTED]
            differ = np.bitwise_count(self.bits[i[own]] ^ self.bits[j[own]]).sum(1, dtype=np.int64)
            fits = (100 + self.percent) * differ <= (100 - self.percent) * both[own]
            out[own[fits]] = differ[fits]
        return out

    def _sorted(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members by bucket and key, and the place of each within its bucket."""
        return np.lexsort((key, self.bucket)), np.arange(len(key)) - np.repeat(self.starts, self.counts)

    def nearest(self, turn: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each class the nearest of some pivots of its bucket, others in each turn.

        A pivot is compared with earlier pivots only, so that two do not just name each other.
        """
        by, place = self._sorted(mix(self.classes.view(np.uint64) + np.uint64(turn)))
        found, best = np.full(len(by), -1), np.full(len(by), SLOTS + 1)
        for r in range(PIVOTS):
            later = np.flatnonzero(place > r)
            if not len(later):
                break
            pivot = by[later - place[later] + r]
            differ = self.differences(by[later], pivot)
            closer = (differ >= 0) & (differ < best[later])
            found[later[closer]], best[later[closer]] = pivot[closer], differ[closer]
        own = np.flatnonzero(found >= 0)
        yield by[own], found[own]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of classes of a bucket that may be similar."""
        by, place = self._sorted(self.sizes)
        rest = self.counts[self.bucket] - place  # members from here to the bucket's end
        live, step = np.arange(len(by)), 1
        while len(live):
            live = live[rest[live] > step]
            # sizes rise: once one is too large for a class, all that follow are
            i, j = by[live], by[live + step]
            small_enough = self.percent * self.sizes[j] <= 100 * self.sizes[i]
            live, i, j = live[small_enough], i[small_enough], j[small_enough]
            fits = self.differences(i, j) >= 0
            yield i[fits], j[fits]
            step += 1


def nearest_pivots(part: pa.ListArray, pivots: pa.ListArray, orders: int, percent: int, turn: int) -> tuple[pa.Array, pa.Array]:
    """For each class of a part of a bucket the nearest of the bucket's pivots, as pairs of classes."""
    own = len(part.values)
    both = pa.ListArray.from_arrays(pa.array([0, own + len(pivots.values)], pa.int32()), pa.concat_arrays([part.values, pivots.values]))
    members = Members(both, np.array([orders]), percent)
    rank = np.full(own, PIVOTS)  # of the part's own pivots, which meet earlier ones only
    order = own + np.argsort(mix(members.classes[own:].view(np.uint64) + np.uint64(turn)), kind="stable")[:PIVOTS]
    place = {c: r for r, c in enumerate(members.classes[order].tolist())}
    for i in np.flatnonzero(np.isin(members.classes[:own], members.classes[order])):
        rank[i] = place[int(members.classes[i])]
    found, best = np.full(own, -1), np.full(own, SLOTS + 1)
    for r, pivot in enumerate(order):
        i = np.flatnonzero(rank > r)
        differ = members.differences(i, np.full(len(i), pivot))
        closer = (differ >= 0) & (differ < best[i])
        found[i[closer]], best[i[closer]] = pivot, differ[closer]
    i = np.flatnonzero(found >= 0)
    return members.classes[i], members.classes[found[i]]


def crossing_pairs(left: pa.ListArray, right: pa.ListArray, orders: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a class of one part of a bucket and a class of another that may be similar."""
    own = len(left.values)
    both = pa.ListArray.from_arrays(pa.array([0, own + len(right.values)], pa.int32()), pa.concat_arrays([left.values, right.values]))
    members = Members(both, np.array([orders]), percent)
    step = max(TESTED // max(own, 1), 1)
    for at in range(own, len(members.classes), step):
        others = np.arange(at, min(at + step, len(members.classes)))
        i, j = np.tile(np.arange(own), len(others)), np.repeat(others, own)
        fits = members.differences(i, j) >= 0
        yield members.classes[i[fits]], members.classes[j[fits]]


def bucket_pairs(rooted: DataFrame, percent: int, turn: int | None) -> DataFrame:
    """a < b, orders: pairs from each bucket that meet under every order, those with the nearest
    pivot of the ``turn``, or all.

    ``rooted`` has bucket, part, parts, orders, m (classes of the bucket now), class, root, n, bitmap.
    Buckets of one part stay in their row. The parts of others are joined to the bucket's pivots, a
    bounded number of its classes with small hashes, or to each other, two parts to a row.
    """
    sending = ["a", "b", "orders"]

    def rows(a: np.ndarray, b: np.ndarray, orders: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (np.minimum(a, b), np.maximum(a, b), orders)], names=sending)

    @giving_back
    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders = batch.column(0).to_numpy()
            members = Members(batch.column(1), orders, percent)
            for i, j in members.nearest(turn) if turn is not None else members.pairs():
                if len(i):
                    yield rows(members.classes[i], members.classes[j], orders[members.bucket[i]])

    @giving_back
    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                orders, left, right = batch.column(0)[r].as_py(), batch.column(1).slice(r, 1), batch.column(2).slice(r, 1)
                left, right = (pa.ListArray.from_arrays(pa.array([0, len(x.flatten())], pa.int32()), x.flatten()) for x in (left, right))
                made = crossing_pairs(left, right, orders, percent) if turn is None else [nearest_pivots(left, right, orders, percent, turn)]
                for a, b in made:
                    if len(a):
                        yield rows(a, b, np.full(len(a), orders, np.int32))

    schema, every = "a bigint, b bigint, orders int", (1 << len(ORDERS)) - 1
    entry = F.struct("class", "root", "n", "bitmap")
    parts = rooted.groupBy("bucket", "part", "parts", "orders").agg(F.collect_list(entry).alias("members"))
    one = parts.filter("parts = 1") if turn is not None else parts  # all pairs: also those within each part
    pairs = one.select("orders", "members").mapInArrow(alone, schema)
    many = parts.filter("parts > 1")
    if turn is not None:
        # about twice as many as are needed, so that there are enough
        share = F.least(F.lit(1.0), F.lit(2.0 * PIVOTS) / F.col("m"))
        small = F.shiftrightunsigned(F.xxhash64("class", F.lit(turn)), 34).cast("double") < share * float(1 << 30)
        pivots = rooted.filter((F.col("parts") > 1) & small).groupBy("bucket").agg(F.collect_list(entry).alias("others"))
        met = many.join(pivots, "bucket").select("orders", "members", "others")
    else:
        later = F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1))
        waiting = many.filter("part + 1 < parts").select("bucket", "orders", "members", later.alias("part"))
        met = waiting.join(many.select("bucket", "part", F.col("members").alias("others")), ["bucket", "part"])
        met = met.select("orders", "members", "others")
    pairs = pairs.unionByName(met.mapInArrow(together, schema))
    pairs = pairs.groupBy("a", "b").agg(F.bit_or("orders").alias("orders"))
    return pairs.filter(F.col("orders") == every).select("a", "b")


def _rerooted(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """node, root after further links (a, b), which are first taken to the roots known so far."""
    if roots is None:
        return materialize(connected_components(links), "roots")
    for end in ("a", "b"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
        links = links.join(known, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    found = small_side(connected_components(links))
    moved = roots.join(found.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left")
    moved = moved.select("node", F.coalesce("_to", "root").alias("root"))
    new = found.join(roots.select("node"), "node", "left_anti")
    return materialize(moved.unionByName(new.select("node", "root")), "roots")


def class_components(
    buckets: DataFrame, known: DataFrame, docs: DataFrame, text: str, percent: int, n: int
) -> DataFrame:
    """node, root: which classes are connected by similar pairs (classes without a link are absent).

    In turns, every class is compared with the nearest pivot of its buckets, until pairs of
    unconnected classes in a bucket are few or no link is found. Then all these are compared. The
    links of a turn join what earlier turns have connected.
    """
    entries = buckets.select("bucket", "part", "parts", "orders", F.explode("classes").alias("class"))
    signed = materialize(entries.join(known.select("class", "n", "bitmap"), "class"), "entries")
    # at first nothing is connected; m is only asked for in buckets of several parts
    rooted = signed.withColumn("root", F.col("class")).withColumn("m", F.col("parts").cast("double") * PART)
    roots, turn, last = None, 0, False
    while True:
        found = verified(bucket_pairs(rooted, percent, None if last else turn), docs, text, known, percent, n)
        gained = not found.isEmpty()
        if gained or roots is None:
            roots = _rerooted(roots, found)
        if last:
            return roots
        rooted = signed.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
            "root", F.coalesce("root", "class")
        )
        counts = rooted.groupBy("bucket", "root").agg(F.count("*").cast("double").alias("c"))
        sums = counts.groupBy("bucket").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("s"))
        sums = materialize(sums.filter("m * m > s"), "sums")
        total, size = sums.agg(F.sum(F.col("m") * F.col("m") - F.col("s")), F.sum("m")).first()
        if not total:
            return roots
        rooted = rooted.join(sums.select("bucket", "m"), "bucket")
        last = total <= max(PAIRS, PER_ENTRY * size) or not gained
        turn += 1


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, n: int = 5, part: int = PART
) -> DataFrame:
    """key, n_shingles, component_id: which documents hang together by similar shingle sets.

    A document's set holds its distinct runs of ``n`` lower-cased (A-Z) words, or its whole
    sequence if it is shorter. Two documents are linked when 100 * shared >= percent * union;
    component_id is the smallest key that is reachable by links. NULL and empty texts have no
    shingle, no link, and their own key. Repeated rows stay and are linked with each other; rows
    without a key take part, and a component of them alone has a NULL id. Other columns are
    ignored, an empty table gives no rows. No row holds more than ``part`` sets of a bucket. All steps are written to shared storage while the plan
    is built.
    """
    spark = docs.sparkSession
    shards = 4 * partitions(spark)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    classes = shingle_classes(rows, "key", "text", n)
    buckets = prefix_buckets(rows.select("text"), n, percent, shards, part)
    known = classes.filter("class is not null").groupBy("class").agg(
        F.min("text_hash").alias("text_hash"),
        F.min("key").alias("least"),
        F.min("n_shingles").alias("n"),
        F.min("bitmap").alias("bitmap"),
    )
    known = materialize(known, "known")
    roots = class_components(buckets, known, rows, "text", percent, n)

    rooted = known.join(roots, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    rooted = materialize(rooted.select("class", "root", "least"), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = rooted.join(smallest, "root").select(F.col("class").alias("own"), "component_id")
    joined = classes.join(by_class, F.col("class") == F.col("own"), "left")
    found = F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select(F.col("key").alias(key), "n_shingles", found.alias("component_id"))
