"""Quality scores from supervised subword embeddings.

A document is a bag of hashed features: words, word pairs, byte n-grams, and a mark for each word
pair that the document has had before. Every bucket has a
learned vector; a document is the mean of its feature vectors and a softmax layer gives its
label. Vectors and layer are trained by stochastic gradient descent in numpy on a sample of
labelled documents of bounded size. As the layer is linear, scoring needs one number per bucket:
the vector's part in the difference of the two classes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import giving_back, kept
from .words import IS_WORD, byte_runs, find_words, slices, word_hashes, words_in

BUCKETS = 1 << 18
RUN_BYTES = 256 << 10  # text scored at once
PAIR_BITS = 24  # word pairs of a text of several runs are remembered in 2^24 bits
REPEATED = 0  # the bucket of the mark for repeated word pairs
_GRAM = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def repeated(values: np.ndarray, document: np.ndarray) -> np.ndarray:
    """The document of each value but the first of its kind there."""
    order = np.lexsort((values, document))
    values, document = values[order], document[order]
    return document[1:][(values[1:] == values[:-1]) & (document[1:] == document[:-1])]


def features(texts: pa.Array, sizes: tuple[int, ...] = (3, 4)) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of a string column and the document of each feature."""
    words = find_words(texts, lower=False)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    hashes, document = word_hashes(words), words.documents()
    with np.errstate(over="ignore"):
        paired = document[1:] == document[:-1]
        pairs = ((hashes[:-1] * _PAIR + hashes[1:]) * _PAIR)[paired]
        again = repeated(pairs, document[1:][paired])
        found = [(hashes * _PAIR) >> shift, pairs >> shift, np.full(len(again), REPEATED, np.uint64)]
        owner = [document, document[1:][paired], again]
        plain = np.where(IS_WORD[words.data], words.data, 32).astype(np.uint32)
        byte_owner = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
        for size in sizes:
            count = max(len(plain) - size + 1, 0)
            grams = np.full(count, size, np.uint32)
            for k in range(size):
                grams = (grams + plain[k : k + count]) * _GRAM[k]
                grams ^= grams >> np.uint32(15)
            inside = byte_owner[:count] == byte_owner[size - 1 : size - 1 + count]
            found.append((grams * _GRAM[0] >> np.uint32(33 - BUCKETS.bit_length()))[inside])
            owner.append(byte_owner[:count][inside])
    return np.concatenate(found).astype(np.int64), np.concatenate(owner)


def part_features(raw: np.ndarray, offsets: np.ndarray, lead: int, sizes: tuple[int, ...] = (3, 4)) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Kind after kind, buckets and text of each feature, but for marks of repeated pairs.

    The first ``lead`` bytes are the end of an earlier part of the same text: features that lie
    in them wholly are left out. The pairs, as 64-bit values, come last.
    """
    words = words_in(raw, offsets, lower=False)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    hashes, document = word_hashes(words), words.documents().astype(np.int32)
    fresh = words.starts >= lead
    with np.errstate(over="ignore"):
        yield ((hashes[fresh] * _PAIR) >> shift).astype(np.int32), document[fresh]
        plain = np.where(IS_WORD[words.data], words.data, 32).astype(np.uint32)
        byte_owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        for size in sizes:
            count = max(len(plain) - size + 1, 0)
            grams = np.full(count, size, np.uint32)
            for k in range(size):
                grams = (grams + plain[k : k + count]) * _GRAM[k]
                grams ^= grams >> np.uint32(15)
            inside = byte_owner[:count] == byte_owner[size - 1 : size - 1 + count]
            inside[: max(lead - size + 1, 0)] = False
            yield (grams * _GRAM[0] >> np.uint32(33 - BUCKETS.bit_length()))[inside].astype(np.int32), byte_owner[:count][inside]
        paired = (document[1:] == document[:-1]) & fresh[1:]
        pairs = ((hashes[:-1] * _PAIR + hashes[1:]) * _PAIR)[paired]
        yield (pairs >> shift).astype(np.int32), document[1:][paired]
        yield pairs, document[1:][paired]


class Model(NamedTuple):
    """Per bucket the weight of label 1 against label 0, and what a text without features has."""

    weight: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        """Scores of whole texts, taken apart in runs of ``RUN_BYTES``.

        Of a text that is longer, parts overlap by a word, so that every feature is met once. Its
        pairs are remembered in a bitmap of ``PAIR_BITS`` bits, whose rare collisions count as
        repeated pairs: memory does not depend on the length of a text.
        """
        sums, counts = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        before, tail, seen = -1, np.zeros(0, np.uint8), None
        for row, raw, offsets in byte_runs(texts, RUN_BYTES, ~IS_WORD):
            lead = 0
            if row == before:  # the next part of a long text
                lead, raw = len(tail), np.concatenate([tail, raw])
                offsets = np.array([0, len(raw)])
            elif len(raw) > RUN_BYTES // 2 and len(offsets) == 2:
                seen = np.zeros(1 << PAIR_BITS - 3, np.uint8)
            else:
                seen = None
            texts_here = slice(row, row + len(offsets) - 1)
            *kinds, (pairs, owner) = part_features(raw, offsets, lead)
            for bucket, of in kinds:
                sums[texts_here] += np.bincount(of, self.weight[bucket], len(offsets) - 1)
                counts[texts_here] += np.bincount(of, minlength=len(offsets) - 1)
            again = np.bincount(repeated(pairs, owner), minlength=len(offsets) - 1)
            if seen is not None:
                slot = np.unique(pairs) >> np.uint64(64 - PAIR_BITS)
                bit = np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8)
                at = (slot >> np.uint64(3)).astype(np.int64)
                again = again + int((seen[at] & bit != 0).sum())
                np.bitwise_or.at(seen, at, bit)
            sums[texts_here] += again * float(self.weight[REPEATED])
            counts[texts_here] += again
            before, tail = row + len(offsets) - 2, _tail(raw)
        return 1 / (1 + np.exp(-np.clip(sums / np.maximum(counts, 1) + self.bias, -60, 60)))


def _tail(raw: np.ndarray) -> np.ndarray:
    """The last word, what follows it, and three bytes at least."""
    last = len(raw)
    while last and not IS_WORD[raw[last - 1]]:
        last -= 1
    found = np.flatnonzero(~IS_WORD[raw[:last]])
    begin = int(found[-1]) + 1 if len(found) else 0
    return raw[max(min(begin, len(raw) - 3), 0) :].copy()


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 8, steps: int = 16_000, rate: float = 0.5) -> Model:
    """``steps`` of gradient descent over (buckets, counts, label) rows, in fixed random orders.

    Without rows of both labels the score is that of the label found, or 0.5 without any.
    """
    share = np.mean([label for *_, label in rows]) if rows else 0.5
    if share in (0, 1) or not rows:
        return Model(np.zeros(BUCKETS, np.float32), 0.0 if not rows else 20.0 * (2 * share - 1))
    random = np.random.default_rng(7)
    vectors = random.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    layer, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    for step in range(steps):
        if step % len(rows) == 0:
            order = random.permutation(len(rows))
        bucket, count, label = rows[order[step % len(rows)]]
        share_of = (count / max(count.sum(), 1)).astype(np.float32)[:, None]
        mean = (vectors[bucket] * share_of).sum(0)
        logits = layer @ mean + bias
        chance = np.exp(logits - logits.max())
        chance /= chance.sum()
        chance[label] -= 1  # now the gradient of the logits
        now = rate * (1 - step / steps)
        back = chance @ layer
        layer -= now * np.outer(chance, mean)
        bias -= now * chance * 0.1
        vectors[bucket] -= now * share_of * back * len(bucket) ** 0.5
    return Model(vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]))


def train_on(
    docs: DataFrame, labels: DataFrame, chosen: Column, key: str, text: str, label: str, sample: int
) -> Model:
    """Fit on at most ``sample`` labelled documents, those with the smallest hashes of their keys.

    The sample is bounded: its keys are broadcast, the tasks send at most one count per bucket
    and document, and the model is trained on the driver. A key with several labels has the
    largest; labels other than 0 and 1 and NULLs are not used.
    """
    picked = (
        labels.filter(chosen & F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(sample)
    )

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bucket, owner = features(batch.column(1))
            both, count = np.unique(owner * BUCKETS + bucket, return_counts=True)
            first = np.searchsorted(both // BUCKETS, np.arange(batch.num_rows + 1))
            offsets = pa.array(first, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (both % BUCKETS, count)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *lists], names=["key", "label", "b", "n"])

    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    joined = texts.join(F.broadcast(picked), F.col("key") == F.col("_key")).select("key", "text", "_label")
    kind = docs.schema[key].dataType.simpleString()
    rows = joined.mapInArrow(run, f"key {kind}, label int, b array<int>, n array<int>")
    rows = rows.dropDuplicates(["key"]).orderBy(F.xxhash64("key"), "key").toLocalIterator()
    return train([(np.array(r["b"], np.int64), np.array(r["n"], np.float64), r["label"]) for r in rows])


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    chosen: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = 2000,
) -> DataFrame:
    """``docs`` with score (0 to 1, the chance of label 1) and predicted (1 from 0.5 on).

    ``chosen`` says which rows of ``labels`` may be learned from; at most ``sample`` documents are.
    All texts are scored whole, in runs of bounded size. NULL and empty texts have no feature, so their score follows from
    the layer's bias alone. Repeated rows get the same score; columns named score and predicted
    are replaced. Without usable labels all scores are 0.5. Training runs while the plan is built.
    """
    spark = docs.sparkSession
    model = train_on(docs, labels, F.lit(True) if chosen is None else chosen, key, text, label, sample)
    shared = spark.sparkContext.broadcast(model)
    token = ("quality", uuid.uuid4().hex)

    @F.arrow_udf("double")
    @giving_back
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = kept(token, lambda: shared.value)
        for array in texts:
            yield pa.array(model.score(array))

    scored = docs.withColumn("score", score(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
