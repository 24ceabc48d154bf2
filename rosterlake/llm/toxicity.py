"""Toxic spans from a linear-chain conditional random field, and document scores from its marginals.

A text is a row of sequences of tokens (sentences, cut after ``LONGEST`` tokens). Every token is
outside or inside a toxic span; the field has a weight per hashed feature of a token (its form, its
neighbours, its beginnings and endings) and one per pair of adjacent states. Forward and backward
sums over all sequences of a run of text are made in step, one array operation per position.

Labels are given per document, so the labelled tokens are found first: forms and beginnings of words
that occur in far more toxic than clean documents mark the tokens of toxic documents; all others
are outside. The field is trained on windows of those tokens by adaptive gradient descent in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.session import materialize

from .tables import giving_back, unused
from .words import IS_TERM, Words, byte_runs, mix, shingles, word_hashes, words_in

RUN_BYTES = 256 << 10  # text scored at once
LONGEST = 64  # tokens of a sequence
WINDOW = 32  # tokens of a training example
PER_DOCUMENT = 4  # training examples from one document
BUCKETS = 1 << 18
NEIGHBOURS, BEGINNINGS, ENDINGS = 2, (3, 4, 5, 6), (3, 4)
KINDS = 1 + NEIGHBOURS + len(BEGINNINGS) + len(ENDINGS)
EVIDENCE = (0, 4, 5, 6)  # kinds of features that can mark a token: the form, longer beginnings
LEAST_EVIDENCE = 15.0  # log-likelihood ratio, about one chance in 10,000
_STOPS = np.zeros(256, bool)
_STOPS[[0x0A, 0x0D, 0x21, 0x2E, 0x3B, 0x3F]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def features(words: Words) -> np.ndarray:
    """One row per token, one 64-bit hash per kind of feature."""
    size = len(words.starts)
    out = np.empty((size, KINDS), np.uint64)
    if not size:
        return out
    hashes, document = word_hashes(words), words.documents()
    same = document[1:] == document[:-1]
    out[:, 0] = hashes
    out[0, 1] = out[-1, 2] = 0
    out[1:, 1] = np.where(same, hashes[:-1], 0)
    out[:-1, 2] = np.where(same, hashes[1:], 0)
    lengths, last = words.ends - words.starts, len(words.data) - 1
    column = 1 + NEIGHBOURS
    with np.errstate(over="ignore"):
        for sizes, place in ((BEGINNINGS, lambda j: words.starts + j), (ENDINGS, lambda j: words.ends - 1 - j)):
            part = np.zeros(size, np.uint64)
            for j in range(max(sizes)):
                byte = words.data[np.clip(place(j), 0, last)].astype(np.uint64) + np.uint64(1)
                part = (part + np.where(j < lengths, byte, np.uint64(0))) * _STEP
                part ^= part >> np.uint64(29)
                if j + 1 in sizes:
                    out[:, column] = part
                    column += 1
        return mix(out + np.arange(1, KINDS + 1, dtype=np.uint64) * _STEP)


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def sequences(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Where each sequence of a run of texts begins among its tokens, and their lengths."""
    size = len(words.starts)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    stops = np.cumsum(_STOPS[words.data])[words.starts]
    document = words.documents()
    new = np.ones(size, bool)
    new[1:] = (stops[1:] != stops[:-1]) | (document[1:] != document[:-1])
    begin = np.flatnonzero(new)
    place = np.arange(size) - np.repeat(begin, np.diff(np.append(begin, size)))
    begin = np.flatnonzero(place % LONGEST == 0)
    return begin, np.diff(np.append(begin, size))


class Field(NamedTuple):
    """What a feature adds to the inside state, and what a pair of states adds, [from, to]."""

    weight: np.ndarray
    bias: float
    pair: np.ndarray
    shift: float = 0.0  # the log odds of a chance from which on a token counts as toxic

    def emissions(self, hashes: np.ndarray) -> np.ndarray:
        return np.clip(self.weight[buckets(hashes)].sum(1, dtype=np.float64) + self.bias, -30, 30)

    def marginals(self, emission: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The chance of the inside state at each token."""
        inside, *_ = sums(emission, begin, length, self.pair)
        return inside


def sums(emission: np.ndarray, begin: np.ndarray, length: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all sequences: marginal of the inside state per token, expected pairs.

    Sequences are taken longest first, so that those that still run are a prefix at every step.
    """
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    factor, pairs = np.exp(pair), np.zeros((2, 2))
    front = np.empty((len(emission), 2))
    back = np.ones((len(emission), 2))
    gain = np.exp(emission)
    running = [int(np.searchsorted(-length, -t, "left")) for t in range(int(length.max(initial=0)))]  # longer than t
    for t, count in enumerate(running):
        at = begin[:count] + t
        now = np.stack([np.ones(count), gain[at]], 1)
        if t:
            now *= front[at - 1] @ factor
        front[at] = now / now.sum(1, keepdims=True)
    for t, count in reversed(list(enumerate(running))[1:]):
        at = begin[:count] + t
        ahead = back[at] * np.stack([np.ones(count), gain[at]], 1)
        both = front[at - 1][:, :, None] * factor[None] * ahead[:, None, :]
        pairs += (both / both.sum((1, 2), keepdims=True)).sum(0)
        before = ahead @ factor.T
        back[at - 1] = before / before.sum(1, keepdims=True)
    joint = front * back
    return joint[:, 1] / joint.sum(1), pairs


def train(rows: list[tuple[np.ndarray, np.ndarray]], passes: int = 4, batch: int = 64, rate: float = 0.3) -> Field:
    """Fit a field on (buckets of the features per token, state per token) examples.

    Gradients of the log likelihood are scaled per weight by the root of their summed squares.
    Without an inside token nothing is ever inside.
    """
    weight, bias, pair = np.zeros(BUCKETS, np.float32), -1.0, np.zeros((2, 2))
    if not any(states.any() for _, states in rows):
        return Field(weight, -30.0, pair)
    random = np.random.default_rng(11)
    squares, bias_square, pair_square = np.full(BUCKETS, 1e-3), 1e-3, np.full((2, 2), 1e-3)
    for _ in range(passes):
        order = random.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = [rows[i] for i in order[at : at + batch]]
            bucket = np.concatenate([b for b, _ in chosen])
            states = np.concatenate([s for _, s in chosen])
            length = np.array([len(s) for _, s in chosen])
            begin = np.cumsum(length) - length
            emission = np.clip(weight[bucket].sum(1, dtype=np.float64) + bias, -30, 30)
            inside, pairs = sums(emission, begin, length, pair)
            error = inside - states
            within = np.ones(len(states), bool)
            within[begin] = False
            seen = np.flatnonzero(within)
            np.subtract.at(pairs, (states[seen - 1].astype(int), states[seen].astype(int)), 1)
            touched, place = np.unique(bucket, return_inverse=True)
            slope = np.bincount(place.ravel(), np.repeat(error, KINDS), len(touched)) + 1e-3 * weight[touched]
            squares[touched] += slope**2
            weight[touched] -= rate * slope / np.sqrt(squares[touched])
            bias_square += error.sum() ** 2
            bias -= rate * error.sum() / bias_square**0.5
            pair_square += pairs**2
            pair -= rate * pairs / np.sqrt(pair_square)
    return Field(weight, float(bias), pair)


def _labelled(docs: DataFrame, labels: DataFrame, chosen: Column, key: str, text: str, label: str, sample: int) -> DataFrame:
    """Texts of at most ``sample`` labelled documents of either label, one of each near copy."""
    known = (
        labels.filter(chosen & F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    order = (F.xxhash64("_key"), F.col("_key"))
    picked = known.filter("label = 1").orderBy(*order).limit(sample).union(known.filter("label = 0").orderBy(*order).limit(sample))

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = np.full(batch.num_rows, 2**64 - 1, np.uint64)
            for row, raw, offsets in byte_runs(batch.column(1), RUN_BYTES, ~IS_TERM):
                values, first = shingles(words_in(raw, offsets, table=IS_TERM))
                owner = row + np.repeat(np.arange(len(offsets) - 1), np.diff(first))
                np.minimum.at(least, owner, values)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least.view(np.int64))], names=["key", "text", "label", "sketch"]
            )

    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    texts = texts.filter(F.length("text") > 0)
    joined = texts.join(F.broadcast(picked), F.col("key") == F.col("_key")).select("key", "text", "label")
    kind = docs.schema[key].dataType.simpleString()
    # near copies share their smallest shingle; of those of one label the smallest key stays
    sketched = joined.mapInArrow(run, f"key {kind}, text string, label int, sketch bigint")
    return sketched.groupBy("sketch", "label").agg(F.min_by("text", F.struct("key", F.xxhash64("text"))).alias("text"))


def _markers(sample: DataFrame) -> np.ndarray:
    """Hashes of the features that toxic documents have far more often than clean ones, sorted."""

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            found, sides = [], []
            for row in range(batch.num_rows):
                own = [
                    np.unique(features(words_in(raw, offsets, table=IS_TERM))[:, list(EVIDENCE)])
                    for _, raw, offsets in byte_runs(batch.column(0).slice(row, 1), RUN_BYTES, ~IS_TERM)
                ]
                found.append(np.unique(np.concatenate([np.zeros(1, np.uint64), *own])))  # 0 counts documents
                sides.append(np.full(len(found[-1]), label[row], bool))
            if not found:
                continue
            values, place = np.unique(np.concatenate(found), return_inverse=True)
            side = np.concatenate(sides)
            counts = [np.bincount(place[side == s], minlength=len(values)) for s in (False, True)]
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), *map(pa.array, counts)], names=["f", "clean", "toxic"])

    counted = sample.select("text", "label").mapInArrow(run, "f bigint, clean bigint, toxic bigint")
    counted = counted.groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = materialize(counted.filter("toxic >= 3 OR f = 0"), "evidence")
    totals = counted.filter("f = 0").first()
    if totals is None or not totals["clean"] or not totals["toxic"]:
        return np.zeros(0, np.uint64)
    share = totals["toxic"] / (totals["toxic"] + totals["clean"])
    both = F.col("toxic") + F.col("clean")
    ratio = 2 * (
        F.col("toxic") * F.log(F.col("toxic") / (both * share))
        + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (both * (1 - share)))).otherwise(0)
    )
    rate = F.col("toxic") / totals["toxic"] >= 10 * F.col("clean") / totals["clean"]
    found = counted.filter((F.col("f") != 0) & rate & (ratio >= LEAST_EVIDENCE)).select("f").collect()
    return np.sort(np.array([r["f"] for r in found], np.int64).view(np.uint64))


def _examples(sample: DataFrame, markers) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """At most ``PER_DOCUMENT`` windows of each document: around marked tokens, or anywhere."""

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = markers.value
        for batch in batches:
            label = batch.column(1).to_numpy()
            for row in range(batch.num_rows):
                windows = []
                for _, raw, offsets in byte_runs(batch.column(0).slice(row, 1), RUN_BYTES, ~IS_TERM):
                    hashes = features(words_in(raw, offsets, table=IS_TERM))
                    if not len(hashes):
                        continue
                    random = np.random.default_rng(int(hashes[0, 0] >> np.uint64(1)))
                    states, centres = np.zeros(len(hashes), np.int8), np.arange(len(hashes))
                    if label[row]:
                        evidence = hashes[:, list(EVIDENCE)]
                        at = np.minimum(np.searchsorted(known, evidence), len(known) - 1)
                        states = (known[at] == evidence).any(1).astype(np.int8)
                        centres = np.flatnonzero(states)
                    for centre in random.permutation(centres)[:PER_DOCUMENT]:
                        low = max(min(int(centre) - WINDOW // 2, len(hashes) - WINDOW), 0)
                        windows.append((random.random(), hashes[low : low + WINDOW], states[low : low + WINDOW]))
                kept = sorted(windows, key=lambda w: w[0])[:PER_DOCUMENT]
                if kept:
                    columns = [pa.array([buckets(w[k]).tobytes() if k == 1 else w[k].tobytes() for w in kept]) for k in (1, 2)]
                    yield pa.RecordBatch.from_arrays(columns, names=["b", "s"])

    rows = sample.select("text", "label").mapInArrow(run, "b binary, s binary").orderBy(F.xxhash64("b", "s"), "b")
    for r in rows.toLocalIterator():
        yield np.frombuffer(r["b"], np.int32).reshape(-1, KINDS), np.frombuffer(r["s"], np.int8)


def tag(field: Field, texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Scores of the texts; row, start and end (code points) and score of each toxic span."""
    scores, spans = np.zeros(len(texts)), []
    row_before, points_before = -1, 0
    for row, raw, offsets in byte_runs(texts, RUN_BYTES, ~IS_TERM):
        if row != row_before:
            points_before = 0
        row_before = row
        words = words_in(raw, offsets, table=IS_TERM)
        starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        if len(words.starts):
            inside = field.marginals(field.emissions(features(words)), *sequences(words))
            inside = 1 / (1 + np.exp(field.shift - log_odds(inside)))
            document = words.documents()
            np.maximum.at(scores, row + document, inside)
            marked = np.flatnonzero(inside >= 0.5)
            if len(marked):
                new = np.ones(len(marked), bool)
                new[1:] = (np.diff(marked) > 1) | (np.diff(document[marked]) != 0)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(marked)) - 1
                base = starts[offsets[document[marked[first]]]] - points_before
                spans.append(
                    np.stack(
                        [
                            row + document[marked[first]],
                            starts[words.starts[marked[first]]] - base,
                            starts[words.ends[marked[last]]] - base,
                            np.maximum.reduceat(inside[marked], first),
                        ],
                        1,
                    )
                )
        points_before += int(starts[-1])
    return scores, spans


def log_odds(chance: np.ndarray) -> np.ndarray:
    chance = np.clip(chance, 1e-9, 1 - 1e-9)
    return np.log(chance / (1 - chance))


def best_cut(odds: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the widest gap among those that part the two labels with fewest errors."""
    order = np.argsort(odds, kind="stable")
    odds, labels = odds[order], labels[order]
    wrong = np.cumsum(labels == 1)[:-1] + np.cumsum((labels == 0)[::-1])[::-1][1:]
    gaps = np.diff(odds)
    if not len(gaps):
        return 0.0
    best = np.lexsort((-gaps, wrong))[0]
    return float(odds[best] + odds[best + 1]) / 2


def _calibrated(field: Field, sample: DataFrame) -> Field:
    """The field with the shift that parts the documents of the sample best."""
    shared = sample.sparkSession.sparkContext.broadcast(field)

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, _ = tag(shared.value, batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(scores), batch.column(1)], names=["score", "label"])

    rows = sample.select("text", "label").mapInArrow(run, "score double, label int").collect()
    odds, labels = log_odds(np.array([r["score"] for r in rows])), np.array([r["label"] for r in rows])
    return field._replace(shift=best_cut(odds, labels))




def train_on(
    docs: DataFrame, labels: DataFrame, chosen: Column, key: str, text: str, label: str, sample: int
) -> Field:
    """Fit a field on at most ``sample`` documents of either label, ``PER_DOCUMENT`` windows each.

    The sample is bounded, so are its counted features and its windows, which train the field
    on the driver. A key with several labels has the largest; labels other than 0 and 1 and
    NULLs are not used, nor are empty texts. Without documents of both labels nothing is toxic.
    """
    picked = materialize(_labelled(docs, labels, chosen, key, text, label, sample), "labelled")
    markers = _markers(picked)
    if not len(markers):
        return train([])
    field = train(list(_examples(picked, docs.sparkSession.sparkContext.broadcast(markers))))
    return _calibrated(field, picked)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    chosen: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = 3000,
) -> DataFrame:
    """``docs`` with score, predicted and toxic_spans.

    A token's chance is its marginal, with the log odds shifted so that 0.5 parts the labelled
    documents best. score is the largest chance, predicted is 1 from 0.5 on, toxic_spans lists start, end (places in the text, end excluded) and score of the runs of tokens
    with a chance of 0.5 or more. ``chosen`` says which rows of ``labels`` may be learned from; at
    most ``sample`` documents of either label are. All texts are scored whole, in runs of
    ``RUN_BYTES`` bytes at most (a longer text begins a new sequence there), so that memory
    does not depend on their lengths. NULL texts and those without a token have the score 0 and no
    span. Repeated rows get the same score; columns named like the new ones are replaced.
    Without labelled documents of both kinds all scores are below 1e-6. Training runs while the
    plan is built.
    """
    model = train_on(docs, labels, F.lit(True) if chosen is None else chosen, key, text, label, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    @F.arrow_udf("score double, spans array<struct<start:bigint,end:bigint,score:double>>")
    @giving_back
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            scores, found = tag(shared.value, array)
            rows = np.concatenate([np.zeros((0, 4)), *found])
            offsets = np.searchsorted(rows[:, 0], np.arange(len(array) + 1))
            columns = [pa.array(rows[:, k].astype(np.int64)) for k in (1, 2)] + [pa.array(rows[:, 3])]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(span)))
            yield pa.StructArray.from_arrays([pa.array(np.round(scores, 9)), lists], names=["score", "spans"])

    added = ("score", "predicted", "toxic_spans")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    both = unused("_tagged", docs.columns)
    tagged = docs.select(*kept, score(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias(both))
    return tagged.select(
        *kept,
        F.col(f"{both}.score").alias("score"),
        (F.col(f"{both}.score") >= 0.5).cast("int").alias("predicted"),
        F.col(f"{both}.spans").alias("toxic_spans"),
    )
