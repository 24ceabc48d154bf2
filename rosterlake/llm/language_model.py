"""Scores of texts under a bigram model whose tries are dealt over the cluster.

Texts are cut into blocks of documents; a block has its distinct words, and its tokens as
numbers of those words. These exchanges follow, all of packed arrays:

1. Blocks send their words with training counts to the words' shards, which sum them up, number
   the words, and answer each block. The distinct training followers of the few contexts that
   are too frequent for one shard are then counted in an exchange of those pairs alone.
2. Blocks send their distinct pairs of neighbouring tokens, with training counts and the
   documents they occur in, to the shards of the first word.
3. A shard sums the pairs up, builds an Elias-Fano trie of smoothed probabilities, looks up the
   pairs of every block in it, and sends back the sum for each document.

Smoothing is by absolute discounting, interpolated with the smoothed word frequencies. A context
that makes up much of the corpus would overfill its shard. Its pairs are dealt by the second
word's shard; every part takes what the discount leaves from the followers counted over all
parts, so splitting changes no probability and those of a context sum to one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.session import materialize

from .elias_fano import Trie, dequantise, quantise
from .tables import partitions
from .words import find_words, mix, slices, word_hashes

BLOCK_TOKENS = 1 << 21
BLOCK_DOCUMENTS = 60_000  # numbers of documents take 16 bits, more in a block that a last long slice makes larger
END = mix(np.array([0xD6E8FEB86659FD93], np.uint64))[0]  # stands for the end in place of a word's hash
DISCOUNT = 0.75


def pack_arrays(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], np.int64)
    body = b"".join([head.tobytes(), *(a.tobytes() for a in arrays)])
    return np.int64(len(body)).tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def unpack_arrays(blob: bytes) -> list[np.ndarray]:
    size = int(np.frombuffer(blob[:8], np.int64)[0])
    body = pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True)
    count = int(np.frombuffer(body, np.int64, 1)[0])
    kinds = np.frombuffer(body, np.int64, 2 * count, 8).reshape(count, 2)
    out, at = [], 8 * (1 + 2 * count)
    for kind, length in kinds.tolist():
        out.append(np.frombuffer(body, chr(kind), length, at))
        at += out[-1].nbytes
    return out


def narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest type that holds them."""
    top = int(values.max(initial=0))
    for kind in (np.uint8, np.uint16, np.uint32):
        if top <= np.iinfo(kind).max:
            return values.astype(kind)
    return values.astype(np.uint64)


def ragged(size: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the runs of the given sizes."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def previous(counts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The token before each one; a text begins after an end."""
    first = np.cumsum(counts) - counts
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first] = tokens[first + counts - 1]
    return before


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def token_blocks(docs: DataFrame, key: str, text: str, training: Column) -> DataFrame:
    """block, keys, trained, n_words, words (packed hashes, training counts), tokens (see below).

    ``tokens`` has the number of tokens of each document and the tokens as numbers of ``words``;
    every document ends with the end token, also if it has no word. Written once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            keys = pa.concat_arrays([h[0] for h in held])
            trained = pa.concat_arrays([h[1] for h in held])
            counts, hashes = (np.concatenate([h[i] for h in held]) for i in (2, 3))
            held.clear()
            words, tokens = np.unique(hashes, return_inverse=True)
            learned = np.repeat(trained.to_numpy(zero_copy_only=False).astype(bool), counts)
            seen = np.bincount(tokens[learned], minlength=len(words))
            ends = pa.array([0, len(keys)], pa.int32())
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + number - 1], pa.int64()),
                    pa.ListArray.from_arrays(ends, keys),
                    pa.ListArray.from_arrays(ends, trained),
                    pa.array([len(words)], pa.int64()),
                    pa.array([pack_arrays(words, narrow(seen))], pa.binary()),
                    pa.array([pack_arrays(narrow(counts), narrow(tokens))], pa.binary()),
                ],
                names=["block", "keys", "trained", "n_words", "words", "tokens"],
            )

        for batch in slices(batches, "text"):
            words = find_words(batch.column(2))
            hashes = word_hashes(words)
            held.append((batch.column(0), batch.column(1), words.counts + 1, np.insert(hashes, words.first[1:], END)))
            if sum(len(h[3]) for h in held) >= BLOCK_TOKENS or sum(len(h[2]) for h in held) >= BLOCK_DOCUMENTS:
                yield flush()
        if held:
            yield flush()

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(training, F.lit(False)).alias("trained"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    schema = f"block bigint, keys array<{kind}>, trained array<boolean>, n_words bigint, words binary, tokens binary"
    return materialize(rows.mapInArrow(run, schema), "blocks")


def word_numbers(blocks: DataFrame, shards: int) -> DataFrame:
    """block, shard, numbers, n_tokens, n_words: per block and shard the packed numbers (0: not in
    training) and training counts of the block's words; rows with block -1 have a shard's totals
    and, packed, the hashes, counts and numbers of the words that may be frequent contexts."""
    schema = "shard bigint, block bigint, words binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words, seen = unpack_arrays(blob)
                shard = ((words >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
                ends = np.searchsorted(shard, np.arange(1, shards))
                parts = zip(np.split(words, ends), np.split(seen, ends), strict=True)
                yield _batch(schema, [(s, block, pack_arrays(w, n)) for s, (w, n) in enumerate(parts)])

    answer = "block bigint, shard bigint, numbers binary, n_tokens bigint, n_words bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_rows: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                shard_rows.setdefault(row["shard"], []).append((row["block"], row["words"]))
        for shard, rows in shard_rows.items():
            parts = [unpack_arrays(blob) for _, blob in rows]
            words = np.concatenate([p[0] for p in parts])
            distinct, inverse = np.unique(words, return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, inverse, np.concatenate([p[1].astype(np.int64) for p in parts]))
            number = np.where(total > 0, np.cumsum(total > 0), 0)
            often = np.flatnonzero(total > total.sum() / (4 * shards))  # the limit over all shards is no lower
            frequent = pack_arrays(distinct[often], total[often], number[often])
            yield _batch(answer, [(-1, shard, frequent, int(total.sum()), int((total > 0).sum()))])
            at = 0
            for block, part in zip((b for b, _ in rows), parts, strict=True):
                own = inverse[at : at + len(part[0])]
                at += len(own)
                yield _batch(answer, [(block, shard, pack_arrays(narrow(number[own]), narrow(total[own])), 0, 0)])

    dealt = blocks.select("block", "words").mapInArrow(deal, schema).repartition(shards, "shard")
    return materialize(dealt.mapInArrow(count, answer), "words")


def hot_followers(blocks: DataFrame, words: DataFrame, shards: int, hot: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the contexts with more than ``hot`` training tokens (fewer than 4 shards), sorted,
    and how many distinct words follow each in training."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes, total, number = unpack_arrays(blob)
                own = total > hot
                columns = [pa.array(hashes[own].view(np.int64)), pa.array(number[own].astype(np.int64) * shards + shard)]
                yield pa.RecordBatch.from_arrays(columns, names=["hash", "number"])

    found = words.filter("block < 0").select("shard", "numbers").mapInArrow(select, "hash bigint, number bigint").collect()
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = np.array([r["hash"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, number = hashes[order], np.array([r["number"] for r in found], np.int64)[order]
    sent = "shard bigint, data binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                trained = batch.column(0)[i].values.to_numpy(zero_copy_only=False).astype(bool)
                own = unpack_arrays(batch.column(1)[i].as_py())[0]
                counts, tokens = unpack_arrays(batch.column(2)[i].as_py())
                counts, tokens = counts.astype(np.int64), tokens.astype(np.int32)
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                context = np.where(hashes[at] == own, at, -1).astype(np.int32)[previous(counts, tokens)]
                chosen = np.flatnonzero((context >= 0) & np.repeat(trained, counts))
                both = np.unique(context[chosen] * np.int64(len(own)) + tokens[chosen])
                context, word = both // len(own), own[both % len(own)]
                spread = mix(word ^ mix(context.astype(np.uint64)))
                shard = ((spread >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
                order = np.argsort(shard, kind="stable")
                parts = np.split(order, np.searchsorted(shard[order], np.arange(1, shards)))
                rows = [(s, pack_arrays(narrow(context[p]), word[p])) for s, p in enumerate(parts) if len(p)]
                if rows:
                    yield _batch(sent, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [unpack_arrays(blob) for batch in batches for blob in batch.column(1).to_pylist()]
        if parts:
            context = np.concatenate([p[0].astype(np.int64) for p in parts])
            word = np.concatenate([p[1] for p in parts])
            order = np.lexsort((word, context))
            context, word = context[order], word[order]
            new = (np.diff(context, prepend=-1) != 0) | (np.diff(word, prepend=word[:1]) != 0)
            kinds = np.bincount(context[new], minlength=len(hashes))
            some = np.flatnonzero(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(kinds[some])], names=["context", "kinds"])

    dealt = blocks.select("trained", "words", "tokens").mapInArrow(deal, sent).repartition(shards, "shard")
    counted = dealt.mapInArrow(count, "context bigint, kinds bigint").groupBy("context").agg(F.sum("kinds").alias("kinds"))
    kinds = np.zeros(len(hashes), np.int64)
    for row in counted.collect():
        kinds[row["context"]] = row["kinds"]
    order = np.argsort(number)
    return number[order], kinds[order]


def score_texts(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows for which ``training`` holds and scores all. Tokens are lower-cased (A-Z)
    runs without white space and one end token, so a NULL or empty text has one token. base_score
    is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens, for c training
    occurrences of the token among N of V distinct ones; score is the log10 probability under
    the bigram model, in which all words unknown in training are one. Without training rows both
    treat every token as unknown. Repeated rows count each; rows without a key are scored;
    other columns are ignored; an empty table gives no rows. Blocks and word counts are written
    to shared storage and the followers of frequent contexts counted while the plan is built, the
    rest is one job with two exchanges.
    """
    spark = docs.sparkSession
    shards = 2 * partitions(spark)
    kind = docs.schema[key].dataType.simpleString()
    blocks = token_blocks(docs, key, text, training)
    words = word_numbers(blocks, shards)
    totals = sorted(words.filter("block < 0").select("shard", "n_tokens", "n_words").collect())  # one row per shard
    train_tokens, distinct = sum(t[1] for t in totals), sum(t[2] for t in totals)
    norm = train_tokens + 0.5 * (distinct + 1)
    hot = train_tokens / (4 * shards)
    hot_numbers, hot_kinds = hot_followers(blocks, words, shards, hot)

    sent = (
        f"shard bigint, block bigint, size bigint, data binary, keys array<{kind}>, "
        "n_tokens array<bigint>, n_known array<bigint>, base array<double>"
    )
    names = [f.split()[0] for f in sent.split(", ")]

    def pairs(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        """The pairs of a block, per shard of their contexts, and a row with its documents."""
        row = blocks.to_pylist()[0]
        size = row["n_words"]
        number, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = 0
        for answer in sorted(answers.to_pylist(), key=lambda r: r["shard"]):
            own, counts = unpack_arrays(answer["numbers"])
            # numbers are given per shard; 0 is left for the unknown word
            number[at : at + len(own)] = np.where(own > 0, own.astype(np.int64) * shards + answer["shard"], 0)
            total[at : at + len(own)] = counts
            at += len(own)
        if at != size:
            raise RuntimeError(f"block {row['block']} got {at} word numbers for {size} words")
        counts, tokens = unpack_arrays(row["tokens"])
        counts, tokens = counts.astype(np.int64), tokens.astype(np.int32)
        document = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        base = np.bincount(document, np.log10((total + 0.5) / norm)[tokens], len(counts))
        n_known = np.bincount(document, total[tokens] > 0, len(counts)).astype(np.int64)

        # arrays of all tokens are the largest here: each goes as soon as it is not needed
        both = previous(counts, tokens) * np.int64(size) + tokens
        del tokens
        by_token = np.argsort(both, kind="stable")
        by_pair = document[by_token]
        learned = np.repeat(np.array(row["trained"], bool), counts)[by_token]
        both = both[by_token]
        del by_token, document
        begin = np.flatnonzero(np.diff(both, prepend=-1))
        occurrences = np.diff(np.append(begin, len(both)))
        trained = np.add.reduceat(learned, begin, dtype=np.int64)
        both = both[begin]
        context, word = both // size, both % size
        split = total[context] > hot
        part = number[word] % shards
        place = number[context] * (shards + 1) + np.where(split, part + 1, 0)
        spread = mix(np.where(split, place, number[context]).astype(np.uint64))
        shard = ((spread >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((number[word], place, shard))
        ends = np.searchsorted(shard[order], np.arange(1, shards))
        out = []
        for s, own in enumerate(np.split(order, ends)):
            if not len(own):
                continue
            new = np.flatnonzero(np.diff(place[own], prepend=-1))
            owners = by_pair[np.repeat(begin[own], occurrences[own]) + ragged(occurrences[own])]
            followers, index = np.unique(number[word[own]], return_inverse=True)
            totals = np.zeros(len(followers), np.int64)
            totals[index] = total[word[own]]
            data = pack_arrays(
                narrow(np.diff(place[own][new], prepend=0)),
                narrow(np.diff(np.append(new, len(own)))),
                narrow(total[context[own][new]]),
                narrow(np.diff(followers, prepend=0)),
                narrow(totals),
                narrow(index),
                narrow(trained[own]),
                narrow(occurrences[own]),
                narrow(owners),
            )
            out.append((s, row["block"], len(counts), data, None, None, None, None))
        figures = (counts.tolist(), n_known.tolist(), base.tolist())
        out.append((row["block"] % shards, row["block"], len(counts), None, row["keys"], *figures))
        return pa.Table.from_arrays([pa.array(c, blocks_types[n]) for n, c in zip(names, zip(*out, strict=True), strict=True)], names)

    blocks_types = {
        "shard": pa.int64(), "block": pa.int64(), "size": pa.int64(), "data": pa.binary(), "keys": None,
        "n_tokens": pa.list_(pa.int64()), "n_known": pa.list_(pa.int64()), "base": pa.list_(pa.float64()),
    }

    def read(blob: bytes) -> tuple[np.ndarray, ...]:
        """context, its total, word, its total, training count, occurrences, documents of the pairs."""
        place, size, total, followers, totals, index, trained, occurrences, owners = unpack_arrays(blob)
        size = size.astype(np.int64)
        context = np.repeat(np.cumsum(place.astype(np.int64)), size)
        word, word_total = np.cumsum(followers.astype(np.int64))[index], totals.astype(np.int64)[index]
        return context, np.repeat(total.astype(np.int64), size), word, word_total, trained.astype(np.int64), occurrences, owners

    def chances(context, total, word, word_total, trained) -> np.ndarray:
        """Probabilities of the pairs of a shard, from the trie of its training pairs."""
        order = np.lexsort((word, context))
        context, word = context[order], word[order]
        first = np.flatnonzero((np.diff(context, prepend=-1) != 0) | (np.diff(word, prepend=-1) != 0))
        context, word = context[first], word[first]
        count = np.add.reduceat(trained[order], first) if len(first) else np.zeros(0, np.int64)
        total, lower = total[order[first]], (word_total[order[first]] + 0.5) / norm
        kept, share, left = count > 0, np.zeros(len(first)), np.ones(len(first))
        if kept.any():
            trie = Trie(context[kept].astype(np.uint64), word[kept], count[kept], total[kept], DISCOUNT)
            _, share, left = trie.lookup(context.astype(np.uint64), word)
        split = np.flatnonzero(context % (shards + 1))  # a part does not see all followers of its context
        kinds = hot_kinds[np.searchsorted(hot_numbers, context[split] // (shards + 1))]
        left[split] = dequantise(quantise(np.minimum(DISCOUNT * kinds / total[split], 1)))
        chance = share + left * lower
        out = np.empty(len(order))
        out[order] = np.repeat(chance, np.diff(np.append(first, len(order))))
        return out

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of log10 probabilities per document of every block; document rows pass through."""
        by_shard: dict[int, list[tuple[int, int, bytes]]] = {}
        for batch in batches:
            plain = batch.filter(pa.compute.is_null(batch.column(3)))
            if plain.num_rows:
                yield plain
            for row in batch.select(["shard", "block", "size", "data"]).to_pylist():
                if row["data"] is not None:
                    by_shard.setdefault(row["shard"], []).append((row["block"], row["size"], row["data"]))
        for shard, rows in by_shard.items():
            parts = [read(blob)[:5] for *_, blob in rows]
            ends = np.cumsum([len(p[0]) for p in parts])
            logs = np.split(np.log10(chances(*(np.concatenate(c) for c in zip(*parts, strict=True)))), ends[:-1])
            del parts
            for (block, size, blob), log in zip(rows, logs, strict=True):
                *_, occurrences, owners = read(blob)
                sums = np.bincount(owners, np.repeat(log, occurrences), size)
                out = (shard, block, size, sums.astype(np.float32).tobytes(), None, None, None, None)
                columns = [pa.array([v], batch.schema.field(n).type) for n, v in zip(names, out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def combine(rows: pa.Table) -> pa.Table:
        plain = rows.filter(pa.compute.is_valid(rows.column("keys")))
        sums = np.zeros(plain.column("size")[0].as_py())
        for blob in rows.column("data").drop_null().to_pylist():
            sums += np.frombuffer(blob, np.float32)
        flat = [plain.column(n).combine_chunks().flatten() for n in ("keys", "n_tokens", "n_known", "base")]
        return pa.Table.from_arrays([*flat, pa.array(sums)], [key, "n_tokens", "n_known", "base_score", "score"])

    blocks_types["keys"] = pa.list_(_arrow_type(docs, key))
    answers = words.filter("block >= 0").select("block", "shard", "numbers")
    sent_rows = blocks.drop("words").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(pairs, sent)
    summed = sent_rows.repartition(shards, "shard").mapInArrow(score, sent)
    scored = summed.groupBy("block").applyInArrow(
        combine, f"`{key}` {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(train_tokens).cast("bigint"))


def _arrow_type(docs: DataFrame, key: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[key].dataType)
