"""Ranked lexical search of many queries at once: sums over common terms are made once.

All queries of a block are evaluated together on runs of documents. Terms that the same queries
hold (equally often) are one node, a partial accumulator over the documents of a run. Nodes that
several queries share are combined pairwise, the pair that most queries hold first, each pair
becoming a node of its own. A query's score is then the sum of the few nodes left in its list;
every node of this graph is computed once per run, in the order in which the nodes were made.

Documents are read once per block of queries: their counts of query terms are written to shared
storage, from where the corpus statistics and then the scores come. A task sends a document only
if it could still be among the best k of a query there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.session import materialize, small_side

from .tables import written
from .words import IS_TERM, byte_runs, word_hashes, words_in

RUN_BYTES = 1 << 20  # text taken apart at once
RUN_CELLS = 1 << 20  # accumulators (nodes times documents) held at once
BLOCK_TERMS = 1 << 15  # query terms, repeats included, that are sent to all tasks at once
SHARED = 1024  # nodes whose pairs are counted; others are added where they belong (work only)


class Plan(NamedTuple):
    """How the scores of a block of queries come about.

    Leaf i adds ``times[i]`` times the part of term ``term[i]`` to node ``node[i]``; node
    ``leaves + j`` is the sum of the nodes ``pairs[j]``; query q is the sum of the nodes ``tops[q]``.
    """

    term: np.ndarray
    times: np.ndarray
    node: np.ndarray
    leaves: int
    pairs: np.ndarray
    tops: list[np.ndarray]

    @property
    def nodes(self) -> int:
        return self.leaves + len(self.pairs)


def share(queries: list[np.ndarray]) -> Plan:
    """The plan for queries given as term numbers with repeats."""
    holders: dict[tuple[int, int], list[int]] = {}
    for q, terms in enumerate(queries):
        for term, times in zip(*map(np.ndarray.tolist, np.unique(terms, return_counts=True)), strict=True):
            holders.setdefault((term, times), []).append(q)
    number: dict[tuple[int, ...], int] = {}
    leaf = [(t, n, number.setdefault(tuple(qs), len(number))) for (t, n), qs in holders.items()]
    held = [set() for _ in queries]
    for qs, node in number.items():
        for q in qs:
            held[q].add(node)
    pairs = _pairs(held, {node: len(qs) for qs, node in number.items() if len(qs) > 1}, len(number))
    columns = np.array(leaf, np.int64).reshape(-1, 3)
    tops = [np.array(sorted(h), np.int64) for h in held]
    return Plan(columns[:, 0], columns[:, 1], columns[:, 2], len(number), np.array(pairs, np.int64).reshape(-1, 2), tops)


def _pairs(held: list[set[int]], sharing: dict[int, int], nodes: int) -> list[tuple[int, int]]:
    """Replace, most frequent first, pairs of nodes that several queries hold by new nodes."""
    kept = sorted(sharing, key=lambda n: (-sharing[n], n))[:SHARED]
    if not kept:
        return []
    matrix = np.zeros((len(held), 2 * len(kept)), np.int32)  # queries, nodes; room for new ones
    names = kept[:]
    place = {n: i for i, n in enumerate(kept)}
    for q, own in enumerate(held):
        matrix[q, [place[n] for n in own if n in place]] = 1
    both = np.triu(matrix.T @ matrix, 1)
    made = []
    while len(names) < matrix.shape[1]:
        best = int(both.argmax())
        a, b = divmod(best, both.shape[1])
        if both[a, b] < 2:
            break
        new = len(names)
        with_both = (matrix[:, a] & matrix[:, b]).astype(bool)
        matrix[with_both, new] = 1
        matrix[with_both, a] = matrix[with_both, b] = 0
        made.append((names[a], names[b]))
        names.append(nodes + len(made) - 1)
        for q in np.flatnonzero(with_both):
            held[q] -= {names[a], names[b]}
            held[q].add(names[new])
        for n in (a, b, new):
            counts = matrix[:, n] @ matrix
            both[n, n + 1 :], both[:n, n] = counts[n + 1 :], counts[:n]
    return made


class Block(NamedTuple):
    """Queries with the sorted hashes of their terms, and how to evaluate them."""

    queries: np.ndarray
    hashes: np.ndarray
    plan: Plan

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms per text; text, term number and count of each query term in a text."""
        total, cells = np.zeros(len(texts), np.int64), [np.zeros(0, np.int64)]
        hint = np.zeros(1 << 16, bool)
        hint[self.hashes & np.uint64(0xFFFF)] = True
        for row, raw, offsets in byte_runs(texts, RUN_BYTES, ~IS_TERM):
            words = words_in(raw, offsets, table=IS_TERM)
            total[row : row + len(offsets) - 1] += words.counts
            hashes = word_hashes(words)
            likely = np.flatnonzero(hint[hashes & np.uint64(0xFFFF)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[likely]), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes[likely]
            owner = row + np.searchsorted(words.first, likely[hit], "right") - 1
            cells.append(owner * len(self.hashes) + at[hit])
        cell, count = np.unique(np.concatenate(cells), return_counts=True)
        return total, cell // len(self.hashes), cell % len(self.hashes), count

    def scores(self, parts: np.ndarray, document: np.ndarray, term: np.ndarray, documents: int) -> np.ndarray:
        """Scores [query, document] from the part of each (document, term)."""
        plan = self.plan
        order = np.argsort(plan.term, kind="stable")
        low = np.searchsorted(plan.term[order], term, "left")
        count = np.searchsorted(plan.term[order], term, "right") - low
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        leaf = order[np.repeat(low, count) + within]
        sums = np.zeros((plan.nodes, documents), np.int64)
        np.add.at(sums, (plan.node[leaf], np.repeat(document, count)), plan.times[leaf] * np.repeat(parts, count))
        for j, (a, b) in enumerate(plan.pairs):
            np.add(sums[a], sums[b], out=sums[plan.leaves + j])
        return np.stack([sums[top].sum(0) for top in plan.tops])


def _query_blocks(terms: DataFrame) -> Iterator[Block]:
    """The distinct queries (hash and terms), in blocks of about ``BLOCK_TERMS`` terms."""
    total = terms.agg(F.sum(F.size("terms").cast("bigint"))).first()[0] or 0
    blocks = -(-total // BLOCK_TERMS)
    for b in range(blocks):
        rows = terms.filter(F.pmod("query", F.lit(blocks)) == b).orderBy("query").collect()
        if rows:
            own = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
            hashes = np.unique(np.concatenate(own))
            yield Block(np.array([r["query"] for r in rows], np.int64), hashes, share([np.searchsorted(hashes, o) for o in own]))


def query_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """item (the key) and the sorted term hashes, repeats included, of each row with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[] for _ in range(batch.num_rows)]
            for row, raw, offsets in byte_runs(batch.column(1), RUN_BYTES, ~IS_TERM):
                words = words_in(raw, offsets, table=IS_TERM)
                hashes = word_hashes(words)
                for d in range(len(offsets) - 1):
                    lists[row + d].append(hashes[words.first[d] : words.first[d + 1]])
            own = [np.sort(np.concatenate(x)) if x else np.zeros(0, np.uint64) for x in lists]
            column = pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["item", "terms"])

    kind = items.schema[key].dataType.simpleString()
    found = items.select(F.col(key).alias("item"), F.col(text).cast("string").alias("text"))
    return found.mapInArrow(run, f"item {kind}, terms array<bigint>").filter(F.size("terms") > 0)


def _counted(texts: DataFrame, kind: str, block) -> DataFrame:
    """Per document with a term its number of terms, and numbers and counts of query terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, document, term, count = block.value.counts(batch.column(1))
            offsets = pa.array(np.searchsorted(document, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((term, pa.int32()), (count, pa.int64()))]
            rows = pa.RecordBatch.from_arrays([batch.column(0), pa.array(total), *lists], names=["key", "n", "t", "c"])
            yield rows.filter(pa.array(total > 0))

    return texts.mapInArrow(run, f"key {kind}, n bigint, t array<int>, c array<bigint>")


def _frequencies(counted: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each query term occurs; one sum per task and term is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(terms, np.int64)
        for batch in batches:
            found += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["t", "df"])

    sums = counted.select("t").mapInArrow(run, "t bigint, df bigint").groupBy("t").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(terms, np.int64)
    out[[r["t"] for r in sums]] = [r["df"] for r in sums]
    return out


def weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    ratios = (2 * documents + 2) / (2 * frequencies + 1)
    return np.array([math.floor(1000 * math.log(x)) for x in ratios.tolist()], np.int64)


def length_terms(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """The length norm of documents of ``n`` terms; exact beyond 64 bits."""
    if len(n) and 75 * int(n.max()) * documents >= 1 << 63:
        return np.array([25 + 75 * int(x) * documents // terms for x in n], np.int64)
    return 25 + 75 * n * documents // max(terms, 1)


def _best(counted: DataFrame, kind: str, block, k: int, weight: np.ndarray, documents: int, terms: int) -> DataFrame:
    """key, query and score of the documents that no task found k better ones for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Block = block.value
        least = np.ones((len(own.queries), k), np.int64)  # best scores so far, the k-th one first
        step = max(RUN_CELLS // max(own.plan.nodes, 1), 1)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                sizes = pc.list_value_length(part.column(2)).to_numpy()
                document, term = np.repeat(np.arange(part.num_rows), sizes), part.column(2).flatten().to_numpy()
                count = part.column(3).flatten().to_numpy()
                norm = length_terms(part.column(1).to_numpy(), documents, terms)[document]
                value = weight[term] * (1_000_000_000 * count // (1000 * count + 8 * norm))
                scores = own.scores(value, document, term, part.num_rows)
                place = pc.rank(part.column(0), "ascending", null_placement="at_end", tiebreaker="first").to_numpy()
                rows = []
                for q in np.flatnonzero((scores >= least[:, :1]).any(1)):
                    good = np.flatnonzero(scores[q] >= least[q, 0])
                    good = good[np.lexsort((place[good], -scores[q, good]))[:k]]
                    rows.append(np.stack([np.full(len(good), q), good, scores[q, good]]))
                    least[q] = np.sort(np.concatenate([least[q], scores[q, good]]))[-k:]
                if rows:
                    q, good, score = np.concatenate(rows, 1)
                    keys = part.column(0).take(pa.array(good))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(own.queries[q]), pa.array(score)], names=["key", "query", "score"])

    return counted.mapInArrow(run, f"key {kind}, query bigint, score bigint")


def _first(found: DataFrame, k: int, *parts) -> DataFrame:
    order = (F.col("score").desc(), F.col("key").asc_nulls_last())
    window = Window.partitionBy("query", *parts).orderBy(*order)
    return found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``k`` best documents of every item: item key, rank (from 1), document key, score.

    A score sums, over the item's terms with repeats, an integer weight from the term's document
    frequency times a saturated, length-normed integer count. Only scores above 0 are returned; equal
    ones are ranked by ascending key, NULL keys last. Terms are runs of ASCII letters, digits and
    other characters, A-Z lower-cased. NULL and empty texts have no term: as documents they do
    not count, as items they find nothing. Rows with the same key each count; columns other than
    key and text are ignored; empty tables give no rows. Texts are read whole, in runs of bounded
    size. Equal items are searched once. Term counts are written to shared storage and small
    jobs run while the plan is built. If both keys have the same name, that of the item is
    prefixed by ``item_``.
    """
    spark = docs.sparkSession
    doc_name, item_name = (key, item_key) if key != item_key else (key, f"item_{item_key}")
    kind = docs.schema[key].dataType.simpleString()
    found = materialize(query_terms(items, item_key, item_text), "queries")
    named = found.select("item", F.xxhash64("terms").alias("query"), "terms")
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    texts = texts.filter(F.length("text") > 0)
    best = spark.createDataFrame([], f"key {kind}, query bigint, score bigint")
    for own in _query_blocks(materialize(named.select("query", "terms").distinct(), "queries")):
        block = spark.sparkContext.broadcast(own)
        counted = written(_counted(texts, kind, block), "term_counts")
        size = counted.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
        weight = weights(_frequencies(counted, len(own.hashes)), size["documents"])
        best = best.unionByName(_best(counted, kind, block, k, weight, size["documents"], size["terms"] or 0))
    # the best of each task meet in 64 parts per query first
    best = _first(_first(best, k, F.pmod(F.xxhash64("key"), F.lit(64))).drop("rank"), k)
    result = best.join(small_side(named.select("item", "query")), "query")
    return result.select(
        F.col("item").alias(item_name), F.col("rank").cast("int").alias("rank"), F.col("key").alias(doc_name), "score"
    )
