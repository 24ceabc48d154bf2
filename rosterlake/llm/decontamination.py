"""Benchmark items inside documents: size-partitioned MinHash containment, then exact counts.

Items are parted by the number of their shingles. An item of n shingles that is contained to a
share t may miss at most n - ceil(t n) of them, so of its n - ceil(t n) + 1 smallest MinHash
values at least one belongs to the document. Those values are an item's sketch: a document that
has none of them, or fewer shingles than the partition needs, can not contain the item, and no
contained item is missed. Candidates are verified by counting shingles.

Items with equal shingles are searched once, and the keys of all of them joined to what is found.
The distinct ones are taken in blocks of bounded size, one pass over the documents each; within a
pass the documents stay where they are read, nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.session import materialize, small_side

from .tables import giving_back
from .words import distinct_by_document, find_words, mix, shingles, slices

BLOCK_SHINGLES = 1 << 20  # item shingles (8 bytes each, and their owners) sent to all tasks at once
_SEED = np.uint64(0xA0761D6478BD642F)


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The fewest shared shingles that make up ``percent`` of each size."""
    return (sizes * percent + 99) // 100


def item_shingles(items: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """Per row of ``items``: key and the sorted distinct shingle hashes; rows without words go."""

    @giving_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, first = distinct_by_document(*shingles(find_words(batch.column(1)), n))
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["item", "hashes"])

    kind = items.schema[key].dataType.simpleString()
    found = items.select(F.col(key).alias("item"), F.col(text).cast("string").alias("text"))
    return found.mapInArrow(run, f"item {kind}, hashes array<bigint>").filter(F.size("hashes") > 0)


class ItemBlock:
    """Items with their sketches, for looking up the shingles of documents."""

    def __init__(self, rows: list, percent: int) -> None:
        self.keys = [row["item"] for row in rows]
        self.sets = [np.array(row["hashes"], np.int64).view(np.uint64) for row in rows]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.least = needed(self.sizes, percent)
        partition = np.floor(np.log2(self.sizes)).astype(int)
        self.fewest = np.array([self.least[partition == p].min() for p in partition], np.int64)
        values, owners = [], []
        for i, (own, size, least) in enumerate(zip(self.sets, self.sizes, self.least, strict=True)):
            sketch = own[np.argsort(mix(own ^ _SEED), kind="stable")[: size - least + 1]]
            values.append(sketch)
            owners.append(np.full(len(sketch), i))
        values, owners = np.concatenate(values), np.concatenate(owners)
        order = np.lexsort((owners, values))
        self.owners = owners[order]
        self.values, self.begin = np.unique(values[order], return_index=True)
        self.end = np.append(self.begin[1:], len(order))

    def search(self, values: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Document number, item number and shared shingles of all contained items."""
        at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        hits = np.flatnonzero(self.values[at] == values)
        document = np.searchsorted(first, hits, "right") - 1
        for d in np.unique(document):
            own = values[first[d] : first[d + 1]]
            sketch = at[hits[document == d]]
            items = np.unique(np.concatenate([self.owners[self.begin[s] : self.end[s]] for s in sketch]))
            for i in items[self.fewest[items] <= len(own)]:
                place = np.minimum(np.searchsorted(own, self.sets[i]), len(own) - 1)
                shared = int((own[place] == self.sets[i]).sum())
                if shared >= self.least[i]:
                    yield int(d), int(i), shared


def item_blocks(found: DataFrame, percent: int) -> Iterator[ItemBlock]:
    """The distinct sets of ``item_shingles``, each with its hash as ``item``, in blocks of about
    ``BLOCK_SHINGLES`` shingles, one small job for each. The sets are written once."""
    sets = materialize(found.select(F.xxhash64("hashes").alias("item"), "hashes").distinct(), "items")
    total = sets.agg(F.sum(F.size("hashes").cast("bigint"))).first()[0] or 0
    blocks = -(-total // BLOCK_SHINGLES)
    for b in range(blocks):
        own = sets.filter(F.pmod("item", F.lit(blocks)) == b).collect()
        if own:
            yield ItemBlock(own, percent)


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    percent: int = 80,
    n: int = 5,
) -> DataFrame:
    """All pairs of a document and an item of which it has ``percent`` or more of the shingles.

    Words are lower-cased (A-Z) runs without white space. One row per pair of rows: key of the
    document, key of the item, n_item (its shingles), n_shared. NULL and empty texts contain
    nothing and are contained in nothing; an item shorter than ``n`` words is one shingle, found
    only in a document of exactly its words. Rows with the same or a NULL key each count, other
    columns are ignored, empty tables give no rows. Items are written to shared storage and one
    small job per block of them runs while the plan is built.
    """
    spark = docs.sparkSession
    doc_name, item_name = (key, item_key) if key != item_key else (key, f"item_{item_key}")
    doc_kind = docs.schema[key].dataType.simpleString()
    schema = f"key {doc_kind}, item bigint, n_item bigint, n_shared bigint"
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def search(block) -> DataFrame:
        @giving_back
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = block.value
            for batch in slices(batches, "text"):
                values, first = distinct_by_document(*shingles(find_words(batch.column(1)), n))
                pairs = list(own.search(values, first)) if len(values) else []
                if pairs:
                    rows, item, shared = zip(*pairs, strict=True)
                    columns = [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array([own.keys[i] for i in item], pa.int64()),
                        pa.array(own.sizes[list(item)]),
                        pa.array(shared, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "item", "n_item", "n_shared"])

        return texts.mapInArrow(run, schema)

    found = item_shingles(items, item_key, item_text, n)
    parts = [search(spark.sparkContext.broadcast(b)) for b in item_blocks(found, percent)]
    result = parts[0] if parts else spark.createDataFrame([], schema)
    for part in parts[1:]:
        result = result.unionByName(part)
    keys = small_side(found.select(F.xxhash64("hashes").alias("item"), F.col("item").alias("item_key")))
    return result.join(keys, "item").select(F.col("key").alias(doc_name), F.col("item_key").alias(item_name), "n_item", "n_shared")


def without_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_text: str = "text",
    percent: int = 80,
    n: int = 5,
) -> DataFrame:
    """The rows of ``docs`` that contain no item (see ``contained_items``), with all their columns.

    NULL and empty texts stay, as do all rows if there are no items. No document is shuffled.
    """
    spark = docs.sparkSession
    for block in item_blocks(item_shingles(items.withColumn("_item", F.lit(0)), "_item", item_text, n), percent):
        docs = docs.filter(~_has_item(spark.sparkContext.broadcast(block), n)(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return docs


def _has_item(block, n: int):
    @F.arrow_udf("boolean")
    @giving_back
    def has_item(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            found = [np.zeros(0, bool)]
            for part in slices(iter([pa.RecordBatch.from_arrays([array], names=["text"])]), "text"):
                values, first = distinct_by_document(*shingles(find_words(part.column(0)), n))
                own = np.zeros(part.num_rows, bool)
                if len(values):
                    own[[d for d, *_ in block.value.search(values, first)]] = True
                found.append(own)
            yield pa.array(np.concatenate(found))

    return has_item
