"""From documents to packed training sequences, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.decontamination import without_items
from rosterlake.llm.jaccard import near_duplicates
from rosterlake.llm.language import has_language, identify_language
from rosterlake.llm.packing import pack
from rosterlake.llm.quality import score_quality
from rosterlake.llm.queries import word_tokenizer
from rosterlake.llm.tables import read_table, ship, unused
from rosterlake.session import materialize


def _rows_beside(docs: DataFrame) -> tuple[DataFrame, str]:
    """What the classifiers read, and the whole rows as one column that they do not touch."""
    whole = unused("_row", docs.columns)
    return docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole)), whole


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, takes for good."""
    ship(spark)
    rows, whole = _rows_beside(docs)
    return score_quality(rows, read_table(spark, sf_dir, "labels")).filter("predicted = 1").select(f"{whole}.*")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages: those without text or letters go, and those whose
    parse needs a new phrase every other letter (see ``has_language``)."""
    ship(spark)
    rows, whole = _rows_beside(docs)
    return identify_language(rows).filter(has_language()).select(f"{whole}.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that hang together by similar texts, the one with the smallest id.

    Rows with the same id and text are one document.
    """
    ship(spark)
    key = unused("_key", docs.columns)
    named = docs.withColumn(key, F.struct("doc_id", F.xxhash64("text").alias("hash")))
    kept = near_duplicates(named.select(key, "text"), key).filter(F.col(key).eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col(key).alias("component_id")).distinct()
    joined = named.join(kept, F.col(key).eqNullSafe(F.col("component_id")), "left_semi")
    return joined.dropDuplicates([key]).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    ship(spark)
    return without_items(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    ship(spark)
    return pack(docs, word_tokenizer())


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

# Trained models and a tokenizer take part in the stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages; each stage's rows are written once."""
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
