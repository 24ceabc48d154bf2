"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .collocations import collocations
from .decontamination import contained_items
from .jaccard import near_duplicates
from .language import identify_language
from .language_model import score_texts
from .lexical import ranked_search
from .licenses import scan_licenses
from .packing import pack
from .page_text import main_text
from .quality import score_quality
from .tables import in_fold, read_table, ship
from .topk import top_k
from .toxicity import score_toxicity
from .warc import archive_round_trip


def op1_language_model(spark: SparkSession, folder: str) -> DataFrame:
    held_out = in_fold(F.col("doc_id"), 5, 1)
    scored = score_texts(read_table(spark, folder, "documents"), ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(read_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def word_tokenizer(folder: str | None = None) -> str:
    """The definition of the public word tokenizer, from ``folder`` or the installed files."""
    if folder is None:
        import public_tokenizers

        return Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    return Path(folder, "word_bpe_49k.json").read_text()


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read_table(spark, folder, "documents"), word_tokenizer())


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    held_out = in_fold(F.col("doc_id"), 4, 2)
    found = identify_language(read_table(spark, folder, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(read_table(spark, folder, "pages"))


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: their source is the top directory, their language the one below."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("_")) for c in ("source", "lang", "doc_id")]
    docs = read_table(spark, folder, "documents").withColumn("path", F.concat_ws("/", *parts))
    return scan_licenses(docs, "doc_id", "path", "text")


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (read_table(spark, folder, name) for name in ("documents", "labels"))
    scored = score_quality(docs, labels, ~in_fold(F.col("doc_id"), 3, 1))
    return scored.select("doc_id", in_fold(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    # most pages are a few KB long: chunks of 8 KB give every tenth record several of them
    found = archive_round_trip(read_table(spark, folder, "pages"), chunk=8 << 10)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contained_items(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(read_table(spark, folder, "documents"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (read_table(spark, folder, name) for name in ("documents", "labels"))
    held_out = in_fold(F.col("doc_id"), 5, 0)
    return score_toxicity(docs, labels, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", "toxic_spans"
    )


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


_ALL = (
    op1_language_model,
    op2_top_k,
    op3_packing,
    op4_language,
    op5_page_text,
    op6_licenses,
    op7_quality,
    op8_warc,
    op9_decontamination,
    op10_jaccard_join,
    op11_ranked_search,
    op12_collocations,
    op13_toxicity,
)
QUERIES = {query.__name__: _shipped(query) for query in _ALL}
ORACLE_SQL = {
    "op2_top_k": sql.TOP_K,
    "op6_licenses": sql.LICENSES,
    "op9_decontamination": sql.CONTAINMENT,
    "op10_jaccard_join": sql.COMPONENTS,
    "op11_ranked_search": sql.RANKED,
    "op12_collocations": sql.COLLOCATIONS,
}
