"""Registered queries against their SQL, and the pipeline's stages against plain versions."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rosterlake.llm.queries import ORACLE_SQL, QUERIES
from rosterlake.llm.tables import read_table

from .conftest import FOLDER
from .test_decontamination import brute as contained
from .test_jaccard import brute as components


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_registered(spark, database, name):
    found = QUERIES[name](spark, FOLDER)
    cursor = database.execute(ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    expected = sorted((tuple(r) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=str) == expected


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert numbers == sorted(set(numbers)) and set(numbers) >= set(range(1, 11))


def test_pipeline_stages(spark):
    docs = read_table(spark, FOLDER, "documents")
    more = [
        (None, "  \n", None, "x", 3), (9001, "12 34", None, "x", 5), (9002, None, "en", "x", None),
        (None, docs.first().text, "en", "x", 1), (9003, docs.first().text, "en", "x", 1), (9003, docs.first().text, "en", "x", 1),
        (9004, " ".join(f"{i * 2654435761 % 2**32:08x}" for i in range(300)), None, "x", 1),
    ]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "language ID", "n-gram Jaccard join", "benchmark decontamination", "packing"]

    good = stages["quality classifier"](spark, docs, FOLDER)
    labels = {r.doc_id: r.quality for r in read_table(spark, FOLDER, "labels").collect()}
    kept = {r.doc_id for r in good.collect()}
    known = [k for k, q in labels.items() if q == 1]
    assert good.columns == docs.columns and sum(k in kept for k in known) >= 0.97 * len(known)
    bad = [k for k, q in labels.items() if q == 0]
    assert sum(k in kept for k in bad) <= 0.1 * len(bad)

    spoken = stages["language ID"](spark, docs, FOLDER)
    expected = [str(r) for r in docs.collect() if any(c.isalpha() for c in r.text or "") and r.doc_id != 9004]
    assert sorted(str(r) for r in spoken.collect()) == sorted(expected)
    clashing = docs.withColumns({"score": F.lit("s"), "letters": F.lit("l"), "_row": F.lit(1), "_key": F.lit(2), "predicted": F.lit(3)})
    for name in ("quality classifier", "language ID", "n-gram Jaccard join"):
        found = stages[name](spark, clashing, FOLDER)
        assert found.columns == clashing.columns and found.filter("score <> 's' OR letters <> 'l' OR _row <> 1 OR _key <> 2").count() == 0

    rows = spoken.collect()
    single = stages["n-gram Jaccard join"](spark, spoken, FOLDER)
    numbered = spark.createDataFrame([(i, r.text) for i, r in enumerate(rows)], "doc_id long, text string").collect()
    groups = {c for _, _, c in components(numbered)}
    assert single.columns == docs.columns and single.count() == len(groups)

    clean = stages["benchmark decontamination"](spark, docs, FOLDER)
    items = [(r.item_id, r.text) for r in read_table(spark, FOLDER, "benchmark").collect()]
    expected = [str(r) for r in docs.collect() if not contained([(0, r.text)], items)]
    assert sorted(str(r) for r in clean.collect()) == sorted(expected) and len(expected) < docs.count()

    for name, stage in stages.items():
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name


def test_pipeline_runs(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.agg(F.sum("length")).first()[0] == found.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
    assert found.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0
