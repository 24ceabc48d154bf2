import pytest
from pyspark.sql import Row

from rosterlake.llm.tables import ship

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def odd_docs(spark):
    """Documents with NULLs, repeats, empty and long texts, and columns named like internal ones."""
    texts = [
        (1, "alpha beta gamma delta epsilon zeta eta theta"),
        (2, "ALPHA beta  gamma\tdelta epsilon\nzeta eta theta"),
        (2, "ALPHA beta  gamma\tdelta epsilon\nzeta eta theta"),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, "one two"),
        (7, "One two"),
        (None, "alpha beta gamma delta epsilon zeta eta iota"),
        (None, None),
        (8, " ".join(f"w{i % 977}" for i in range(60_000))),
        (9, "x" * 300_000),
        (10, "été ÉTÉ <|endoftext|> 123"),
    ]
    rows = [
        Row(doc_id=k, text=t, lang="en", source="s", n_chars=None, key=0, text_hash="t", score="old", part=1, block=2, hash=3)
        for k, t in texts
    ]
    schema = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, key int, text_hash string, "
        "score string, part int, block int, hash int"
    )
    return spark.createDataFrame(rows, schema)
