"""Small tables with the awkward rows every operator has to take."""

import pytest

TABLES = "/root/testdata/sf0.001"

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


@pytest.fixture
def awkward(spark):
    """Null id, text and other columns; empty, blank, repeated and very long texts; clashing columns."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "one two three four five six seven eight", "en", "s", 1),
        (1, "one two three four five six seven eight", "en", "s", 1),
        (2, None, None, None, None),
        (3, "", "en", "s", 0),
        (4, " \n\t ", "en", "s", 4),
        (None, "one two three four five six seven eight", "en", None, 2),
        (5, long, "en", "s", 3),
        (6, long + " tail", "en", "s", 3),
        (7, "ONE Two three", None, "s", 3),
        (8, "one two THREE", "en", "s", 3),
        (9, "éß 你好 \U0001f600 123 !!", "xx", "s", 3),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS)
    names = ["node", "score", "id", "component", "part", "tree", "__id", "seg", "block", "label"]
    return df.withColumns({n: F.lit("x") for n in names})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)
