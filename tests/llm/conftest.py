import os

import pytest
from pyspark.sql import types as T

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = T.StructType([T.StructField(n, t) for n, t in [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows; extra columns are filled with null."""

    def make(rows):
        return spark.createDataFrame([tuple(r) + (None,) * (5 - len(r)) for r in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and blank texts, one word, repeated rows, one id with two texts, a very long text."""
    long_text = " ".join(f"word{i % 7001} and" for i in range(30_000))
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "Élan vital"), (4, "Élan vital"), (5, "same words here now"), (6, "same words here now"),
            (7, "a first text under seven"), (7, "a second text under seven"), (None, "a text without an id"), (None, None), (8, long_text), (9, long_text + " tail"), (10, "one")]
    return make_docs(rows)


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
