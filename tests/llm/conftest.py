import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tests.conftest import SMALL  # noqa: E402

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """The whole small table, as Spark reads it and as a list by key."""
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    return df, {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and a clashing extra
    column (``text_b``, ``start`` and ``kind`` are names that operators use)."""
    long = "word " * 30_000 + "end"
    rows = [
        (1, None, None, "a", None, "x", 1, "k"), (2, "", "en", None, 0, None, None, None),
        (3, "one", "en", "a", 3, "x", 1, "k"), (3, "one", "en", "a", 3, "x", 1, "k"),
        (4, "one", "en", "a", 3, "x", 1, "k"), (5, " \t\n\x0b\f\r ", "xx", "a", 7, "x", 1, "k"),
        (6, long, "en", "a", len(long), "x", 1, "k"), (7, "é̂ ß 😀 <|endoftext|> Σς", "fr", "b", 1, "x", 1, "k"),
        (None, "no key " * 30, "de", "b", 1, "x", 1, "k"), (8, "a" * 300_000, "en", "a", 1, "x", 1, "k"),
    ]
    return spark.createDataFrame(rows, DOC + ", text_b string, `start` int, kind string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
