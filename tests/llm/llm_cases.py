"""Fixtures of the llm tests, imported by each of them."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from palate.llm.common import package_path

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))
TINY = str(TESTDATA / "sf0.001")


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    package_path(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a long text, repeated rows, and columns whose names
    the operators use inside."""
    long = "lorem ipsum dolor " * 4000 + "ende"
    rows = [
        (1, "The same text, twice over, in one table.\nWith a second line here.", "en", "a", 5),
        (1, "The same text, twice over, in one table.\nWith a second line here.", "en", "a", 5),
        (2, None, "en", None, None),
        (3, "", None, "b", 0),
        (4, " \n\t ", "en", "b", 4),
        (5, long, "la", "b", len(long)),
        (6, long, "la", "c", len(long)),
        (None, "A row without an id, but with words enough to be a document of its own.", "en", "c", 70),
        (7, "12345 67890 !!!", None, "c", 15),
        (8, "x", "en", None, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("uid", "key", "node", "size", "shard", "slot", "start", "ids", "kind", "keys", "line", "root", "lang_pred", "score", "n_lines"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
