"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry_point
from palate.registry import QUERIES

NAMES = sorted(entry_point.oracle_sql())
SF_DIR = TESTDATA / "sf0.01"

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_an_oracle():
    """All but some of the training-data operators, which SQL can not express."""
    assert set(QUERIES) <= set(NAMES) <= set(entry_point.queries())
    assert len(QUERIES) == 44


_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, db, name):
    frame = entry_point.queries()[name](spark, str(SF_DIR))
    names = sorted(frame.columns)
    answer = db.sql(entry_point.oracle_sql()[name])
    types = dict(zip(answer.columns, map(str, answer.types), strict=True))
    assert {c: _DUCK_TYPES[t] for c, t in frame.dtypes} == types

    got = sorted((tuple(row[c] for c in names) for row in frame.collect()), key=repr)
    want = sorted(answer.project(", ".join(f'"{c}"' for c in names)).fetchall(), key=repr)
    assert got == want
    assert got, "the comparison should not be of empty results"


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["user_id", "cosine_similarity", "rank"]
    assert [row["rank"] for row in frame.orderBy("rank").collect()] == list(range(1, 11))
