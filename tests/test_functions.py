from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from palate.functions import explode_genres, fixed, genre_list, weighted_mean


@pytest.mark.parametrize(
    ("text", "genres"),
    [
        ("a|b", ["a", "b"]),
        ("a|b|", ["a", "b"]),
        ("a|b||", ["a", "b"]),
        ("a||b", ["a", "", "b"]),
        ("|a", ["", "a"]),
        ("a", ["a"]),
        ("", [""]),
        ("|", []),
        ("(no genres listed)", []),
        ("a|(no genres listed)", ["a"]),
        (None, None),
    ],
)
def test_genre_list(spark, text, genres):
    df = spark.createDataFrame([(text,)], "genres string")
    assert df.select(genre_list("genres").alias("g")).first()["g"] == genres
    assert [r["genre"] for r in explode_genres(df).collect()] == (genres or [])


def test_fixed(spark):
    df = spark.createDataFrame([(2.0000004,), (1.9999996,), (-0.1234567,), (None,)], "v double")
    assert [r[0] for r in df.select(fixed(F.col("v"), 6)).collect()] == [2.0, 2.0, -0.123457, None]
    assert [r[0] for r in df.select(fixed(F.col("v"), None)).collect()] == [
        2.0000004, 1.9999996, -0.1234567, None,
    ]


def test_fixed_leaves_alone_what_has_no_digits_to_cut(spark):
    values = [1e14, -1e14, 2e10, 1e300, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for scale in (6, 9):
        assert [r[0] for r in df.select(fixed(F.col("v"), scale)).collect()] == values
    nan = spark.createDataFrame([(float("nan"),)], "v double").select(fixed(F.col("v"), 6))
    assert nan.first()[0] != nan.first()[0]


def test_weighted_mean_ignores_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 3), ("a", 5.0, 1), ("a", None, 9), ("b", None, 2)], "k string, v double, n long"
    )
    assert rows(df.groupBy("k").agg(weighted_mean("v", "n"))) == [("a", 2.0), ("b", None)]
