"""Joins under skew: same result as the plain join, with the hot key cut up."""

from __future__ import annotations

import pytest
from conftest import TESTDATA, executed_plans, plan, rows
from pyspark.sql import functions as F

from palate.operators.joins import (
    HotKeys,
    Lookup,
    Spread,
    find_hot_keys,
    lookup_join,
    spread_join,
)
from palate.registry import QUERIES

TEST = Spread(share=1 / 16, min_rows=0)


@pytest.fixture(scope="module")
def sides(spark):
    """One key holds a third of the big side; some keys miss a partner; NULL keys too."""
    big = spark.range(6000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 1000 = 1 then null "
        "else cast(id % 97 as string) end as k",
        "id as v",
    )
    small = spark.range(120).selectExpr("cast(id % 60 + 20 as string) as k", "id as w").union(
        spark.sql("select 'hot' as k, explode(sequence(1000L, 1002L)) as w union all select null, 5L")
    )
    return big, small


def test_hot_keys_are_found_and_bounded(sides):
    big, _ = sides
    hot = find_hot_keys(big, ["k"], spread=TEST)
    assert len(hot.cells) == 1 and set(hot.cells.values()) == {6}
    assert not find_hot_keys(big.filter("k <> 'hot'"), ["k"], spread=TEST).cells
    assert not find_hot_keys(big.filter("v < 0"), ["k"], spread=TEST).cells
    assert not find_hot_keys(big, ["k"]).cells, "few rows need no spreading"
    capped = find_hot_keys(big, ["k"], spread=Spread(share=1 / 16, min_rows=0, max_rows=100))
    assert max(capped.cells.values()) >= 20, "a cell is bounded in rows too"


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_the_plain_join(sides, how):
    big, small = sides
    got = spread_join(big, small, ["k"], how, spread=TEST)
    want = big.join(small, "k", how)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_spread_join_on_two_columns_and_without_other_columns(spark, sides):
    big, small = sides
    two = big.withColumn("p", F.col("v") % 2)
    dim = small.selectExpr("k", "w % 2 as p", "w")
    assert rows(spread_join(two, dim, ["k", "p"], spread=TEST)) == rows(two.join(dim, ["k", "p"]))
    keys = big.select("k")
    got = spread_join(keys, small, ["k"], spread=TEST)
    assert rows(got) == rows(keys.join(small, "k"))


def test_the_hot_key_is_cut_into_balanced_cells(sides):
    big, _ = sides
    hot = find_hot_keys(big, ["k"], spread=TEST)
    cell = F.pmod(F.xxhash64("v"), F.col("_cells"))
    sizes = hot.add_cells(big).groupBy("k", cell.alias("cell")).count()
    assert max(r["count"] for r in sizes.collect()) < 6000 / 16 * 1.5


def test_without_hot_keys_the_plan_is_the_plain_join(sides):
    big, small = sides
    assert "_cell" not in plan(spread_join(big, small, ["k"], hot=HotKeys(("k",), {})))


def test_lookup_join_broadcasts_only_what_was_measured(sides, monkeypatch):
    big, small = sides
    want = rows(big.join(small, "k"))
    assert Lookup.of(small).fits and not Lookup.of(small, max_bytes=10).fits
    fitting = lookup_join(big, small, ["k"])
    assert "BroadcastHashJoin" in plan(fitting) and rows(fitting) == want
    too_big = lookup_join(big, Lookup.of(small, max_bytes=10), ["k"])
    assert "broadcast(" not in plan(too_big) and rows(too_big) == want


def test_join_columns_must_have_one_type(spark):
    left, right = spark.range(3).selectExpr("id as k"), spark.sql("select '1' as k")
    with pytest.raises(TypeError, match="join column k"):
        spread_join(left, right, ["k"])


def test_unknown_join_type(sides):
    with pytest.raises(ValueError, match="unsupported"):
        spread_join(*sides, ["k"], "full")


def test_workloads_agree_when_nothing_may_be_broadcast(spark):
    """Joins of two shuffled sides give the results of broadcast ones."""
    sf = str(TESTDATA / "sf0.001")
    names = [
        "iceberg_tag_genre", "dominant_tag_per_genre", "genre_tag_users", "user_target_cosine",
        "overhyped_movies", "tag_sentiment", "tag_rating_pairs",
    ]
    want = {name: rows(QUERIES[name](spark, sf)) for name in names}
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {name: rows(QUERIES[name](spark, sf)) for name in names} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_adaptive_execution_splits_a_hot_key(spark):
    """The plain join of the queries: a third of the rows on one key is dealt to many tasks."""
    big = spark.range(400_000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v", "uuid() as text")
    small = spark.range(400_000).selectExpr("id as k", "id as w")
    kept = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in kept}
    for name, value in kept.items():
        spark.conf.set(name, value)
    try:
        joined = big.join(small, "k")
        assert joined.agg(F.count("*")).first()[0] == 400_000
        joined.write.format("noop").mode("overwrite").save()
        done = executed_plans(spark)[-1]
        assert "skew=true" in done
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
