"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from conftest import TESTDATA, executed_plans, last_execution, plan, rows

from palate.operators import profiles
from palate.plans import workloads
from palate.registry import QUERIES
from palate.sources.canonical import canonical

SF_DIR = str(TESTDATA / "sf0.001")
CSV = {n for n in QUERIES if "csv" in n}
SKYLINES = {n for n in QUERIES if "skyline" in n or "dominated" in n}
#: These stage something while they are built: a counted side, or a file.
EAGER = CSV | SKYLINES | {"tag_uses_cut_join"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python(spark, name):
    """In any job of the query, those that stage something included."""
    before = last_execution(spark)
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    found = executed_plans(spark, before)
    assert found
    for text in found:
        assert "CartesianProduct" not in text
        assert "Python" not in text and "Pandas" not in text
        assert "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_jobs_while_a_query_is_built(spark, name):
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    try:
        QUERIES[name](spark, SF_DIR)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    assert bool(jobs) == (name in EAGER)


def test_a_query_opens_only_its_tables(spark):
    text = plan(QUERIES["target_tag_profile"](spark, SF_DIR))
    assert text.count("Scan parquet") == 1 and "embeddings" in text


@pytest.mark.parametrize("name", ["tag_sentiment", "tag_rating_pairs"])
def test_tags_and_ratings_are_read_once_and_not_joined(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert text.count("Scan parquet") == 2  # the two files that the lines come from
    assert text.count("Join") == 1


def test_both_distinct_counts_come_from_one_read_of_tags(spark):
    t = canonical(spark, SF_DIR)
    points = workloads.genre_tag_points(t.tags, t.movies, t.ratings)
    assert plan(points).count("o_orderpriority:string") == 1


def test_unused_distinct_counts_cost_nothing(spark):
    text = plan(QUERIES["dominant_tag_per_genre"](spark, SF_DIR))
    assert "Expand" not in text and "distinct" not in text


def test_the_cosine_adapts_to_the_size_of_the_target(spark):
    """The side of the target's tags is a plain join: broadcast as it turns out small, or not at all."""
    frame = QUERIES["user_target_cosine"](spark, SF_DIR)
    assert "AdaptiveSparkPlan" in plan(frame) and "Window" not in plan(frame)
    before = last_execution(spark)
    frame.collect()
    assert "BroadcastHashJoin" in executed_plans(spark, before)[-1]


def test_large_ratings_meet_vectors_in_blocks(spark, monkeypatch):
    name = "user_target_cosine"
    want = rows(QUERIES[name](spark, SF_DIR))
    assert "present" not in plan(QUERIES[name](spark, SF_DIR))
    monkeypatch.setattr(profiles, "BLOCKED_BYTES", 1000)
    blocked = QUERIES[name](spark, SF_DIR)
    assert "present" in plan(blocked) and rows(blocked) == want


def test_topk_sorts_locally_first(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["topk_users"](spark, SF_DIR))


def test_filters_and_columns_reach_the_scan(spark):
    scan = plan(canonical(spark, SF_DIR).genome_scores.select("movie_id"))
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in scan
    text = plan(QUERIES["movie_genre_pairs"](spark, SF_DIR))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_size:int>" in text
    text = plan(QUERIES["avg_rating_per_movie"](spark, SF_DIR))
    assert "l_extendedprice" not in text and "o_custkey" not in text


def test_groupings_combine_before_the_shuffle(spark):
    for name in ("avg_rating_per_movie", "genre_tag_counts", "most_used_tag_per_genre"):
        assert "partial_" in plan(QUERIES[name](spark, SF_DIR))


def test_argmax_uses_no_window(spark):
    assert "Window" not in plan(QUERIES["most_used_tag_per_genre"](spark, SF_DIR))
