"""Small hand-computed cases, one per rule of the queries."""

from __future__ import annotations

import math
import random

import pytest
from conftest import rows

from palate.operators import argmax_per_group, iceberg, topk_ranked
from palate.operators.profiles import cosine_components, cosine_to_target, user_profiles
from palate.plans import blocks, workloads
from palate.sources.schemas import GENOME_SCORES, GENOME_TAGS, MOVIES, RATINGS, TAGS


@pytest.fixture
def make(spark):
    schemas = {
        "movies": MOVIES,
        "ratings": RATINGS,
        "tags": TAGS,
        "scores": GENOME_SCORES,
        "labels": GENOME_TAGS,
    }
    return lambda name, data: spark.createDataFrame(data, schemas[name])


def test_iceberg_support_counts_applications_and_weights_by_them(make):
    movies = make("movies", [("1", "A", "g"), ("2", "B", "g"), ("3", "C", "g")])
    ratings = make("ratings", [("u", "1", 5.0), ("u", "2", 2.0)])
    tags = make(
        "tags",
        [("u", "1", "t"), ("v", "1", "t"), ("u", "1", "t"), ("u", "2", "t"), ("u", "3", "t")],
    )
    # three applications on the 5.0 movie, one on the 2.0 movie, one on an unrated movie
    found = workloads.iceberg_tag_genre(tags, movies, ratings, min_count=3, min_avg=4.0)
    assert rows(found) == [("t", "g", 4.25)]
    assert rows(workloads.iceberg_tag_genre(tags, movies, ratings, 4, 4.0)) == []
    assert rows(workloads.iceberg_tag_genre(tags, movies, ratings, 3, 4.25)) == []


def test_iceberg_keeps_the_null_tag_group(make):
    movies = make("movies", [("1", "A", "g")])
    ratings = make("ratings", [("u", "1", 5.0)])
    tags = make("tags", [("u", "1", None), ("v", "1", None)])
    assert rows(workloads.iceberg_tag_genre(tags, movies, ratings, 1, 4.0)) == [(None, "g", 5.0)]


def test_dominant_tag_is_chosen_before_ratings_are_looked_at(make):
    movies = make("movies", [("1", "A", "g|h"), ("2", "B", "g"), ("3", "C", "k")])
    ratings = make("ratings", [("u", "1", 4.0), ("u", "2", 1.0)])
    tags = make(
        "tags",
        [("u", "1", "x"), ("v", "1", "x"), ("u", "2", "x"), ("u", "2", "y"), ("u", "3", "z")],
    )
    # g: x three times, weighted (4 + 4 + 1) / 3; h: x; k: its tag is on an unrated movie only
    found = workloads.dominant_tag_per_genre(tags, movies, ratings)
    assert found.columns == ["tag", "genre", "avg_rating"]
    assert rows(found) == [("x", "g", 3.0), ("x", "h", 4.0)]


def test_dominant_tag_ties_go_to_the_first_tag_and_null_last(make):
    movies = make("movies", [("1", "A", "g"), ("2", "B", "h")])
    ratings = make("ratings", [("u", "1", 4.0), ("u", "2", 3.0)])
    tags = make(
        "tags",
        [("u", "1", "b"), ("u", "1", "a"), ("u", "1", None), ("u", "2", None), ("v", "2", None)],
    )
    assert rows(workloads.dominant_tag_per_genre(tags, movies, ratings)) == [
        ("a", "g", 4.0),
        (None, "h", 3.0),
    ]


def test_argmax_keeps_all_columns_and_puts_null_measures_last(spark):
    df = spark.createDataFrame(
        [("g", "a", None, 1), ("g", "b", 2, 2), ("g", "c", 2, 3), ("h", "d", None, 4)],
        "k string, t string, n int, extra int",
    )
    assert rows(argmax_per_group(df, ["k"], "n", ["t"])) == [
        ("g", "b", 2, 2),
        ("h", "d", None, 4),
    ]


def test_relevant_tags_average_only_strong_scores_and_group_by_id(make):
    scores = make(
        "scores",
        [("1", "7", 0.9), ("2", "7", 0.95), ("3", "7", 0.1), ("1", "8", 0.9), ("2", "8", 0.9),
         ("1", "9", 0.9), ("1", "9", 0.9), ("1", "5", 0.99), ("2", "5", 0.99)],
    )
    labels = make("labels", [("7", "same"), ("8", "same"), ("9", "one movie twice")])
    found = workloads.iceberg_relevant_tags(scores, labels, 0.6, 1, 0.8)
    assert [(tag, round(avg, 6)) for tag, avg in rows(found)] == [("same", 0.9), ("same", 0.925)]


def test_sentiment_counts_repeats_unless_deduplicated(make):
    tags = make(
        "tags",
        [("u", "1", "t"), ("u", "1", "t"), ("u", "2", "t"), ("u", "3", "t"), ("v", "1", "t")],
    )
    ratings = make("ratings", [("u", "1", 5.0), ("u", "2", 2.0), ("w", "1", 0.5)])
    assert rows(workloads.tag_sentiment(tags, ratings)) == [("t", 4.0)]
    assert rows(workloads.tag_sentiment(tags, ratings, dedupe=True)) == [("t", 3.5)]


def test_sentiment_multiplies_repeated_ratings_and_ignores_null_ones(make):
    tags = make("tags", [("u", "1", "t"), ("u", "1", "s"), ("u", "2", "n"), ("u", "1", None)])
    ratings = make("ratings", [("u", "1", 5.0), ("u", "1", 2.0), ("u", "1", None), ("u", "2", None)])
    assert rows(workloads.tag_sentiment(tags, ratings)) == [
        ("n", None),
        ("s", 3.5),
        ("t", 3.5),
        (None, 3.5),
    ]
    pairs = rows(blocks.tag_rating_pairs(blocks.facts(tags, ratings)))
    assert ("u", "1", "t", 5.0, 1) in pairs and len(pairs) == 10


def test_skyline_support_counts_different_averages_and_users_without_ratings(make):
    movies = make("movies", [(m, m, "g|(no genres listed)") for m in "1234"])
    ratings = make("ratings", [("u", "1", 3.0), ("u", "2", 3.0), ("u", "3", 4.0)])
    tags = make(
        "tags",
        [("u", m, "x") for m in "123"] + [("v", "4", "x"), ("u", "1", "y"), ("w", "2", "y")],
    )
    # x: averages {3, 4}; y: {3} although on two movies
    points = workloads.genre_tag_points(tags, movies, ratings, 1)
    [(genre, tag, average, users)] = rows(points)
    assert (genre, tag, users) == ("g", "x", 2) and math.isclose(average, 10 / 3)
    assert len(rows(workloads.skyline_tag_genre(tags, movies, ratings, 0))) == 1
    assert rows(workloads.dominated_tag_genre(tags, movies, ratings, 0)) == [("g", "y")]


def test_correlation_guards(make):
    ratings = make("ratings", [("u", "1", 1.0), ("u", "2", 2.0), ("u", "3", 4.0)])
    scores = make("scores", [("1", "a", 0.1), ("2", "a", 0.2), ("3", "a", 0.4), ("9", "a", 0.9)])
    [(r,)] = rows(workloads.corr_relevance_rating(ratings, scores))
    assert math.isclose(r, 1.0)
    flat = make("scores", [("1", "a", 0.5), ("2", "a", 0.5)])
    assert rows(workloads.corr_relevance_rating(ratings, flat)) == [(None,)]
    assert rows(workloads.corr_relevance_rating(ratings, make("scores", []))) == [(None,)]


def test_profile_and_cosine_use_shared_dimensions_only(make):
    ratings = make(
        "ratings",
        [("u", "1", 5.0), ("u", "2", 4.5), ("u", "3", 4.0), ("v", "3", 5.0), ("w", "8", 5.0)],
    )
    scores = make(
        "scores",
        [("1", "a", 0.2), ("1", "b", 0.4), ("2", "a", 0.6), ("2", "z", 1.0), ("3", "c", 0.5),
         ("T", "a", 0.5), ("T", "b", 0.5), ("T", "c", 0.1), ("T", "d", 0.9)],
    )
    profiles = {(u, t): s for u, t, s in rows(user_profiles(ratings, scores, 4.0))}
    assert {k: round(s, 9) for k, s in profiles.items()} == {
        ("u", "a"): 0.4, ("u", "b"): 0.4, ("u", "z"): 1.0, ("v", "c"): 0.5,
    }
    # u shares a and b with the target; d and c do not enter u's target norm
    [u, v] = rows(cosine_components(ratings, scores, "T", 4.0))
    assert u[0] == "u" and [round(x, 9) for x in u[1:]] == [0.4, 0.32, 0.5]
    assert v[0] == "v" and [round(x, 9) for x in v[1:]] == [0.05, 0.25, 0.01]
    cosines = dict(rows(workloads.user_target_cosine(ratings, scores, "T")))
    assert set(cosines) == {"u", "v"}
    assert math.isclose(cosines["u"], 1.0) and math.isclose(cosines["v"], 1.0)
    assert rows(workloads.user_target_cosine(ratings, scores, "unknown")) == []


def test_cosine_of_a_zero_vector_is_null(make):
    ratings = make("ratings", [("u", "1", 5.0)])
    scores = make("scores", [("1", "a", 0.0), ("T", "a", 0.5)])
    assert rows(workloads.user_target_cosine(ratings, scores, "T")) == [("u", None)]


def test_cosine_with_repeated_likes_scores_and_target_entries(make):
    """Repeats act as the row-by-row joins would make them act."""
    ratings = [("u", "1", 5.0), ("u", "1", 5.0), ("u", "2", 5.0)]
    scores = [("1", "a", 0.2), ("1", "a", 0.4), ("2", "a", 0.9), ("2", "b", 0.5),
              ("T", "a", 0.5), ("T", "a", 0.7), ("T", "b", 0.1)]
    likes = [(u, r) for u, m, _ in ratings for n, t, r in scores if n == m and t == "a"]
    a = sum(r for _, r in likes) / len(likes)
    want = (a * 0.5 + a * 0.7 + 0.5 * 0.1, 2 * a * a + 0.25, 0.25 + 0.49 + 0.01)
    [got] = rows(cosine_components(make("ratings", ratings), make("scores", scores), "T", 4.0))
    assert all(math.isclose(x, y) for x, y in zip(got[1:], want, strict=True))


def test_blocked_and_long_vectors_agree(make):
    """With gaps, repeats and NULL scores, for more tags than one block holds."""
    rng = random.Random(7)
    ratings = make(
        "ratings", [(f"u{rng.randrange(30)}", f"m{rng.randrange(20)}", 5.0) for _ in range(200)]
    )
    scores = make(
        "scores",
        [(f"m{rng.randrange(21)}", f"t{rng.randrange(25)}",
          None if rng.random() < 0.2 else rng.randrange(100) / 64) for _ in range(600)],
    )

    def sums(**limit):
        found = cosine_components(ratings, scores, "m3", **limit).collect()
        return {r[0]: tuple(r[1:]) for r in found}

    blocked, long = sums(blocked=True), sums(blocked=False)
    assert set(long) == set(blocked) and len(long) > 20
    for user in long:
        for x, y in zip(long[user], blocked[user], strict=True):
            assert x == y or math.isclose(x, y)


def test_overhyped_matches_labels_exactly_and_averages_the_present_tags(make):
    labels = make("labels", [("1", "action"), ("2", "Action"), ("3", "thriller")])
    scores = make(
        "scores",
        [("m", "1", 0.9), ("m", "2", 0.0), ("m", "3", 0.7), ("n", "1", 0.9), ("o", "1", 0.79),
         ("p", "3", 0.8)],
    )
    ratings = make("ratings", [("u", "m", 2.0), ("u", "n", 2.5), ("u", "o", 1.0), ("u", "p", 2.4)])
    found = workloads.overhyped_movies(scores, labels, ratings)
    assert [(m, round(s, 9), r) for m, s, r in rows(found)] == [("m", 0.8, 2.0), ("p", 0.8, 2.4)]


def test_argmax_takes_any_payload_and_the_least_number(spark):
    df = spark.sql(
        "select * from values ('a', -9223372036854775808L, 'x', map('k', 1)), "
        "('a', null, 'y', map('k', 2)), ('b', 5L, 'y', map('k', 3)), ('b', 5L, 'x', map('k', 4)) "
        "as t(k, n, t, m)"
    )
    found = argmax_per_group(df, ["k"], "n", ["t"]).orderBy("k").collect()
    assert [(r.k, r.n, r.m["k"]) for r in found] == [("a", -(2**63), 1), ("b", 5, 4)]


def test_topk_numbered_by_ranges(spark, monkeypatch):
    df = spark.range(500).selectExpr("cast(id as string) as user_id", "nullif(pmod(hash(id), 40), 3) / 7D as c")
    want = topk_ranked(df.repartition(5), "c", 300, ["user_id"]).collect()
    monkeypatch.setattr("palate.operators.ranking.ONE_TASK_ROWS", 10)
    found = topk_ranked(df.repartition(5), "c", 300, ["user_id"])
    assert found.columns == ["user_id", "c", "rank"]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[2]) == [tuple(r) for r in want]


def test_topk_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("b", 0.5), ("a", 0.5), ("c", 0.9), ("d", None)], "user_id string, cosine_similarity double"
    )
    assert rows(workloads.topk_users(df, 2)) == [("a", 0.5, 2), ("c", 0.9, 1)]
    assert [r["user_id"] for r in topk_ranked(df, "cosine_similarity", 9, ["user_id"]).collect()] == [
        "c", "a", "b", "d",
    ]


def test_cosine_to_target_stays_in_range(spark):
    df = spark.range(50).selectExpr(
        "cast(id as string) user_id", "cast(id as double) dot_product",
        "cast(id as double) user_norm_sqr", "cast(id as double) target_norm_sqr",
    )
    found = [c for _, c in rows(cosine_to_target(df)) if c is not None]
    assert len(found) == 49 and all(-1 - 1e-9 <= c <= 1 + 1e-9 for c in found)


def test_raising_a_support_threshold_only_shrinks_the_result(spark):
    from pyspark.sql import functions as F

    df = spark.range(500).selectExpr("id % 13 * (id % 3) as k", "id % 7 as v")

    def keys(support):
        found = iceberg(df, ["k"], F.count("v"), support, F.avg("v"), 2.0, measure_name="m")
        return {k for k, _ in rows(found)}

    chain = [keys(support) for support in (0, 10, 20, 40, 200)]
    assert all(later <= earlier for earlier, later in zip(chain, chain[1:]))
    assert chain[0] and not chain[-1]
