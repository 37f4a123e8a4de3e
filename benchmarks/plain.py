"""The workloads in their plain form, as a base line for ``bench.py``.

Literal joins, one grouping after another, and the single-phase skyline: every pair of
rows compared through a join condition. Same inputs, parameters and reported columns
as the registered queries.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palate import parameters as P
from palate.functions import explode_genres, fixed
from palate.registry import _query
from palate.sources import Tables


def _item_ratings(t: Tables) -> DataFrame:
    return t.ratings.groupBy("movie_id").agg(F.avg("rating").alias("avg_rating"))


def _tag_genre(t: Tables) -> DataFrame:
    genres = explode_genres(t.movies.select("movie_id", "genres"))
    return t.tags.join(genres, "movie_id")


def _iceberg(t: Tables) -> DataFrame:
    return (
        _tag_genre(t).join(_item_ratings(t), "movie_id").groupBy("tag", "genre")
        .agg(F.count("avg_rating").alias("n"),
             fixed(F.avg("avg_rating"), P.COMPARE_SCALE).alias("avg_rating"))
        .filter((F.col("n") > P.MIN_COUNT) & (F.col("avg_rating") > P.MIN_AVG))
        .select("tag", "genre", "avg_rating")
    )


def _dominant(t: Tables) -> DataFrame:
    uses = _tag_genre(t)
    order = Window.partitionBy("genre").orderBy(F.desc("n"), F.asc_nulls_last("tag"))
    best = (
        uses.groupBy("genre", "tag").agg(F.count("*").alias("n"))
        .withColumn("place", F.row_number().over(order)).filter("place = 1")
        .select(F.col("genre").alias("g"), F.col("tag").alias("t"))
    )
    same = (F.col("genre") == F.col("g")) & F.col("tag").eqNullSafe(F.col("t"))
    return (
        uses.join(best, same).join(_item_ratings(t), "movie_id")
        .groupBy("tag", "genre").agg(F.avg("avg_rating").alias("avg_rating"))
    )


def _sentiment(t: Tables) -> DataFrame:
    joined = t.tags.join(t.ratings, ["user_id", "movie_id"])
    return joined.groupBy("tag").agg(F.avg("rating").alias("avg_rating"))


def _skyline(df: DataFrame, dims: list[str]) -> DataFrame:
    pairs = [(F.col(f"b.{d}"), F.col(f"a.{d}")) for d in dims]
    beats = reduce(and_, (b >= a for b, a in pairs)) & reduce(or_, (b > a for b, a in pairs))
    return df.alias("a").join(df.alias("b"), beats, "left_anti")


def _skyline_tag_genre(t: Tables) -> DataFrame:
    uses = _tag_genre(t)
    popular = (
        uses.join(_item_ratings(t), "movie_id").groupBy("genre", "tag")
        .agg(F.count_distinct("avg_rating").alias("n"),
             fixed(F.avg("avg_rating"), P.COMPARE_SCALE).alias("avg_rating"))
        .filter(F.col("n") > P.MIN_DISTINCT)
    )
    users = uses.groupBy("genre", "tag").agg(F.count_distinct("user_id").alias("user_count"))
    same = (popular["genre"] == users["genre"]) & popular["tag"].eqNullSafe(users["tag"])
    points = popular.join(users, same).select(
        popular["genre"], popular["tag"], "avg_rating", "user_count"
    )
    return _skyline(points, ["avg_rating", "user_count"])


def _movie_stats(t: Tables) -> DataFrame:
    rated = t.ratings.groupBy("movie_id").agg(
        F.avg("rating").alias("avg_rating"), F.count("rating").alias("rating_count")
    )
    scored = t.genome_scores.groupBy("movie_id").agg(F.avg("relevance").alias("avg_relevance"))
    return rated.join(scored, "movie_id")


def _skyline_movies(t: Tables) -> DataFrame:
    return _skyline(_movie_stats(t), ["avg_rating", "rating_count", "avg_relevance"])


def _cosines(t: Tables) -> DataFrame:
    target = t.genome_scores.filter(F.col("movie_id") == P.TARGET).select("tag_id", "relevance")
    profile = (
        t.ratings.filter(F.col("rating") > P.MIN_LIKED).select("user_id", "movie_id")
        .join(t.genome_scores, "movie_id")
        .groupBy("user_id", "tag_id").agg(F.avg("relevance").alias("score"))
    )
    sums = profile.join(target, "tag_id").groupBy("user_id").agg(
        F.sum(F.col("score") * F.col("relevance")).alias("dot"),
        F.sum(F.col("score") * F.col("score")).alias("user"),
        F.sum(F.col("relevance") * F.col("relevance")).alias("target"),
    )
    return sums.select(
        "user_id",
        F.try_divide("dot", F.sqrt("user") * F.sqrt("target")).alias("cosine_similarity"),
    )


def _topk(t: Tables) -> DataFrame:
    order = [F.desc_nulls_last("cosine_similarity"), F.asc("user_id")]
    best = _cosines(t).withColumn(
        "cosine_similarity", fixed(F.col("cosine_similarity"), P.SCALE)
    ).orderBy(*order).limit(P.TOP_K)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def _overhyped(t: Tables) -> DataFrame:
    return (
        t.genome_tags.filter(F.col("tag").isin(*P.ANOMALY_TAGS)).join(t.genome_scores, "tag_id")
        .groupBy("movie_id").agg(F.avg("relevance").alias("avg_relevance_to_tags"))
        .filter(F.col("avg_relevance_to_tags") >= P.MIN_TAG_SCORE)
        .join(_item_ratings(t), "movie_id").filter(F.col("avg_rating") < P.MAX_RATING)
        .withColumnRenamed("avg_rating", "avg_rating_per_movie")
    )


PLAIN = {
    name: _query(lambda _, t, build=build: build(t))
    for name, build in {
        "iceberg_tag_genre": _iceberg,
        "dominant_tag_per_genre": _dominant,
        "tag_sentiment": _sentiment,
        "skyline_tag_genre": _skyline_tag_genre,
        "skyline_movies": _skyline_movies,
        "user_target_cosine": _cosines,
        "overhyped_movies": _overhyped,
        "topk_users": _topk,
    }.items()
}
