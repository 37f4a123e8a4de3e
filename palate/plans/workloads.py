"""The ten analytic queries, parameterised. Defaults are the published thresholds.

``compare_scale`` rounds an average of averages before it is compared; ``None``
compares the plain double. Frames that several queries share can be passed in, so
that a batch computes them once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.functions.numeric import fixed, pearson
from palate.operators.aggregates import iceberg
from palate.operators.profiles import cosine_components, cosine_to_target
from palate.operators.ranking import topk_ranked
from palate.operators.skyline import dominated, skyline
from palate.plans import blocks

# The published tag choice of the anomaly query.
ANOMALY_TAGS = ("action", "classic", "thriller")


def rated_items(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """The movie side of the three tag and genre queries: movie_id, genre, avg_rating."""
    return blocks.genre_items(movies, blocks.avg_rating_per_movie(ratings))


def genre_tag_stats(
    tags: DataFrame, items: DataFrame, *, compare_scale: int | None = None
) -> DataFrame:
    """The frame behind the three tag and genre queries; see ``blocks.genre_tag_stats``."""
    return blocks.genre_tag_stats(blocks.tag_genre_uses(tags, items), compare_scale)


def iceberg_tag_genre(
    tags: DataFrame,
    movies: DataFrame,
    ratings: DataFrame,
    min_count: int = 100,
    min_avg: float = 4.0,
    *,
    compare_scale: int | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Tag and genre pairs with many applications on well-rated movies.

    Support counts tag applications to rated movies, not movies, and the average of
    the movies' averages is weighted by applications too. Output: tag, genre, avg_rating.
    """
    if stats is None:
        stats = genre_tag_stats(tags, rated_items(movies, ratings), compare_scale=compare_scale)
    frequent = stats.filter(F.col("n_rated") > min_count)
    return frequent.filter(F.col("avg_rating") > min_avg).select("tag", "genre", "avg_rating")


def dominant_tag_per_genre(
    tags: DataFrame, movies: DataFrame, ratings: DataFrame, *, stats: DataFrame | None = None
) -> DataFrame:
    """Each genre's most used tag with the average rating of the movies it is on.

    Uses on unrated movies count for the choice but not for the average; a genre whose
    tag has no rated movie drops out. Output: tag, genre, avg_rating.
    """
    stats = genre_tag_stats(tags, rated_items(movies, ratings)) if stats is None else stats
    counted = stats.select("genre", "tag", "n_uses", "avg_rating")
    return (
        blocks.most_used_tag_per_genre(counted)
        .filter("avg_rating IS NOT NULL")
        .select("tag", "genre", "avg_rating")
    )


def iceberg_relevant_tags(
    genome_scores: DataFrame,
    genome_tags: DataFrame,
    min_relevance: float = 0.6,
    min_movies: int = 100,
    min_avg: float = 0.8,
) -> DataFrame:
    """Tags that are relevant to many movies, and strongly so.

    Scores up to ``min_relevance`` are dropped first, so they enter neither the movie
    count nor the average. Grouped by tag id: two ids with one label give two rows.
    Output: tag, avg_relevance.
    """
    strong = iceberg(
        genome_scores.filter(F.col("relevance") > min_relevance),
        ["tag_id"],
        F.count_distinct("movie_id"),
        min_movies,
        F.avg("relevance"),
        min_avg,
        measure_name="avg_relevance",
    )
    return strong.join(genome_tags, "tag_id").select("tag", "avg_relevance")


def tag_sentiment(
    tags: DataFrame | None,
    ratings: DataFrame | None,
    dedupe: bool = False,
    *,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Mean rating per tag, over ratings by the tagging user of the tagged movie.

    Repeated applications count repeatedly unless ``dedupe``. Tags and ratings go into one grouping by
    user and movie, so a pair with many tags and many ratings costs their sum, not their
    product. Where both come from one table, ``facts`` (see ``blocks.facts``) lets it be read once.
    Output: tag, avg_rating.
    """
    applied = blocks.tags_with_ratings(blocks.facts(tags, ratings) if facts is None else facts)
    times = F.lit(1) if dedupe else F.col("n_tags")
    return applied.groupBy("tag").agg(
        F.try_divide(F.sum(F.col("rating_sum") * times), F.sum(F.col("n_rated") * times)).alias("avg_rating")
    )


def genre_tag_points(
    tags: DataFrame,
    movies: DataFrame,
    ratings: DataFrame,
    min_distinct: int = 200,
    *,
    compare_scale: int | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """The (genre, tag) pairs a skyline chooses from: genre, tag, avg_rating, user_count.

    Kept are pairs with more than ``min_distinct`` different movie *averages*. Users
    count whether or not their movie is rated. Both distinct counts come out of one grouping.
    """
    if stats is None:
        stats = genre_tag_stats(tags, rated_items(movies, ratings), compare_scale=compare_scale)
    popular = stats.filter(F.col("n_distinct") > min_distinct)
    return popular.select("genre", "tag", "avg_rating", "user_count")


def skyline_tag_genre(
    tags: DataFrame, movies: DataFrame, ratings: DataFrame, min_distinct: int = 200, **options
) -> DataFrame:
    """Pairs that no pair beats in both average rating and tagging users."""
    points = genre_tag_points(tags, movies, ratings, min_distinct, **options)
    return skyline(points, ["avg_rating", "user_count"])


def dominated_tag_genre(
    tags: DataFrame, movies: DataFrame, ratings: DataFrame, min_distinct: int = 200, **options
) -> DataFrame:
    """The pairs that the skyline leaves out: genre, tag."""
    points = genre_tag_points(tags, movies, ratings, min_distinct, **options)
    return dominated(points, ["avg_rating", "user_count"]).select("genre", "tag")


def skyline_movies(
    ratings: DataFrame, genome_scores: DataFrame, *, stats: DataFrame | None = None
) -> DataFrame:
    """Movies that no movie beats in rating average, rating count and relevance."""
    stats = blocks.movie_stats(ratings, genome_scores) if stats is None else stats
    return skyline(stats, ["avg_rating", "rating_count", "avg_relevance"])


def movie_rating_relevance(
    ratings: DataFrame, genome_scores: DataFrame, *, stats: DataFrame | None = None
) -> DataFrame:
    """movie_id, avg_rating_per_movie, avg_tag_relevance_per_movie."""
    stats = blocks.movie_stats(ratings, genome_scores) if stats is None else stats
    return stats.select(
        "movie_id",
        F.col("avg_rating").alias("avg_rating_per_movie"),
        F.col("avg_relevance").alias("avg_tag_relevance_per_movie"),
    )


def corr_relevance_rating(
    ratings: DataFrame, genome_scores: DataFrame, *, stats: DataFrame | None = None
) -> DataFrame:
    """One row: the Pearson correlation of the two averages over all movies."""
    averages = movie_rating_relevance(ratings, genome_scores, stats=stats)
    return averages.agg(
        pearson("avg_rating_per_movie", "avg_tag_relevance_per_movie").alias("pearson")
    )


def user_target_cosine(
    ratings: DataFrame, genome_scores: DataFrame, target_movie_id: str, min_rating: float = 4.0
) -> DataFrame:
    """How close each user's profile is to one movie: user_id, cosine_similarity.

    Users without a liked, scored movie are absent, as is everyone for an unknown
    movie. The target itself may be among a user's liked movies.
    """
    return cosine_to_target(
        cosine_components(ratings, genome_scores, target_movie_id, min_rating)
    )


def overhyped_movies(
    genome_scores: DataFrame,
    genome_tags: DataFrame,
    ratings: DataFrame,
    tags: Sequence[str] = ANOMALY_TAGS,
    min_relevance: float = 0.8,
    max_rating: float = 2.5,
    *,
    item_ratings: DataFrame | None = None,
) -> DataFrame:
    """Movies that suit the chosen tags but are rated badly.

    Tag labels match case-sensitively; the average runs over those of the tags that
    have a score. Output: movie_id, avg_relevance_to_tags, avg_rating_per_movie.
    """
    chosen = genome_tags.filter(F.col("tag").isin(*tags)).select("tag_id")
    relevant = (
        genome_scores.join(chosen, "tag_id")
        .groupBy("movie_id")
        .agg(F.avg("relevance").alias("avg_relevance_to_tags"))
        .filter(F.col("avg_relevance_to_tags") >= min_relevance)
    )
    if item_ratings is None:
        item_ratings = blocks.avg_rating_per_movie(ratings)
    badly_rated = item_ratings.filter(F.col("avg_rating") < max_rating)
    return relevant.join(badly_rated, "movie_id").select(
        "movie_id", "avg_relevance_to_tags", F.col("avg_rating").alias("avg_rating_per_movie")
    )


def topk_users(cosines: DataFrame, k: int = 10, *, compare_scale: int | None = None) -> DataFrame:
    """The ``k`` most similar users: user_id, cosine_similarity, rank."""
    scored = cosines.withColumn(
        "cosine_similarity", fixed(F.col("cosine_similarity"), compare_scale)
    )
    return topk_ranked(scored, "cosine_similarity", k, ["user_id"])
