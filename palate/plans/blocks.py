"""Building blocks shared by the workloads: DataFrames in, one lazy DataFrame out.

Building a frame runs no job. Joins are plain: adaptive execution broadcasts a side that
turns out small and splits the partitions of a hot key. Where both sides of a join can
hold many equal rows, they are folded into one row with a count column first, so that a
pair repeated a billion times costs one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palate.functions.genres import explode_genres
from palate.functions.numeric import fixed, weighted_mean
from palate.operators.aggregates import argmax_per_group


def movie_tag_pairs(tags: DataFrame) -> DataFrame:
    """(movie_id, tag) of every tag application, repeats kept."""
    return tags.select("movie_id", "tag")


def movie_genre_pairs(movies: DataFrame) -> DataFrame:
    """(movie_id, genre), one row per genre of a movie."""
    return explode_genres(movies.select("movie_id", "genres"))


def avg_rating_per_movie(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movie_id").agg(F.avg("rating").alias("avg_rating"))


def movie_rating_stats(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movie_id").agg(
        F.avg("rating").alias("avg_rating"), F.count("rating").alias("rating_count")
    )


def avg_relevance_per_movie(scores: DataFrame) -> DataFrame:
    return scores.groupBy("movie_id").agg(F.avg("relevance").alias("avg_relevance"))


def movie_stats(
    ratings: DataFrame, scores: DataFrame, rating_stats: DataFrame | None = None
) -> DataFrame:
    """Rating average, rating count and relevance average of movies that have both."""
    rating_stats = movie_rating_stats(ratings) if rating_stats is None else rating_stats
    return rating_stats.join(avg_relevance_per_movie(scores), "movie_id")


def movie_tag_uses(tags: DataFrame) -> DataFrame:
    """(movie_id, tag, n_uses): how often each tag was applied to each movie."""
    return tags.groupBy("movie_id", "tag").agg(F.count(F.lit(1)).alias("n_uses"))


def genre_items(movies: DataFrame, item_ratings: DataFrame | None = None) -> DataFrame:
    """(movie_id, genre), to be met by tag applications.

    With ``item_ratings`` (movie_id, avg_rating) rows also carry the movie's average,
    NULL for an unrated movie.
    """
    items = movie_genre_pairs(movies)
    if item_ratings is not None:
        items = items.join(item_ratings, "movie_id", "left")
    return items


def tag_genre_uses(tags: DataFrame, items: DataFrame) -> DataFrame:
    """Tags and genres meeting on a movie: user_id, movie_id, tag, n_uses and the columns of ``items``.

    A (user_id, movie_id, tag, genre) may come in several rows whose ``n_uses`` add up.
    """
    uses = tags.select("user_id", "movie_id", "tag").withColumn("n_uses", F.lit(1).cast("bigint"))
    return uses.join(items, "movie_id")


def movie_tag_genre(tags: DataFrame, movies: DataFrame) -> DataFrame:
    """Tags and genres meeting on a movie, one row each: movie_id, tag, genre, n_uses."""
    joined = movie_tag_uses(tags).join(genre_items(movies), "movie_id")
    return joined.select("movie_id", "tag", "genre", "n_uses")


def genre_tag_stats(uses: DataFrame, compare_scale: int | None = None) -> DataFrame:
    """Everything the tag and genre queries ask of a pair, from rated ``tag_genre_uses``.

    ``n_uses`` counts all applications, ``n_rated`` those on rated movies; ``avg_rating``
    is the applications' mean of the movies' averages, ``n_distinct`` the number of
    different averages among them, and ``user_count`` how many different users applied the tag, to
    rated movies or others. Tags meet the items once for all of them; a query that leaves a column
    out does not pay for it.
    """
    rated = F.when(F.col("avg_rating").isNotNull(), F.col("n_uses"))
    return uses.groupBy("genre", "tag").agg(
        F.sum("n_uses").alias("n_uses"),
        F.coalesce(F.sum(rated), F.lit(0)).alias("n_rated"),
        F.count_distinct(fixed(F.col("avg_rating"), compare_scale)).alias("n_distinct"),
        F.count_distinct("user_id").alias("user_count"),
        fixed(weighted_mean("avg_rating", "n_uses"), compare_scale).alias("avg_rating"),
    )


def genre_tag_counts(uses: DataFrame) -> DataFrame:
    """(genre, tag, n_uses) from ``tag_genre_uses`` rows; unrated movies count too."""
    return uses.groupBy("genre", "tag").agg(F.sum("n_uses").alias("n_uses"))


def most_used_tag_per_genre(counts: DataFrame) -> DataFrame:
    """(genre, tag, n_uses) of the most used tag; ties go to the first tag, NULL last."""
    return argmax_per_group(counts, ["genre"], "n_uses", ["tag"])


def genre_tag_users(tags: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (genre, tag, user_id)."""
    joined = tags.select("user_id", "movie_id", "tag").join(items, "movie_id")
    return joined.select("genre", "tag", "user_id").distinct()


def users_per_genre_tag(tags: DataFrame, items: DataFrame) -> DataFrame:
    """(genre, tag, user_count): how many different users applied the tag."""
    users = genre_tag_users(tags, items)
    return users.groupBy("genre", "tag").agg(F.count("user_id").alias("user_count"))


def user_movie_points(ratings: DataFrame, scores: DataFrame) -> DataFrame:
    """user_id, movie_id and what a skyline of such pairs compares: avg_rating, n_ratings, avg_relevance."""
    rated = ratings.groupBy("user_id", "movie_id").agg(
        F.avg("rating").alias("avg_rating"), F.count("rating").alias("n_ratings")
    )
    return rated.join(avg_relevance_per_movie(scores), "movie_id")


def tag_totals(tags: DataFrame) -> DataFrame:
    """(tag, n_all): all applications of each tag."""
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n_all"))


def facts(tags: DataFrame, ratings: DataFrame) -> DataFrame:
    """What is known of a user and a movie, tags and ratings in one frame: user_id, movie_id, tag,
    rating, and how many applications (``n_tags``) and ratings (``n_ratings``) a row stands for.

    A row may be both, one tag and one rating; a row without an application has ``n_tags`` 0, whatever its
    tag, and likewise for ratings.
    """
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    pair = ["user_id", "movie_id"]
    applied = tags.select(*pair, "tag", F.lit(None).cast("double").alias("rating"), one.alias("n_tags"), none.alias("n_ratings"))
    rated = ratings.select(*pair, F.lit(None).cast("string").alias("tag"), "rating", none.alias("n_tags"), one.alias("n_ratings"))
    return applied.unionByName(rated)


def tags_with_ratings(known: DataFrame) -> DataFrame:
    """The tags of ``facts`` with the ratings of the same user and movie: tag, n_tags, and the sum and number
    of the pair's ratings that are not NULL. A row per pair and tag, of pairs that have a rating.

    Tags and ratings meet in one grouping instead of a join. Repeats are counted before the shuffle, and
    the window over a pair sees its different tags only. As in a join, a NULL user or movie meets nothing.
    """
    pair = ["user_id", "movie_id"]
    known = known.filter(F.col("user_id").isNotNull() & F.col("movie_id").isNotNull())
    given = F.when(F.col("n_ratings") > 0, F.col("rating"))
    folded = known.groupBy(*pair, "tag").agg(
        F.sum("n_tags").alias("n_tags"),
        F.sum(given * F.col("n_ratings")).alias("rating_sum"),
        F.sum(F.when(given.isNotNull(), F.col("n_ratings")).otherwise(0)).alias("n_rated"),
        F.sum("n_ratings").alias("n_ratings"),
    )
    whole = Window.partitionBy(*pair)
    sums = [F.sum(name).over(whole).alias(name) for name in ("rating_sum", "n_rated", "n_ratings")]
    met = folded.select("tag", "n_tags", *sums)
    return met.filter((F.col("n_tags") > 0) & (F.col("n_ratings") > 0)).drop("n_ratings")


def tag_rating_pairs(known: DataFrame) -> DataFrame:
    """Tags meeting ratings of the same user and movie, from ``facts``.

    Output: user_id, movie_id, tag, rating, n_pairs. ``n_pairs`` is how many
    (application, rating) pairs the row stands for; they are never listed one by one, and nothing
    is joined: a pair's different tags and ratings come together in one grouping.
    """
    pair = ["user_id", "movie_id"]
    known = known.filter(F.col("user_id").isNotNull() & F.col("movie_id").isNotNull())
    kinds = F.array(
        F.struct(F.lit(True).alias("is_tag"), F.col("tag").alias("tag"), F.lit(None).cast("double").alias("rating"), F.col("n_tags").alias("n")),
        F.struct(F.lit(False).alias("is_tag"), F.lit(None).cast("string").alias("tag"), F.col("rating").alias("rating"), F.col("n_ratings").alias("n")),
    )
    single = known.select(*pair, F.inline(kinds)).filter("n > 0")
    counted = single.groupBy(*pair, "is_tag", "tag", "rating").agg(F.sum("n").alias("n"))
    met = counted.groupBy(*pair).agg(
        F.collect_list(F.when(F.col("is_tag"), F.struct("tag", "n"))).alias("tags"),
        F.collect_list(F.when(~F.col("is_tag"), F.struct("rating", "n"))).alias("ratings"),
    )
    one = met.select(*pair, "ratings", F.explode("tags").alias("t")).select(*pair, "t", F.explode("ratings").alias("r"))
    return one.select(*pair, "t.tag", "r.rating", (F.col("t.n") * F.col("r.n")).alias("n_pairs"))
