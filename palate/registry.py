"""Every query by name: Spark callables over the test tables, and their SQL twins.

The callables only fix parameters, report averages at a fixed number of decimals and
bring relevance from basis points to 0..1. All work is done by ``plans`` and
``operators``, over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate import parameters as P
from palate.functions.numeric import fixed
from palate.operators import profiles, skyline, spread_join
from palate.operators.joins import Spread
from palate.operators.staging import staging_path
from palate.oracle import ORACLE
from palate.plans import blocks, workloads
from palate.sinks import write_csv
from palate.sources import Tables, read_csv, read_csv_checked, read_result
from palate.sources.canonical import canonical

Query = Callable[[SparkSession, str], DataFrame]

_UNITS = {
    "avg_relevance": P.RELEVANCE_SCALE,
    "avg_tag_relevance_per_movie": P.RELEVANCE_SCALE,
    "avg_relevance_to_tags": P.RELEVANCE_SCALE,
    "avg_tag_relevance_per_user": P.RELEVANCE_SCALE,
    "dot_product": P.RELEVANCE_SCALE**2,
    "user_norm_sqr": P.RELEVANCE_SCALE**2,
    "target_norm_sqr": P.RELEVANCE_SCALE**2,
}
_AVERAGES = {"avg_rating", "avg_rating_per_movie", "cosine_similarity", "pearson", *_UNITS}


def _reported(df: DataFrame) -> DataFrame:
    return df.select(
        *(
            fixed(F.col(name) / _UNITS.get(name, 1.0), P.SCALE).alias(name)
            if name in _AVERAGES
            else F.col(name)
            for name in df.columns
        )
    )


def _csv_roundtrip(spark: SparkSession, table: str, df: DataFrame) -> DataFrame:
    path = staging_path(spark, f"csv-{table}")
    write_csv(df, path)
    return read_csv(spark, table, path)


def _csv_reordered(spark: SparkSession, t: Tables) -> DataFrame:
    path = staging_path(spark, "csv-reordered")
    write_csv(t.movies.select("genres", F.lit("x").alias("year"), "movie_id", "title"), path)
    return read_csv(spark, "movies", path)


def _csv_quarantine(spark: SparkSession, t: Tables) -> DataFrame:
    """Ratings as raw lines, some of which do not fit: the rows that do, and the others as they are."""
    path, pair = staging_path(spark, "csv-quarantine"), F.concat_ws(",", "user_id", "movie_id")
    rating = F.col("rating")
    line = (
        F.when(rating.isNull(), F.concat(pair, F.lit(",n/a")))
        .when(rating == 5.0, pair)
        .when(rating == 0.5, F.concat(pair, F.lit(",0.5,,")))
        .otherwise(F.concat(pair, F.lit(","), rating.cast("string")))
    )
    t.ratings.select(line.alias("value")).write.text(path)
    checked = read_csv_checked(spark, "ratings", path, header=False)
    return checked.rows.unionByName(checked.bad_lines.select("line"), allowMissingColumns=True)


def _csv_line_breaks(spark: SparkSession, t: Tables) -> DataFrame:
    path, tag = staging_path(spark, "csv-line-breaks"), F.col("tag")
    for old, new in (("/", "\n"), ("-", "\\"), (" ", "\r\n")):
        tag = F.replace(tag, F.lit(old), F.lit(new))
    write_csv(t.tags.withColumn("tag", tag), path, line_breaks="escape")
    return read_csv(spark, "tags", path, escaped=True)


def _csv_overwrite(spark: SparkSession, t: Tables) -> DataFrame:
    path = staging_path(spark, "csv-overwrite")
    write_csv(t.genome_tags, path)
    write_csv(t.movies, path)
    return read_csv(spark, "movies", path)


def _csv_fail_if_present(spark: SparkSession, t: Tables) -> DataFrame:
    path = staging_path(spark, "csv-present")
    write_csv(t.movies, path, "errorifexists")
    try:
        write_csv(t.genome_tags, path, "errorifexists")
    except AnalysisException:
        return read_csv(spark, "movies", path)
    raise RuntimeError(f"{path} was written twice")


def _csv_single_file(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    path = staging_path(spark, f"csv-{name}")
    write_csv(df, path, single_file=True)
    back = read_result(spark, ", ".join(f"{column} {kind}" for column, kind in df.dtypes), path)
    if len(back.inputFiles()) != 1:
        raise RuntimeError(f"{path} has {len(back.inputFiles())} files")
    return back


def _pairs_skyline(t: Tables, dims: list[str]) -> DataFrame:
    points = blocks.user_movie_points(t.ratings, t.genome_scores)
    points = points.select("user_id", "movie_id", *dims)
    return skyline(points, dims)


def _cosines(t: Tables) -> DataFrame:
    return workloads.user_target_cosine(t.ratings, t.genome_scores, P.TARGET, P.MIN_LIKED)


_BUILDERS: dict[str, Callable[[SparkSession, Tables], DataFrame]] = {
    # workloads
    "iceberg_tag_genre": lambda _, t: workloads.iceberg_tag_genre(
        t.tags, t.movies, t.ratings, P.MIN_COUNT, P.MIN_AVG, compare_scale=P.COMPARE_SCALE
    ),
    "dominant_tag_per_genre": lambda _, t: workloads.dominant_tag_per_genre(
        t.tags, t.movies, t.ratings
    ),
    "iceberg_relevant_tags": lambda _, t: workloads.iceberg_relevant_tags(
        t.genome_scores, t.genome_tags, P.MIN_SCORE, P.MIN_MOVIES, P.MIN_AVG_SCORE
    ),
    "tag_sentiment": lambda _, t: workloads.tag_sentiment(None, None, facts=t.facts),
    "skyline_tag_genre": lambda _, t: workloads.skyline_tag_genre(
        t.tags, t.movies, t.ratings, P.MIN_DISTINCT, compare_scale=P.COMPARE_SCALE
    ),
    "skyline_movies": lambda _, t: workloads.skyline_movies(t.ratings, t.genome_scores),
    "corr_relevance_rating": lambda _, t: workloads.corr_relevance_rating(
        t.ratings, t.genome_scores
    ),
    "movie_rating_relevance": lambda _, t: workloads.movie_rating_relevance(
        t.ratings, t.genome_scores
    ),
    "user_target_cosine": lambda _, t: _cosines(t),
    "overhyped_movies": lambda _, t: workloads.overhyped_movies(
        t.genome_scores, t.genome_tags, t.ratings, P.ANOMALY_TAGS, P.MIN_TAG_SCORE, P.MAX_RATING
    ),
    "topk_users": lambda _, t: workloads.topk_users(_cosines(t), P.TOP_K, compare_scale=P.SCALE),
    # sources and sinks
    "scan_csv_movies": lambda s, t: _csv_roundtrip(s, "movies", t.movies),
    "scan_csv_ratings": lambda s, t: _csv_roundtrip(s, "ratings", t.ratings),
    "scan_csv_tags": lambda s, t: _csv_roundtrip(s, "tags", t.tags),
    "scan_csv_genome_tags": lambda s, t: _csv_roundtrip(s, "genome_tags", t.genome_tags),
    "scan_csv_reordered": _csv_reordered,
    "sink_csv_roundtrip": lambda s, t: _csv_roundtrip(s, "genome_scores", t.genome_scores),
    "scan_csv_quarantine": _csv_quarantine,
    "sink_csv_line_breaks": _csv_line_breaks,
    "sink_csv_overwrite": _csv_overwrite,
    "sink_csv_fail_if_present": _csv_fail_if_present,
    "sink_csv_scalar": lambda s, t: _csv_single_file(
        s, "scalar", workloads.corr_relevance_rating(t.ratings, t.genome_scores)
    ),
    "sink_csv_single_file": lambda s, t: _csv_single_file(
        s, "single-file", blocks.movie_rating_stats(t.ratings)
    ),
    # projections and filters
    "movie_tag_pairs": lambda _, t: blocks.movie_tag_pairs(t.tags),
    "movie_genre_pairs": lambda _, t: blocks.movie_genre_pairs(t.movies),
    "liked_movies": lambda _, t: profiles.liked_items(t.ratings, P.MIN_LIKED),
    "target_tag_profile": lambda _, t: profiles.target_vector(t.genome_scores, P.TARGET),
    # joins
    "movie_tag_genre": lambda _, t: blocks.movie_tag_genre(t.tags, t.movies),
    "tag_rating_pairs": lambda _, t: blocks.tag_rating_pairs(t.facts),
    "movie_stats": lambda _, t: blocks.movie_stats(t.ratings, t.genome_scores),
    "dominated_tag_genre": lambda _, t: workloads.dominated_tag_genre(
        t.tags, t.movies, t.ratings, P.MIN_DISTINCT, compare_scale=P.COMPARE_SCALE
    ),
    # aggregations
    "avg_rating_per_movie": lambda _, t: blocks.avg_rating_per_movie(t.ratings),
    "genre_tag_counts": lambda _, t: blocks.genre_tag_counts(
        blocks.tag_genre_uses(t.tags, blocks.genre_items(t.movies))
    ),
    "most_used_tag_per_genre": lambda _, t: blocks.most_used_tag_per_genre(
        blocks.genre_tag_counts(blocks.tag_genre_uses(t.tags, blocks.genre_items(t.movies)))
    ),
    "users_per_genre_tag": lambda _, t: blocks.users_per_genre_tag(
        t.tags, blocks.genre_items(t.movies)
    ),
    "movie_rating_stats": lambda _, t: blocks.movie_rating_stats(t.ratings),
    "avg_relevance_per_movie": lambda _, t: blocks.avg_relevance_per_movie(t.genome_scores),
    "user_tag_profile": lambda _, t: profiles.user_profiles(
        t.ratings, t.genome_scores, P.MIN_LIKED
    ),
    "cosine_components": lambda _, t: profiles.cosine_components(
        t.ratings, t.genome_scores, P.TARGET, P.MIN_LIKED, blocked=True
    ),
    # the forms for large inputs, on any input
    "skyline_pairs_2d": lambda _, t: _pairs_skyline(t, ["avg_rating", "avg_relevance"]),
    "skyline_pairs_3d": lambda _, t: _pairs_skyline(
        t, ["avg_rating", "n_ratings", "avg_relevance"]
    ),
    "cosine_components_long": lambda _, t: profiles.cosine_components(
        t.ratings, t.genome_scores, P.TARGET, P.MIN_LIKED, blocked=False
    ),
    "tag_uses_cut_join": lambda _, t: spread_join(
        blocks.movie_tag_uses(t.tags), blocks.tag_totals(t.tags), ["tag"],
        spread=Spread(share=1 / 64, min_rows=0),
    ).select("movie_id", "tag", "n_uses", "n_all"),
    # set-like
    "genre_tag_users": lambda _, t: blocks.genre_tag_users(t.tags, blocks.genre_items(t.movies)),
}


def _query(build: Callable[[SparkSession, Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: _reported(build(spark, canonical(spark, sf_dir)))


QUERIES: dict[str, Query] = {name: _query(build) for name, build in _BUILDERS.items()}

__all__ = ["ORACLE", "QUERIES"]
