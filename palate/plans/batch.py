"""All ten queries in one run, with the frames they share computed once."""

from __future__ import annotations

from collections.abc import Sequence

from palate.operators.staging import stage
from palate.plans import blocks, workloads
from palate.sinks import write_csv
from palate.sources import Tables

# Fixed value: the published target movie of the similarity queries.
TARGET_MOVIE = "79132"


def run_all(
    tables: Tables,
    out: str,
    *,
    target_movie_id: str = TARGET_MOVIE,
    k: int = 10,
    anomaly_tags: Sequence[str] = workloads.ANOMALY_TAGS,
    mode: str = "overwrite",
    line_breaks: str = "reject",
) -> dict[str, str]:
    """Write each result as a CSV folder below ``out``; returns name -> path."""
    t, root = tables, out.rstrip("/")
    written: dict[str, str] = {}

    def save(name: str, df, *, single_file: bool = False) -> None:
        written[name] = f"{root}/{name}"
        write_csv(df, written[name], mode, single_file=single_file, line_breaks=line_breaks)

    # Ratings meet by movie once; only the averages and counts of movies are dealt again.
    rating_stats = stage(blocks.movie_rating_stats(t.ratings), "rating-stats")
    item_ratings = rating_stats.select("movie_id", "avg_rating")
    items = blocks.genre_items(t.movies, item_ratings)
    stats = stage(workloads.genre_tag_stats(t.tags, items), "genre-tag-stats")
    save("iceberg_tag_genre", workloads.iceberg_tag_genre(t.tags, t.movies, t.ratings, stats=stats))
    save(
        "dominant_tag_per_genre",
        workloads.dominant_tag_per_genre(t.tags, t.movies, t.ratings, stats=stats),
    )
    save("iceberg_relevant_tags", workloads.iceberg_relevant_tags(t.genome_scores, t.genome_tags))
    save("tag_sentiment", workloads.tag_sentiment(t.tags, t.ratings))
    save(
        "skyline_tag_genre",
        workloads.skyline_tag_genre(t.tags, t.movies, t.ratings, stats=stats),
    )

    movie_stats = stage(
        blocks.movie_stats(t.ratings, t.genome_scores, rating_stats), "movie-stats"
    )
    save("skyline_movies", workloads.skyline_movies(t.ratings, t.genome_scores, stats=movie_stats))
    save(
        "corr_relevance_rating",
        workloads.corr_relevance_rating(t.ratings, t.genome_scores, stats=movie_stats),
        single_file=True,
    )
    save(
        "movie_rating_relevance",
        workloads.movie_rating_relevance(t.ratings, t.genome_scores, stats=movie_stats),
    )

    cosines = stage(
        workloads.user_target_cosine(t.ratings, t.genome_scores, target_movie_id), "cosines"
    )
    save("user_target_cosine", cosines)
    save(
        "overhyped_movies",
        workloads.overhyped_movies(
            t.genome_scores, t.genome_tags, t.ratings, anomaly_tags, item_ratings=item_ratings
        ),
    )
    save("topk_users", workloads.topk_users(cosines, k), single_file=True)
    return written
