"""DuckDB SQL for every registered query, in the plain form of each definition.

The SQL joins, groups and compares row by row as the query is defined. It shares
none of the library's rewrites (folded repeats, spread joins, two-phase skyline).
"""

from __future__ import annotations

from palate import parameters as P
from palate.functions.numeric import EXACT, TIE_SHIFT

CANONICAL = """
movies AS (
  SELECT CAST(p_partkey AS VARCHAR) AS movie_id, p_name AS title,
         CASE WHEN p_size = 50 THEN '(no genres listed)'
              ELSE replace(p_name, ' ', '|') END AS genres
  FROM part),
order_lines AS (
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ratings AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id,
         CASE WHEN l_returnflag <> 'R' THEN ceil(l_quantity / 5) / 2 END AS rating
  FROM order_lines),
tags AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id,
         CASE WHEN NOT (o_orderpriority = '1-URGENT' AND l_returnflag = 'A')
              THEN o_orderpriority || '/' || l_returnflag || l_linestatus END AS tag
  FROM order_lines),
genome_scores AS (
  SELECT CAST(vec_id AS VARCHAR) AS movie_id, CAST(i - 1 AS VARCHAR) AS tag_id,
         CAST(floor((CAST(embedding[i] AS DOUBLE) + 1) * 5000) AS DOUBLE) AS relevance
  FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i
        FROM embeddings)),
genome_tags AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS tag_id, n_name AS tag FROM nation)"""

GENRES = """
movie_genre AS (
  SELECT movie_id, genre
  FROM (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies)
  WHERE genre <> '(no genres listed)')"""

AVERAGES = """
item_ratings AS (
  SELECT movie_id, avg(rating) AS avg_rating, count(rating) AS rating_count
  FROM ratings GROUP BY movie_id),
item_relevance AS (
  SELECT movie_id, avg(relevance) AS avg_relevance FROM genome_scores GROUP BY movie_id),
movie_stats AS (
  SELECT movie_id, avg_rating, rating_count, avg_relevance
  FROM item_ratings JOIN item_relevance USING (movie_id))"""

TAG_GENRE = """
tag_genre AS (
  SELECT tags.user_id, movie_id, tags.tag, movie_genre.genre
  FROM tags JOIN movie_genre USING (movie_id)),
tag_genre_rating AS (
  SELECT tag_genre.*, avg_rating FROM tag_genre JOIN item_ratings USING (movie_id)
  WHERE avg_rating IS NOT NULL)"""


def fixed(value: str, scale: int) -> str:
    """Twin of ``functions.fixed``."""
    unit, half = f"1e{scale}", f"CAST({0.5 + TIE_SHIFT} AS DOUBLE)"
    value = f"CAST({value} AS DOUBLE)"
    cut = f"floor({value} * {unit} + {half}) / {unit}"
    return f"(CASE WHEN abs({value} * {unit}) < {EXACT:.0f} THEN {cut} ELSE {value} END)"


def _r(value: str) -> str:
    return fixed(value, P.SCALE)


def _c(value: str) -> str:
    return fixed(value, P.COMPARE_SCALE)


GENRE_TAG_POINTS = f"""
popular AS (
  SELECT genre, tag, {_c('avg(avg_rating)')} AS avg_rating
  FROM tag_genre_rating GROUP BY genre, tag
  HAVING count(DISTINCT {_c('avg_rating')}) > {P.MIN_DISTINCT}),
tag_users AS (
  SELECT genre, tag, count(DISTINCT user_id) AS user_count
  FROM tag_genre GROUP BY genre, tag),
points AS (
  SELECT popular.genre, popular.tag, avg_rating, user_count
  FROM popular JOIN tag_users
    ON popular.genre = tag_users.genre AND popular.tag IS NOT DISTINCT FROM tag_users.tag),
beaten AS (
  SELECT a.genre, a.tag FROM points a
  WHERE EXISTS (SELECT 1 FROM points b
                WHERE b.avg_rating >= a.avg_rating AND b.user_count >= a.user_count
                  AND (b.avg_rating > a.avg_rating OR b.user_count > a.user_count)))"""

LIKED = f"""
liked AS (
  SELECT user_id, movie_id FROM ratings WHERE rating > {P.MIN_LIKED}),
profile AS (
  SELECT user_id, tag_id, avg(relevance) AS score
  FROM liked JOIN genome_scores USING (movie_id) GROUP BY user_id, tag_id)"""

COSINE = f"""
target AS (
  SELECT tag_id, relevance FROM genome_scores WHERE movie_id = '{P.TARGET}'),
components AS (
  SELECT user_id, sum(score * relevance) AS dot_product,
         sum(score * score) AS user_norm_sqr, sum(relevance * relevance) AS target_norm_sqr
  FROM profile JOIN target USING (tag_id) GROUP BY user_id),
cosines AS (
  SELECT user_id, {_r('dot_product / nullif(sqrt(user_norm_sqr) * sqrt(target_norm_sqr), 0)')}
         AS cosine_similarity
  FROM components)"""


def _with(body: str, *parts: str) -> str:
    return "WITH " + ",".join([CANONICAL, *parts]) + "\n" + body.strip()


PAIRS = """
pairs AS (
  SELECT user_id, movie_id, avg(rating) AS avg_rating, count(rating) AS n_ratings, avg_relevance
  FROM ratings JOIN item_relevance USING (movie_id)
  GROUP BY user_id, movie_id, avg_relevance)"""


def _skyline_sql(*dims: str) -> str:
    """Pairs that no pair beats, found on their distinct points."""
    names = ", ".join(dims)
    weak = " AND ".join(f"b.{d} >= a.{d}" for d in dims)
    strict = " OR ".join(f"b.{d} > a.{d}" for d in dims)
    same = " AND ".join(f"beaten.{d} = pairs.{d}" for d in dims)
    shown = [f"{_r(d)} AS {d}" if d == "avg_rating" else d for d in dims if d != "avg_relevance"]
    shown.append(f"{_r(f'avg_relevance / {P.RELEVANCE_SCALE}')} AS avg_relevance")
    return f"""
        SELECT user_id, movie_id, {', '.join(shown)} FROM pairs
        WHERE NOT EXISTS (
          SELECT 1 FROM (SELECT a.* FROM (SELECT DISTINCT {names} FROM pairs) a
                         WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT {names} FROM pairs) b
                                       WHERE {weak} AND ({strict}))) beaten
          WHERE {same})"""


_TAG_LIST = ", ".join(f"'{tag}'" for tag in P.ANOMALY_TAGS)
_SCALED = f"{P.RELEVANCE_SCALE}"
_SQUARE = f"{P.RELEVANCE_SCALE * P.RELEVANCE_SCALE}"

ORACLE: dict[str, str] = {
    # workloads
    "iceberg_tag_genre": _with(
        f"""
        SELECT tag, genre, {_r('avg_rating')} AS avg_rating
        FROM (SELECT tag, genre, count(*) AS n, {_c('avg(avg_rating)')} AS avg_rating
              FROM tag_genre_rating GROUP BY tag, genre)
        WHERE n > {P.MIN_COUNT} AND avg_rating > {P.MIN_AVG}""",
        GENRES, AVERAGES, TAG_GENRE,
    ),
    "dominant_tag_per_genre": _with(
        f"""
        SELECT tag, genre, {_r('avg(avg_rating)')} AS avg_rating
        FROM (SELECT genre AS g, tag AS t FROM (
                SELECT genre, tag, row_number() OVER (
                         PARTITION BY genre ORDER BY count(*) DESC, tag ASC NULLS LAST) AS place
                FROM tag_genre GROUP BY genre, tag)
              WHERE place = 1)
        JOIN tag_genre_rating ON genre = g AND tag IS NOT DISTINCT FROM t
        GROUP BY tag, genre""",
        GENRES, AVERAGES, TAG_GENRE,
    ),
    "iceberg_relevant_tags": _with(
        f"""
        SELECT tag, {_r(f'avg_relevance / {_SCALED}')} AS avg_relevance
        FROM (SELECT tag_id, avg(relevance) AS avg_relevance
              FROM genome_scores WHERE relevance > {P.MIN_SCORE}
              GROUP BY tag_id HAVING count(DISTINCT movie_id) > {P.MIN_MOVIES})
        JOIN genome_tags USING (tag_id)
        WHERE avg_relevance > {P.MIN_AVG_SCORE}"""
    ),
    "tag_sentiment": _with(
        f"""
        SELECT tag, {_r('avg(rating)')} AS avg_rating
        FROM tags JOIN ratings USING (user_id, movie_id) GROUP BY tag"""
    ),
    "skyline_tag_genre": _with(
        f"""
        SELECT genre, tag, {_r('avg_rating')} AS avg_rating, user_count FROM points
        WHERE NOT EXISTS (SELECT 1 FROM beaten WHERE beaten.genre = points.genre
                            AND beaten.tag IS NOT DISTINCT FROM points.tag)""",
        GENRES, AVERAGES, TAG_GENRE, GENRE_TAG_POINTS,
    ),
    "skyline_movies": _with(
        f"""
        SELECT movie_id, {_r('avg_rating')} AS avg_rating, rating_count,
               {_r(f'avg_relevance / {_SCALED}')} AS avg_relevance
        FROM movie_stats a
        WHERE NOT EXISTS (
          SELECT 1 FROM movie_stats b
          WHERE b.avg_rating >= a.avg_rating AND b.rating_count >= a.rating_count
            AND b.avg_relevance >= a.avg_relevance
            AND (b.avg_rating > a.avg_rating OR b.rating_count > a.rating_count
                 OR b.avg_relevance > a.avg_relevance))""",
        AVERAGES,
    ),
    "corr_relevance_rating": _with(
        f"SELECT {_r('corr(avg_rating, avg_relevance)')} AS pearson FROM movie_stats", AVERAGES
    ),
    "movie_rating_relevance": _with(
        f"""
        SELECT movie_id, {_r('avg_rating')} AS avg_rating_per_movie,
               {_r(f'avg_relevance / {_SCALED}')} AS avg_tag_relevance_per_movie
        FROM movie_stats""",
        AVERAGES,
    ),
    "user_target_cosine": _with("SELECT user_id, cosine_similarity FROM cosines", LIKED, COSINE),
    "overhyped_movies": _with(
        f"""
        SELECT movie_id, {_r(f'avg_relevance_to_tags / {_SCALED}')} AS avg_relevance_to_tags,
               {_r('avg_rating')} AS avg_rating_per_movie
        FROM (SELECT movie_id, avg(relevance) AS avg_relevance_to_tags
              FROM genome_scores JOIN genome_tags USING (tag_id)
              WHERE tag IN ({_TAG_LIST}) GROUP BY movie_id)
        JOIN item_ratings USING (movie_id)
        WHERE avg_relevance_to_tags >= {P.MIN_TAG_SCORE} AND avg_rating < {P.MAX_RATING}""",
        AVERAGES,
    ),
    "topk_users": _with(
        f"""
        SELECT user_id, cosine_similarity, row_number() OVER (
                 ORDER BY cosine_similarity DESC NULLS LAST, user_id) AS rank
        FROM cosines ORDER BY rank LIMIT {P.TOP_K}""",
        LIKED, COSINE,
    ),
    # sources and sinks
    "scan_csv_movies": _with("SELECT movie_id, title, genres FROM movies"),
    "scan_csv_ratings": _with("SELECT user_id, movie_id, rating FROM ratings"),
    "scan_csv_tags": _with("SELECT user_id, movie_id, tag FROM tags"),
    "sink_csv_roundtrip": _with("SELECT movie_id, tag_id, relevance FROM genome_scores"),
    "scan_csv_quarantine": _with(
        """
        SELECT CASE WHEN rating > 0.5 AND rating < 5 THEN user_id END AS user_id,
               CASE WHEN rating > 0.5 AND rating < 5 THEN movie_id END AS movie_id,
               CASE WHEN rating > 0.5 AND rating < 5 THEN rating END AS rating,
               CASE WHEN rating IS NULL THEN user_id || ',' || movie_id || ',n/a'
                    WHEN rating = 5 THEN user_id || ',' || movie_id
                    WHEN rating = 0.5 THEN user_id || ',' || movie_id || ',0.5,,' END AS line
        FROM ratings"""
    ),
    "sink_csv_line_breaks": _with(
        """
        SELECT user_id, movie_id,
               replace(replace(replace(tag, '/', chr(10)), '-', chr(92)), ' ', chr(13) || chr(10)) AS tag
        FROM tags"""
    ),
    "sink_csv_overwrite": _with("SELECT movie_id, title, genres FROM movies"),
    "sink_csv_fail_if_present": _with("SELECT movie_id, title, genres FROM movies"),
    "sink_csv_scalar": _with(
        f"SELECT {_r('corr(avg_rating, avg_relevance)')} AS pearson FROM movie_stats", AVERAGES
    ),
    "sink_csv_single_file": _with(
        f"SELECT movie_id, {_r('avg_rating')} AS avg_rating, rating_count FROM item_ratings",
        AVERAGES,
    ),
    # projections and filters
    "movie_tag_pairs": _with("SELECT movie_id, tag FROM tags"),
    "movie_genre_pairs": _with("SELECT movie_id, genre FROM movie_genre", GENRES),
    "liked_movies": _with("SELECT user_id, movie_id FROM liked", LIKED),
    "target_tag_profile": _with("SELECT tag_id, relevance FROM target", LIKED, COSINE),
    "scan_csv_genome_tags": _with("SELECT tag_id, tag FROM genome_tags"),
    "scan_csv_reordered": _with("SELECT movie_id, title, genres FROM movies"),
    # the forms for large inputs
    "skyline_pairs_2d": _with(_skyline_sql("avg_rating", "avg_relevance"), AVERAGES, PAIRS),
    "skyline_pairs_3d": _with(
        _skyline_sql("avg_rating", "n_ratings", "avg_relevance"), AVERAGES, PAIRS
    ),
    "cosine_components_long": _with(
        f"""
        SELECT user_id, {_r(f'dot_product / {_SQUARE}')} AS dot_product,
               {_r(f'user_norm_sqr / {_SQUARE}')} AS user_norm_sqr,
               {_r(f'target_norm_sqr / {_SQUARE}')} AS target_norm_sqr
        FROM components""",
        LIKED, COSINE,
    ),
    "tag_uses_cut_join": _with(
        """
        SELECT movie_id, tag, n_uses, n_all
        FROM (SELECT movie_id, tag, count(*) AS n_uses FROM tags GROUP BY movie_id, tag)
        JOIN (SELECT tag, count(*) AS n_all FROM tags GROUP BY tag) USING (tag)"""
    ),
    # joins
    "movie_tag_genre": _with(
        """
        SELECT movie_id, tag, genre, count(*) AS n_uses FROM tag_genre
        GROUP BY movie_id, tag, genre""",
        GENRES, AVERAGES, TAG_GENRE,
    ),
    "tag_rating_pairs": _with(
        """
        SELECT user_id, movie_id, tag, rating, count(*) AS n_pairs
        FROM tags JOIN ratings USING (user_id, movie_id)
        GROUP BY user_id, movie_id, tag, rating"""
    ),
    "movie_stats": _with(
        f"""
        SELECT movie_id, {_r('avg_rating')} AS avg_rating, rating_count,
               {_r(f'avg_relevance / {_SCALED}')} AS avg_relevance
        FROM movie_stats""",
        AVERAGES,
    ),
    "dominated_tag_genre": _with(
        "SELECT genre, tag FROM beaten", GENRES, AVERAGES, TAG_GENRE, GENRE_TAG_POINTS
    ),
    # aggregations
    "avg_rating_per_movie": _with(
        f"SELECT movie_id, {_r('avg_rating')} AS avg_rating FROM item_ratings", AVERAGES
    ),
    "genre_tag_counts": _with(
        "SELECT genre, tag, count(*) AS n_uses FROM tag_genre GROUP BY genre, tag",
        GENRES, AVERAGES, TAG_GENRE,
    ),
    "most_used_tag_per_genre": _with(
        """
        SELECT genre, tag, n_uses FROM (
          SELECT genre, tag, count(*) AS n_uses, row_number() OVER (
                   PARTITION BY genre ORDER BY count(*) DESC, tag ASC NULLS LAST) AS place
          FROM tag_genre GROUP BY genre, tag)
        WHERE place = 1""",
        GENRES, AVERAGES, TAG_GENRE,
    ),
    "users_per_genre_tag": _with(
        """
        SELECT genre, tag, count(DISTINCT user_id) AS user_count
        FROM tag_genre GROUP BY genre, tag""",
        GENRES, AVERAGES, TAG_GENRE,
    ),
    "movie_rating_stats": _with(
        f"SELECT movie_id, {_r('avg_rating')} AS avg_rating, rating_count FROM item_ratings",
        AVERAGES,
    ),
    "avg_relevance_per_movie": _with(
        f"""
        SELECT movie_id, {_r(f'avg_relevance / {_SCALED}')} AS avg_relevance
        FROM item_relevance""",
        AVERAGES,
    ),
    "user_tag_profile": _with(
        f"""
        SELECT user_id, tag_id, {_r(f'score / {_SCALED}')} AS avg_tag_relevance_per_user
        FROM profile""",
        LIKED,
    ),
    "cosine_components": _with(
        f"""
        SELECT user_id, {_r(f'dot_product / {_SQUARE}')} AS dot_product,
               {_r(f'user_norm_sqr / {_SQUARE}')} AS user_norm_sqr,
               {_r(f'target_norm_sqr / {_SQUARE}')} AS target_norm_sqr
        FROM components""",
        LIKED, COSINE,
    ),
    # set-like
    "genre_tag_users": _with(
        "SELECT DISTINCT genre, tag, user_id FROM tag_genre", GENRES, AVERAGES, TAG_GENRE
    ),
}
