"""The multi-valued genres column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what the movies table holds where a movie has no genre.
NO_GENRES = "(no genres listed)"


def genre_list(genres: str | Column) -> Column:
    """``a|b`` as an array, without the no-genre marker.

    Trailing separators add no genre (``a|b||`` has two, ``|`` has none), inner
    ones add an empty genre, and an empty string is one empty genre.
    """
    text = F.col(genres) if isinstance(genres, str) else genres
    body = F.regexp_replace(text, r"\|+$", "")
    only_separators = (body == "") & (text != "")
    none = F.array().cast("array<string>")
    items = F.when(only_separators, none).otherwise(F.split(body, r"\|"))
    return F.filter(items, lambda genre: genre != NO_GENRES)


def explode_genres(df: DataFrame, genres: str = "genres") -> DataFrame:
    """One row per genre, in a ``genre`` column; rows without a genre vanish."""
    others = [name for name in df.columns if name != genres]
    return df.select(*others, F.explode(genre_list(genres)).alias("genre"))
