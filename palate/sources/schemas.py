"""Schemas of the five input tables.

Identifiers are strings everywhere: joins and comparisons on them are string
comparisons, as in the published data's readers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_STRING, _DOUBLE = T.StringType(), T.DoubleType()

MOVIES = _schema(movie_id=_STRING, title=_STRING, genres=_STRING)
RATINGS = _schema(user_id=_STRING, movie_id=_STRING, rating=_DOUBLE)
TAGS = _schema(user_id=_STRING, movie_id=_STRING, tag=_STRING)
GENOME_SCORES = _schema(movie_id=_STRING, tag_id=_STRING, relevance=_DOUBLE)
GENOME_TAGS = _schema(tag_id=_STRING, tag=_STRING)

SCHEMAS = {
    "movies": MOVIES,
    "ratings": RATINGS,
    "tags": TAGS,
    "genome_scores": GENOME_SCORES,
    "genome_tags": GENOME_TAGS,
}


@dataclass(frozen=True)
class Tables:
    """The five inputs of the workloads."""

    movies: DataFrame
    ratings: DataFrame
    tags: DataFrame
    genome_scores: DataFrame
    genome_tags: DataFrame
