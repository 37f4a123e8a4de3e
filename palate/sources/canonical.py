"""The five input tables derived from the supplied star-schema Parquet files.

Every row of ``part``, ``lineitem``, ``orders``, ``embeddings`` and ``nation`` is
used: nothing is filtered, sampled or cut. The SQL twin is ``oracle.CANONICAL``. A table
is built when it is first asked for, and no job runs for it: the scans name the columns
they need.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.functions.genres import NO_GENRES

# The columns that are read, with the types that the files have.
_COLUMNS = {
    "part": "p_partkey bigint, p_name string, p_size int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_returnflag string, "
    "l_linestatus string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
    "embeddings": "vec_id bigint, embedding array<float>",
    "nation": "n_nationkey int, n_name string",
}


def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _scan(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") == 50, F.lit(NO_GENRES))
        .otherwise(F.translate("p_name", " ", "|"))
        .alias("genres"),
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Dealt by the join's key, as the join would deal a large table itself; a table of
    # few splits is so spread over the cores too.
    lines = _scan(spark, sf_dir, "lineitem").repartition("l_orderkey")
    orders = _scan(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def _pair() -> list[Column]:
    return [F.col("o_custkey").cast("string").alias("user_id"), F.col("l_partkey").cast("string").alias("movie_id")]


def _rating() -> Column:
    """Half-step ratings 0.5 .. 5.0, exact in binary; a returned line has a NULL rating."""
    half_steps = F.ceil(F.col("l_quantity") / 5) / 2
    return F.when(F.col("l_returnflag") != "R", half_steps).cast("double").alias("rating")


def _tag() -> Column:
    """One tag application per order line; urgent, accepted lines carry a NULL tag."""
    null_tag = (F.col("o_orderpriority") == "1-URGENT") & (F.col("l_returnflag") == "A")
    return F.when(~null_tag, F.concat("o_orderpriority", F.lit("/"), "l_returnflag", "l_linestatus")).alias("tag")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).select(*_pair(), _rating())


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).select(*_pair(), _tag())


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``blocks.facts`` of tags and ratings in one pass: a line is one application and one rating."""
    one = F.lit(1).cast("bigint")
    return _order_lines(spark, sf_dir).select(*_pair(), _tag(), _rating(), one.alias("n_tags"), one.alias("n_ratings"))


def genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _scan(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding"))
    return vectors.select(
        F.col("vec_id").cast("string").alias("movie_id"),
        F.col("pos").cast("string").alias("tag_id"),
        F.floor((F.col("col").cast("double") + 1) * 5000).cast("double").alias("relevance"),
    )


def genome_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("tag_id"), F.col("n_name").alias("tag")
    )


class CanonicalTables:
    """The five tables, under the names of ``sources.Tables``, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._at = spark, sf_dir

    @cached_property
    def movies(self) -> DataFrame:
        return movies(*self._at)

    @cached_property
    def ratings(self) -> DataFrame:
        return ratings(*self._at)

    @cached_property
    def tags(self) -> DataFrame:
        return tags(*self._at)

    @cached_property
    def facts(self) -> DataFrame:
        return facts(*self._at)

    @cached_property
    def genome_scores(self) -> DataFrame:
        return genome_scores(*self._at)

    @cached_property
    def genome_tags(self) -> DataFrame:
        return genome_tags(*self._at)


def canonical(spark: SparkSession, sf_dir: str) -> CanonicalTables:
    return CanonicalTables(spark, sf_dir)
