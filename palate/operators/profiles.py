"""User profiles from liked items, and cosine similarity to a target item.

Vectors stay in long form, one row per (item, dimension), or in blocks of a fixed
width: no vector is ever collected into one row, so neither items nor dimensions have
a bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.functions.numeric import cosine

#: Dimensions that travel side by side in one row of a blocked vector.
BLOCK_WIDTH = 8
#: Ratings of more bytes than this meet vectors in blocks.
BLOCKED_BYTES = 1 << 30


def liked_items(ratings: DataFrame, min_rating: float) -> DataFrame:
    """(user_id, movie_id) of every rating above ``min_rating``, repeats kept."""
    return ratings.filter(F.col("rating") > min_rating).select("user_id", "movie_id")


def target_vector(scores: DataFrame, target_movie_id: str) -> DataFrame:
    """(tag_id, relevance) of one movie."""
    return scores.filter(F.col("movie_id") == target_movie_id).select("tag_id", "relevance")


def user_profiles(ratings: DataFrame, scores: DataFrame, min_rating: float = 4.0) -> DataFrame:
    """Per user and tag, the mean relevance over the movies the user liked.

    Output: user_id, tag_id, avg_tag_relevance_per_user.
    """
    return (
        liked_items(ratings, min_rating)
        .join(scores.select("movie_id", "tag_id", "relevance"), "movie_id")
        .groupBy("user_id", "tag_id")
        .agg(F.avg("relevance").alias("avg_tag_relevance_per_user"))
    )


def _folded_target(scores: DataFrame, target_movie_id: str) -> DataFrame:
    """The target's entries, one row per tag: how many, their sum and sum of squares."""
    relevance = F.col("relevance")
    return (
        target_vector(scores, target_movie_id)
        .groupBy("tag_id")
        .agg(
            F.count(F.lit(1)).alias("t_rows"),
            F.sum(relevance).alias("t_sum"),
            F.sum(relevance * relevance).alias("t_sqr"),
        )
    )


def _long_sums(ratings: DataFrame, scores: DataFrame, target: DataFrame, min_rating: float) -> DataFrame:
    """The cosine sums from one row per user and tag."""
    shared = scores.join(target.select("tag_id"), "tag_id", "left_semi")
    score = F.col("avg_tag_relevance_per_user")
    return (
        user_profiles(ratings, shared, min_rating)
        .join(target, "tag_id")
        .groupBy("user_id")
        .agg(
            F.sum(score * F.col("t_sum")).alias("dot_product"),
            F.sum(score * score * F.col("t_rows")).alias("user_norm_sqr"),
            F.sum("t_sqr").alias("target_norm_sqr"),
        )
    )


def _each(pattern: str, between: str = ", ") -> str:
    """The SQL of all slots of a block: ``#`` stands for the slot's number."""
    return between.join(pattern.replace("#", str(slot)) for slot in range(BLOCK_WIDTH))


def _sum_present(part: str) -> str:
    """SQL of the sum over slots of the parts that are not NULL; NULL if none is."""
    total = _each(f"coalesce({part}, 0D)", " + ")
    return f"CASE WHEN coalesce({_each(part)}) IS NOT NULL THEN {total} END"


def _blocked_sums(ratings: DataFrame, scores: DataFrame, target: DataFrame, min_rating: float) -> DataFrame:
    """The cosine sums from one row per user and block of ``BLOCK_WIDTH`` tags.

    The large join and the shuffle by user carry one row for what is ``BLOCK_WIDTH`` rows in long form. The
    target's entries are one row, sorted by tag: an entry's place gives its block and slot, and the lookups that
    come of it are joins whose side adaptive execution measures and broadcasts, within the one plan.
    """
    entries = target.agg(F.sort_array(F.collect_list(F.struct("tag_id", "t_rows", "t_sum", "t_sqr"))).alias("entries"))
    places = entries.select(F.posexplode("entries").alias("place", "entry")).selectExpr(
        "entry.tag_id AS tag_id", f"place div {BLOCK_WIDTH} AS block", f"place % {BLOCK_WIDTH} AS slot"
    )
    slices = f"transform(sequence(0, (size(entries) - 1) div {BLOCK_WIDTH}), b -> slice(entries, b * {BLOCK_WIDTH} + 1, {BLOCK_WIDTH}))"
    blocks = entries.filter("size(entries) > 0").selectExpr(f"posexplode({slices}) AS (block, target)")
    folded = scores.join(places, "tag_id").selectExpr("movie_id", "CAST(block AS int) AS block", "slot", "relevance").groupBy("movie_id", "block")
    # A tag whose scores are all NULL still counts in the target's norm.
    vectors = folded.agg(
        F.expr(f"struct({_each('sum(CASE WHEN slot = # THEN relevance END) AS s#')})").alias("s"),
        F.expr(f"struct({_each('count(CASE WHEN slot = # THEN relevance END) AS n#')})").alias("n"),
        F.expr("bit_or(shiftleft(1, slot))").alias("present"),
    )
    profiles = (
        liked_items(ratings, min_rating)
        .join(vectors, "movie_id")
        .groupBy("user_id", "block")
        .agg(
            F.expr(f"struct({_each('sum(s.s#) AS s#')})").alias("s"),
            F.expr(f"struct({_each('sum(n.n#) AS n#')})").alias("n"),
            F.expr("bit_or(present)").alias("present"),
        )
    )
    scored = profiles.join(blocks, "block").selectExpr("user_id", "target", "present", f"struct({_each('try_divide(s.s#, n.n#) AS v#')}) AS score")
    sums = scored.selectExpr(
        "user_id",
        _sum_present("score.v# * get(target, #).t_sum") + " AS dot",
        _sum_present("score.v# * score.v# * get(target, #).t_rows") + " AS user",
        _sum_present("CASE WHEN getbit(present, #) = 1 THEN get(target, #).t_sqr END") + " AS target",
    )
    return sums.groupBy("user_id").agg(
        F.sum("dot").alias("dot_product"),
        F.sum("user").alias("user_norm_sqr"),
        F.sum("target").alias("target_norm_sqr"),
    )


def _file_bytes(df: DataFrame) -> int:
    """The size of all that a plan reads, as Catalyst estimates it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def cosine_components(
    ratings: DataFrame,
    scores: DataFrame,
    target_movie_id: str,
    min_rating: float = 4.0,
    blocked: bool | None = None,
) -> DataFrame:
    """Per user the three sums behind the cosine between profile and target.

    Only dimensions present in both vectors count, in the target's norm too, so scores
    of other tags are dropped before the item vectors meet the ratings. One lazy plan: no job
    runs before the frame is used, and adaptive execution broadcasts the target where it is
    small.

    In long form, neither vectors nor the target have a bound. ``blocked`` lets vectors travel in
    blocks: an eighth of the rows are joined and shuffled (four times as fast over millions of likes), for
    a plan that takes about a second longer to make and run, and holds the target's vector, an entry per tag, in one
    row. ``None`` takes blocks where the files behind the ratings exceed ``BLOCKED_BYTES``, which
    Catalyst knows without a job. The sums are the same but for their last bits.

    Output: user_id, dot_product, user_norm_sqr, target_norm_sqr.
    """
    target = _folded_target(scores, target_movie_id)
    if blocked is None:
        blocked = _file_bytes(ratings) > BLOCKED_BYTES
    sums = _blocked_sums if blocked else _long_sums
    return sums(ratings, scores, target, min_rating)


def cosine_to_target(components: DataFrame) -> DataFrame:
    """user_id, cosine_similarity; NULL where either vector is zero."""
    similarity = cosine(F.col("dot_product"), F.col("user_norm_sqr"), F.col("target_norm_sqr"))
    return components.select("user_id", similarity.alias("cosine_similarity"))
