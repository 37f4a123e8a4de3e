"""Ranked top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.operators.staging import stage


#: Up to this ``k`` the rows that are left are numbered in one task.
ONE_TASK_ROWS = 100_000


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with each row's 1-based place in the order, which must be total.

    Rows are sorted into ranges and staged; places count inside a range and from the sizes
    of the ranges before it, so no task sees all rows.
    """
    ranges = stage(df.orderBy(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranges.withColumn(name, place)
        .join(F.broadcast(firsts), "_range")  # a row per shuffle partition
        .withColumn(name, F.col("_first") + F.col(name))
        .select(*df.columns, name)
    )


def topk_ranked(df: DataFrame, by: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``, with their 1-based ``rank``.

    Ties go to the smallest ``tie_break`` values, which must make rows distinct; NULL
    measures come last. Each task keeps only its own ``k`` best rows, and the unpartitioned
    window that numbers them sees the final ``k`` rows only. A ``k`` above
    ``ONE_TASK_ROWS`` is numbered by ranges instead, with the same result.
    """
    order = [F.desc_nulls_last(by), *(F.asc_nulls_last(name) for name in tie_break)]
    if k > ONE_TASK_ROWS:
        return numbered(df, order, "rank").filter(F.col("rank") <= k)
    best = df.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
