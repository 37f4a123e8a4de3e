"""Grouped operators: iceberg and argmax."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iceberg(
    df: DataFrame,
    keys: Sequence[str],
    support: Column,
    min_support: float,
    measure: Column,
    min_measure: float | None = None,
    *,
    measure_name: str = "measure",
) -> DataFrame:
    """Groups whose ``support`` and ``measure`` aggregates both exceed a threshold.

    Returns the keys and the measure. Both comparisons are strict; a NULL measure
    never passes. ``min_measure=None`` sets no measure threshold.
    """
    groups = df.groupBy(*keys).agg(support.alias("_support"), measure.alias(measure_name))
    groups = groups.filter(F.col("_support") > min_support)
    if min_measure is not None:
        groups = groups.filter(F.col(measure_name) > min_measure)
    return groups.select(*keys, measure_name)


def argmax_per_group(
    df: DataFrame, keys: Sequence[str], measure: str, tie_break: Sequence[str]
) -> DataFrame:
    """The row with the largest ``measure`` in each group, with all its columns.

    Ties go to the smallest ``tie_break`` values, NULL last. An aggregate rather
    than a window: partial results combine before the shuffle, so a group may be of
    any size. ``measure`` must be numeric and ``tie_break`` must make rows distinct; the
    other columns may be of any type.
    """
    whole = dict(df.dtypes)[measure] in ("tinyint", "smallint", "int", "bigint")
    # The complement turns the order of whole numbers round and never overflows.
    falling = F.bitwise_not(F.col(measure)) if whole else -F.col(measure)
    first = [F.col(measure).isNull().alias("_absent"), falling.alias("_order")]
    ties = [
        part
        for name in tie_break
        for part in (F.col(name).isNull().alias(f"_null_{name}"), F.col(name).alias(f"_by_{name}"))
    ]
    payload = [F.col(name).alias(f"_out_{name}") for name in df.columns if name not in keys]
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(*payload), F.struct(*first, *ties)).alias("_best")
    )
    return best.select(
        *(
            F.col(name) if name in keys else F.col(f"_best._out_{name}").alias(name)
            for name in df.columns
        )
    )
