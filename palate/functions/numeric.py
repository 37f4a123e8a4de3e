"""Numeric expressions that never raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# How far above the exact half the last digit is cut, in units of that digit.
TIE_SHIFT = 2.0**-16
# Doubles below this have a half and therefore digits to cut.
EXACT = 2.0**52


def fixed(value: Column, scale: int | None) -> Column:
    """``value`` rounded to ``scale`` decimals; unchanged for ``None``.

    A sum of doubles depends on its order in the last bit. Ratios of counts often lie
    exactly half-way between two decimals, where that bit would decide, so the cut is
    moved slightly off the half. Plain double arithmetic. A value whose digits at that
    scale are beyond what a double holds comes back as it is, as do NaN and infinity.
    """
    if scale is None:
        return value
    unit = float(10**scale)
    cut = F.floor(value * unit + (0.5 + TIE_SHIFT)) / unit
    return F.when(F.abs(value * unit) < EXACT, cut).otherwise(value.cast("double"))


def weighted_mean(value: str, weight: str) -> Column:
    """Mean of ``value`` where each row stands for ``weight`` equal rows.

    NULL values count for nothing; with none left the mean is NULL.
    """
    return F.try_divide(
        F.sum(F.col(value) * F.col(weight)),
        F.sum(F.when(F.col(value).isNotNull(), F.col(weight))),
    )


def cosine(dot: Column, left_sqr: Column, right_sqr: Column) -> Column:
    """Cosine similarity from its three sums; NULL when either vector is zero."""
    return F.try_divide(dot, F.sqrt(left_sqr) * F.sqrt(right_sqr))


def pearson(x: str, y: str) -> Column:
    """Exact Pearson correlation over rows where both are present.

    NULL for fewer than one such row or when either side is constant.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    left, right = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.try_divide(
        F.covar_pop(left, right), F.stddev_pop(left) * F.stddev_pop(right)
    )
