"""Skyline: the rows that no other row dominates, all dimensions maximised.

A row dominates another if it is at least as large in every dimension and larger in
one. Equal rows do not dominate each other and all stay. A row with a NULL or NaN
dimension is incomparable: it stays and dominates nothing.

The textbook form compares all pairs. Here local skylines are merged by the dominance of
grid cells, in one way for all sizes and all types that have an order:

1. Rows are staged once and reduced to their distinct points.
2. Points are dealt to slabs, ranges of equal size of the order (x, y, z), and again of
   the order (y, x, z); so a value that many points share is cut as well. A point's cell is its pair
   of slabs.
3. A point in a cell whose slabs both come later is another point, no smaller in x and y. So
   the largest z of all such cells, a running maximum over the grid, tells whether one of
   their points dominates: cells settle this without comparing points.
4. What is left can only be dominated from its own slab in one of the two orders: an anti
   join with the slab for its key. Points that were dropped need not be looked at, as whatever
   dominates them dominates what they do.

Two dimensions take one order and a running maximum over its slabs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.operators.staging import stage, stage_measured

#: Aimed-for points of a slab. The grid has at most ``MAX_SLABS`` slabs a side; slabs grow beyond.
SLAB_POINTS = 2500
MAX_SLABS = 2048

_ABOVE, _BEFORE = "_above", (Window.unboundedPreceding, -1)


def dominates(better: str, worse: str, dims: Sequence[str]) -> Column:
    """Predicate over aliased sides: ``better`` dominates ``worse``."""
    pairs = [(F.col(f"{better}.{name}"), F.col(f"{worse}.{name}")) for name in dims]
    return reduce(and_, (b >= w for b, w in pairs)) & reduce(or_, (b > w for b, w in pairs))


def _comparable(df: DataFrame, dims: Sequence[str]) -> Column:
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}
    present = [F.col(name).isNotNull() for name in dims]
    present += [~F.isnan(name) for name in dims if name in floating]
    return F.coalesce(reduce(and_, present), F.lit(False))


def _in_slabs(points: DataFrame, order: Sequence[str], slabs: int, to: str) -> DataFrame:
    """Add the number of each point's range in the ascending order, for ``slabs`` ranges."""
    return points.repartitionByRange(slabs, *order).withColumn(to, F.spark_partition_id())


def _later_slabs(placed: DataFrame, best: str, slabs: int) -> DataFrame:
    """(_i, _above): the largest ``best`` of all later slabs; one row per slab."""
    tops = placed.groupBy("_i").agg(F.max(best).alias("_top"))
    every = placed.sparkSession.range(slabs).select(F.col("id").cast("int").alias("_i"))
    later = Window.orderBy(F.desc("_i")).rowsBetween(*_BEFORE)
    return every.join(tops, "_i", "left").select("_i", F.max("_top").over(later).alias(_ABOVE))


def _later_cells(placed: DataFrame, best: str, slabs: int) -> DataFrame:
    """(_i, _j, _above): the largest ``best`` of the cells that come later in both orders, for each cell of the grid."""
    tops = placed.groupBy("_i", "_j").agg(F.max(best).alias("_top"))
    sides = F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))
    every = placed.sparkSession.range(slabs).select(F.col("id").cast("int").alias("_i"), sides.alias("_j"))
    along_j = Window.partitionBy("_i").orderBy(F.desc("_j")).rowsBetween(*_BEFORE)
    along_i = Window.partitionBy("_j").orderBy(F.desc("_i")).rowsBetween(*_BEFORE)
    rows = every.join(tops, ["_i", "_j"], "left").withColumn("_top", F.max("_top").over(along_j))
    return rows.select("_i", "_j", F.max("_top").over(along_i).alias(_ABOVE)).filter(F.col(_ABOVE).isNotNull())


def _undominated_in(points: DataFrame, by: DataFrame, slab: str, dims: Sequence[str]) -> DataFrame:
    """Points that no point of the same slab in ``by`` dominates; its strong points come first."""
    strong = by.select(slab, *dims).repartition(slab).sortWithinPartitions(slab, *(F.desc(name) for name in dims))
    same = F.col(f"a.{slab}") == F.col(f"b.{slab}")
    joined = points.alias("a").join(strong.hint("merge").alias("b"), same & dominates("b", "a", dims), "left_anti")
    return joined.select(*points.columns)


def _skyline_points(points: DataFrame, dims: Sequence[str], slabs: int) -> DataFrame:
    """The undominated points of distinct comparable ones."""
    x, y, *rest = dims
    placed = _in_slabs(points, [x, y, *rest], slabs, "_i")
    if slabs == 1:  # the grid is one cell, without later ones
        return _undominated_in(placed, placed, "_i", dims).select(*dims)
    if not rest:
        placed = stage(placed, "slabs")  # where a point lies must not be computed twice
        above, cell, best = _later_slabs(placed, y, slabs), ["_i"], y
    else:
        placed = stage(_in_slabs(placed, [y, x, *rest], slabs, "_j"), "cells")
        above, cell, best = _later_cells(placed, rest[0], slabs), ["_i", "_j"], rest[0]
    left = placed.join(above, cell, "left").filter(F.col(_ABOVE).isNull() | (F.col(best) > F.col(_ABOVE))).drop(_ABOVE)
    found = left
    for slab in cell:
        found = _undominated_in(found, left, slab, dims)
    return found.select(*dims)


def _split_by_skyline(
    df: DataFrame, maximize: Sequence[str], kept: bool, *, slab_points: int = SLAB_POINTS
) -> DataFrame:
    """The comparable rows on the skyline and all incomparable ones, or the other rows."""
    dims = list(maximize)
    if len(set(dims)) != len(dims) or len(dims) not in (2, 3):
        raise ValueError("a skyline takes two or three different dimensions")
    staged = stage_measured(df, "skyline-rows")
    comparable = staged.df.filter(_comparable(staged.df, dims))
    slabs = max(1, min(MAX_SLABS, -(-staged.rows // slab_points)))
    points = _skyline_points(comparable.select(*dims).distinct(), dims, slabs)
    found = comparable.join(points, dims, "left_semi" if kept else "left_anti").select(*df.columns)
    if kept:
        return found.unionByName(staged.df.filter(~_comparable(staged.df, dims)))
    return found


def skyline(df: DataFrame, maximize: Sequence[str], **tuning) -> DataFrame:
    """Rows of ``df`` that no row dominates; see the module text for the rules."""
    return _split_by_skyline(df, maximize, True, **tuning)


def dominated(df: DataFrame, maximize: Sequence[str], **tuning) -> DataFrame:
    """Rows of ``df`` that some row dominates: the complement of ``skyline``."""
    return _split_by_skyline(df, maximize, False, **tuning)
