"""Equi joins that stay balanced when a few keys hold most of one side."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.operators.staging import stage_measured

#: A staged table is broadcast only if its values stay below this size.
BROADCAST_BYTES = 64 * 1024 * 1024

_CELL, _CELLS, _HASH = "_cell", "_cells", "_hash"


@dataclass(frozen=True)
class Spread:
    """Which keys are hot: those above ``share`` of the rows and above ``min_rows``, or
    above ``max_rows`` in any case. A cell holds about as many rows as make a key hot."""

    share: float = 1 / 4096
    min_rows: int = 100_000
    max_rows: int = 20_000_000

    def limit(self, rows: int) -> float:
        return min(max(self.share * rows, self.min_rows), self.max_rows)


SPREAD = Spread()


def _require_same_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    types = dict(left.dtypes), dict(right.dtypes)
    for name in on:
        if types[0][name] != types[1][name]:
            raise TypeError(f"join column {name}: {types[0][name]} and {types[1][name]}")


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the keys that hold a large share of some rows, with their cell counts."""

    on: tuple[str, ...]
    cells: dict[int, int]

    def add_cells(self, df: DataFrame) -> DataFrame:
        """Add how many cells each row's key is cut into: 1 for all but the hot keys."""
        entries = ", ".join(f"{key}L, {cells}" for key, cells in self.cells.items())
        known = df.sparkSession.range(1).select(
            F.expr(f"explode(map({entries}))").alias(_HASH, _CELLS)
        )
        return (
            df.withColumn(_HASH, F.xxhash64(*self.on))
            .join(F.broadcast(known), _HASH, "left")
            .drop(_HASH)
            .withColumn(_CELLS, F.coalesce(_CELLS, F.lit(1)))
        )


def find_hot_keys(df: DataFrame, on: Sequence[str], spread: Spread = SPREAD) -> HotKeys:
    """The keys holding more than ``spread.share`` of the rows of ``df``.

    One pass with a frequent-items sketch per task, merged in two steps: no shuffle by
    key, and what reaches the driver has at most ``1 / share`` entries, as no more keys
    can be that frequent. The sketch tracks several times that number, so its error
    stays below the share. Two keys with one hash are treated alike, and a wrong
    estimate changes only the balance of a join, never its result.
    """
    most = ceil(1 / spread.share)
    tracked = 4 * most
    sketches = (
        df.select(F.xxhash64(*on).alias(_HASH), (F.spark_partition_id() % 256).alias("_task"))
        .groupBy("_task")
        .agg(
            F.expr(f"approx_top_k_accumulate({_HASH}, {tracked})").alias("_sketch"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    merged = f"approx_top_k_combine(_sketch, {tracked})"
    found = (
        sketches.groupBy(F.lit("all"))
        .agg(
            F.expr(f"approx_top_k_estimate({merged}, {most})").alias("keys"),
            F.sum("_rows").alias("rows"),
        )
        .first()
    )
    if found is None:
        return HotKeys(tuple(on), {})
    limit = spread.limit(found["rows"])
    frequent = {key["item"]: key["count"] for key in found["keys"] if key["count"] > limit}
    return HotKeys(tuple(on), {item: ceil(count / limit) for item, count in frequent.items()})


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: HotKeys | None = None,
    spread: Spread = SPREAD,
) -> DataFrame:
    """``big.join(small, on, how)`` with the hot keys of ``big`` cut into cells.

    A row of a hot key goes to the cell picked by the hash of its other columns, and
    the rows of ``small`` with that key are copied to each of its cells. So each row
    of ``big`` meets every partner exactly once, also when a lost task runs again. Rows of
    ``big`` should be distinct: equal rows share a cell. Without hot keys this is the
    plain join.

    Adaptive execution splits skewed joins by itself, at no extra pass, and the queries
    rely on it. It can not where the join's output must keep its partitioning for a later
    step, or where a hot key's rows come out of one task; that is what this is for.

    ``hot`` may come from the raw rows behind ``big``; by default ``big`` is examined.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    on = list(on)
    _require_same_types(big, small, on)
    hot = find_hot_keys(big, on, spread) if hot is None else hot
    if not hot.cells:
        return big.join(small, on, how)
    others = [name for name in big.columns if name not in on]
    cell = F.pmod(F.xxhash64(*others), F.col(_CELLS)).cast("int") if others else F.lit(0)
    left = hot.add_cells(big).withColumn(_CELL, cell).drop(_CELLS)
    copies = F.explode(F.sequence(F.lit(0), F.col(_CELLS) - 1))
    right = hot.add_cells(small).withColumn(_CELL, copies).drop(_CELLS)
    return left.join(right, [*on, _CELL], how).drop(_CELL)


@dataclass(frozen=True)
class Lookup:
    """The smaller side of a join, computed once and measured."""

    df: DataFrame
    fits: bool

    @classmethod
    def of(cls, df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> Lookup:
        staged = stage_measured(df, "lookup")
        return cls(staged.df, staged.bytes <= max_bytes)


def lookup_join(
    big: DataFrame, small: DataFrame | Lookup, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join to a side that is expected, but not known, to be small.

    ``small`` is staged and measured, unless it is a ``Lookup`` already. Up to
    ``BROADCAST_BYTES`` it is broadcast and ``big`` is not shuffled at all; beyond, this is
    the plain join.
    """
    small = small if isinstance(small, Lookup) else Lookup.of(small)
    if small.fits:
        return big.join(F.broadcast(small.df), list(on), how)
    return big.join(small.df, list(on), how)
