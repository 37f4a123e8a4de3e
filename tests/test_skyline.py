"""Skylines against brute force, on the pairwise and on the sweep path."""

from __future__ import annotations

import random

import pytest
from conftest import plan, rows

from palate.operators import dominated, skyline
GRID = {"slab_points": 7}


def beats(b, a):
    return all(x >= y for x, y in zip(b, a)) and any(x > y for x, y in zip(b, a))


def comparable(point):
    return all(v is not None and v == v for v in point)


def brute(data, first):
    points = {r[first:] for r in data if comparable(r[first:])}
    gone = {a for a in points if any(beats(b, a) for b in points)}
    return sorted((r for r in data if r[first:] not in gone), key=repr)


def cloud(kind, n, dims, seed):
    rng = random.Random(seed)
    if kind == "ties":  # few values, many equal rows
        draw = lambda: tuple(float(rng.randrange(4)) for _ in range(dims))
    elif kind == "hot":  # a third of the rows on one value of the first dimension
        draw = lambda: (
            (1.0 if rng.random() < 0.34 else rng.random() * 2,)
            + tuple(rng.random() for _ in range(dims - 1))
        )
    elif kind == "front":  # every point on the front, or just below it
        def draw():
            cut = sorted(rng.random() for _ in range(dims - 1))
            parts = [b - a for a, b in zip([0.0, *cut], [*cut, 1.0])]
            return tuple(p - (rng.random() < 0.3) * 0.05 for p in parts)
    else:
        draw = lambda: tuple(rng.random() for _ in range(dims))
    return [(i, *draw()) for i in range(n)]


@pytest.mark.parametrize("tuning", [{}, GRID], ids=["one cell", "grid"])
@pytest.mark.parametrize("dims", [2, 3])
@pytest.mark.parametrize("kind", ["uniform", "ties", "hot", "front"])
def test_matches_brute_force(spark, kind, dims, tuning):
    data = cloud(kind, 300, dims, seed=dims * 17 + len(kind))
    names = ["x", "y", "z"][:dims]
    df = spark.createDataFrame(data, ["id", *names]).repartition(4)
    want = brute(data, 1)
    assert rows(skyline(df, names, **tuning)) == want
    if kind != "ties":
        return
    kept = {r[0] for r in want}
    assert {r[0] for r in rows(dominated(df, names, **tuning))} == {r[0] for r in data} - kept


@pytest.mark.parametrize("tuning", [{}, GRID], ids=["one cell", "grid"])
def test_null_and_nan_rows_stay_and_beat_nothing(spark, tuning):
    nan = float("nan")
    data = [(1, 1.0, 1), (2, None, 9), (3, 9.0, None), (4, nan, 9), (5, 2.0, 2), (6, 2.0, 2)]
    df = spark.createDataFrame(data, "id int, x double, y int")
    assert [r[0] for r in rows(skyline(df, ["x", "y"], **tuning))] == [2, 3, 4, 5, 6]
    assert rows(dominated(df, ["x", "y"], **tuning)) == [(1, 1.0, 1)]


@pytest.mark.parametrize("tuning", [{}, GRID], ids=["one cell", "grid"])
@pytest.mark.parametrize("data", [[], [(1, 5, 5, 5)], [(1, 5, 5, 5), (2, 5, 5, 5)]])
def test_tiny_inputs(spark, data, tuning):
    df = spark.createDataFrame(data, "id int, x bigint, y bigint, z bigint")
    assert rows(skyline(df, ["x", "y", "z"], **tuning)) == data
    assert rows(dominated(df, ["x", "y", "z"], **tuning)) == []


@pytest.mark.parametrize("dims", [["d", "s"], ["d", "s", "n"], ["t", "b", "n"]])
def test_other_orderable_types(spark, dims):
    df = spark.range(400).selectExpr(
        "id",
        "if(id % 50 = 7, null, date_add(date'2020-01-01', int(pmod(hash(id), 40)))) as d",
        "concat('k', lpad(string(pmod(hash(id, 1), 60)), 2, '0')) as s",
        "pmod(hash(id, 2), 30) as n",
        "timestamp_seconds(pmod(hash(id, 3), 25)) as t",
        "cast(pmod(hash(id, 4), 70) as decimal(20, 3)) as b",
    )
    got = rows(skyline(df, dims, **GRID))
    assert got == rows(skyline(df, dims)) and len(got) < 300
    assert skyline(df, dims, **GRID).columns == df.columns
    assert rows(dominated(df, dims, **GRID)) == rows(dominated(df, dims))


def test_idempotent_and_independent_of_buckets(spark):
    df = spark.createDataFrame(cloud("front", 400, 3, 5), ["id", "x", "y", "z"])
    once = skyline(df, ["x", "y", "z"])
    found = rows(once)
    for buckets in (3, 50, 10_000):
        tuning = {"slab_points": buckets}
        assert rows(skyline(df, ["x", "y", "z"], **tuning)) == found
    assert rows(skyline(once, ["x", "y", "z"])) == found


def test_many_points_that_are_all_on_the_front(spark):
    """No two of them are comparable, so every one is compared with its slabs, and with nothing else."""
    n = 100_000
    df = spark.range(n).selectExpr("id", "id as x", f"(id * 7919) % {n} as y", f"-id - (id * 7919) % {n} as z")
    front = skyline(df, ["x", "y", "z"])
    assert front.count() == n
    assert "NestedLoop" not in plan(front)


@pytest.mark.parametrize("dims", [["x"], ["x", "x"], ["x", "y", "z", "w"]])
def test_rejects_other_dimension_lists(spark, dims):
    df = spark.createDataFrame([(1, 1, 1, 1)], ["x", "y", "z", "w"])
    with pytest.raises(ValueError, match="two or three"):
        skyline(df, dims)
