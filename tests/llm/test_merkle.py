"""The Merkle manifest against a recursive version on lists."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from conftest import rows
from llm_cases import TINY, no_docs, odd_docs, workers_find_the_package  # noqa: F401
from pyspark.sql import functions as F

from palate.llm import merkle, queries

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*values: str) -> str:
    return hashlib.sha256("".join(values).encode()).hexdigest()


def record(row) -> str:
    return sha(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """(digest that is left, for each leaf its siblings before and after, level by level)"""
    paths, now = [[] for _ in leaves], [([i], leaf) for i, leaf in enumerate(leaves)]
    while len(now) > 1:
        above = []
        for start in range(0, len(now), 3):
            run = now[start : start + 3]
            for k, (members, _) in enumerate(run):
                for i in members:
                    paths[i].append(("".join(h for _, h in run[:k]), "".join(h for _, h in run[k + 1 :])))
            above.append(([i for members, _ in run for i in members], sha(*(h for _, h in run))))
        now = above
    return now[0][1], paths


def by_hand(table: list[dict]) -> list[tuple]:
    groups = {}
    for row in table:
        groups.setdefault(row["source"], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for source in order:
        own = sorted(groups[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, record(r)))
        made.append((own, *tree([record(r) for r in own])))
    root, ways = tree([subroot for _, subroot, _ in made])
    out = []
    for (own, subroot, paths), up in zip(made, ways, strict=True):
        for row, path in zip(own, paths, strict=True):
            now = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["text"] is not None:
                now["text"] = row["text"].replace("\n", "")
            folded = record(now)
            for before, after in path + up:
                folded = sha(before, folded, after)
            proof = sha(*(before + after for before, after in path + up))
            out.append((row["doc_id"], record(row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def query(spark, docs, monkeypatch):
    monkeypatch.setattr(queries, "_read", lambda *_: docs)
    return rows(queries.op13_nested_intervals(spark, ""))


def test_query_equals_the_recursion(spark):
    table = [r.asDict() for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    got = rows(queries.op13_nested_intervals(spark, TINY))
    assert got == by_hand(table)
    assert {row[-1] for row in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [9], [10], [1, 1], [1, 28, 2, 3, 81, 1], [5] * 11])
def test_groups_of_all_sizes(spark, sizes, monkeypatch):
    table, at = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            at += 1
            table.append({"doc_id": at * 7 % 1009, "source": f"s{k}", "lang": "x", "n_chars": at, "text": f"a\n{at}" if at % 3 else "b"})
    docs = spark.createDataFrame([tuple(r.values()) for r in table], "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert query(spark, docs, monkeypatch) == by_hand(table)


def test_odd_rows(spark, odd_docs, no_docs, monkeypatch):  # noqa: F811
    table = [r.asDict() for r in odd_docs.select(*FIELDS).collect()]
    assert query(spark, odd_docs, monkeypatch) == by_hand(table)
    assert query(spark, no_docs, monkeypatch) == []


def test_names_in_use_are_refused(spark):
    with pytest.raises(ValueError, match="path"):
        merkle.manifest(spark.createDataFrame([(1, "a", "h", 0)], "id long, grp string, digest string, path int"), "grp", "id")


def test_a_group_is_spread_over_tasks(spark):
    """No grouping or join of the manifest has the group alone for its key."""
    leaves = spark.range(5000).select("id", F.lit("one").alias("grp"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"))
    made = merkle.manifest(leaves, "grp", "id")
    text = made._jdf.queryExecution().toString()
    assert "bucket" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert made.select("root").distinct().count() == 1 and made.count() == 5000
