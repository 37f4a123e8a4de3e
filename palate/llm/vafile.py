"""Exact top-k inner products with a vector-approximation file.

Vectors become whole numbers, floor(1024 x). Their approximations are cells, 64 equal steps per
dimension between the least and the greatest value of the table, one byte each. Blocks of vectors
meet blocks of queries: the cells give a lower and an upper bound of each score, vectors whose upper
bound is below the kth lower bound are left out, and the others are read in the order of their upper
bounds until no unread one can enter the first k. Every block gives k rows per query, merged in Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palate.llm.common import batches, stage

SCALE = 1024
CELLS = 64
BLOCK_ROWS, QUERY_ROWS = 4096, 1024
BLOCK_BYTES = 16 << 20
LIMIT = 2**63
#: Up to here sums of doubles are exact.
EXACT = 2.0**52


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part: an id and a vector without null, NaN or infinity."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & fine).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Whole numbers as doubles: exact, as floor() of a double is one."""
    return np.floor(np.asarray(column.flatten()).reshape(len(column), dims) * SCALE)


def _by_length(parts: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    for part in batches(parts, rows, BLOCK_BYTES):
        lengths = np.asarray(part.column(1).value_lengths()).astype(np.int64)
        for dims in np.unique(lengths).tolist():
            yield dims, part if (lengths == dims).all() else part.filter(pa.array(lengths == dims))


def _ranges(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dims, part in _by_length(parts, BLOCK_ROWS):
        if dims:
            m = _matrix(part.column(part.schema.get_field_index("v")), dims)
            low, high = found.get(dims, (m[0], m[0]))
            found[dims] = np.minimum(low, m.min(axis=0)), np.maximum(high, m.max(axis=0))
    for dims, (low, high) in found.items():
        yield pa.RecordBatch.from_arrays([pa.array([dims] * dims, pa.int32()), pa.array(range(dims), pa.int32()), pa.array(low), pa.array(high)], ["dims", "at", "low", "high"])


def _blocks(rows: int, edges: dict[int, tuple[np.ndarray, np.ndarray]] | None, prefix: str) -> Callable:
    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, part in _by_length(parts, rows):
            m = _matrix(part.column(1), dims)
            cells = b""
            if edges and dims:
                low, step = edges[dims]
                cells = np.minimum((m - low) // step, CELLS - 1).astype(np.uint8).tobytes()
            ids = np.asarray(part.column(0)).astype("<i8").tobytes()
            columns = [pa.array([dims], pa.int32()), pa.array([ids], pa.binary()), pa.array([cells], pa.binary()), pa.array([m.astype("<f8").tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [f"{prefix}_{n}" for n in ("dims", "ids", "cells", "values")])

    return pack


def _exact(values: np.ndarray, query: np.ndarray, safe: bool) -> np.ndarray | list[int]:
    if safe:
        return values @ query
    own = [int(x) for x in query]
    return [max(-LIMIT, min(LIMIT - 1, sum(int(a) * b for a, b in zip(row, own, strict=True)))) for row in values]


def search_block(ids: np.ndarray, cells: np.ndarray, values: np.ndarray, low: np.ndarray, step: np.ndarray, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (score, vec_id) for one query in one block."""
    high = low + step * CELLS - 1
    greatest = np.abs(np.concatenate([low, high])).max(initial=0) * np.abs(query).sum()
    safe = bool(greatest < EXACT)
    edge_low = low + cells * step
    if safe:
        plus, minus = np.maximum(query, 0), np.minimum(query, 0)
        at_low, span = edge_low @ query, step - 1
        upper = at_low + span @ plus
        lower = at_low + span @ minus
    else:  # beyond what doubles hold: every vector is read
        upper = np.full(len(ids), np.inf)
        lower = -upper
    other = np.flatnonzero(ids != query_id)
    if len(other) > k:
        other = other[upper[other] >= np.partition(lower[other], len(other) - k)[len(other) - k]]
    other = other[np.argsort(-upper[other], kind="stable")]
    best: list[tuple[int, int]] = []
    for a in range(0, len(other), 64):
        if len(best) == k and upper[other[a]] < best[-1][0]:
            break
        read = other[a : a + 64]
        scores = _exact(values[read], query, safe)
        best = sorted([*best, *((int(s), int(i)) for s, i in zip(scores, ids[read], strict=True))], key=lambda x: (-x[0], x[1]))[:k]
    return best


def top_k(vectors: DataFrame, is_query: str = "pmod(vec_id, 100) = 0", k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which the SQL condition holds, the k rows of
    other ids with the highest integer inner products, ties to the smaller id.

    Rows without an id, and vectors that are null or hold a null, NaN or infinite number take no
    part. Vectors meet only vectors of their length. Repeated rows are candidates each; a query that
    is there twice is answered once, two queries of one id with different vectors both. Scores
    beyond the range of long are clamped to it. Empty tables give no rows."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    ranges = rows.select("vec_id", "v").mapInArrow(_ranges, "dims int, at int, low double, high double").groupBy("dims", "at").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow().to_pandas()
    edges = {}  # at most one row per dimension of each length
    for dims, own in ranges.sort_values("at").groupby("dims"):
        low = own["low"].to_numpy()
        edges[int(dims)] = low, np.maximum(1, np.ceil((own["high"].to_numpy() - low + 1) / CELLS))
    shared = spark.sparkContext.broadcast(edges)
    approximations = stage(rows.mapInArrow(_blocks(BLOCK_ROWS, edges, "b"), "b_dims int, b_ids binary, b_cells binary, b_values binary"), "va-file")
    queries = rows.filter(is_query).dropDuplicates()
    n = queries.count()
    queries = queries.repartition(max(1, -(-n // QUERY_ROWS)), "vec_id").mapInArrow(_blocks(QUERY_ROWS, None, "q"), "q_dims int, q_ids binary, q_cells binary, q_values binary").drop("q_cells")
    queries = stage(queries, "va-queries")

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 1):
            row = part.to_pylist()[0]
            dims = row["b_dims"]
            ids, asked = np.frombuffer(row["b_ids"], "<i8"), np.frombuffer(row["q_ids"], "<i8")
            values, questions = (np.frombuffer(row[c], "<f8").reshape(-1, dims) if dims else np.zeros((len(i), 0)) for c, i in (("b_values", ids), ("q_values", asked)))
            low, step = shared.value.get(dims, (np.zeros(0), np.ones(0)))
            cells = np.frombuffer(row["b_cells"], np.uint8).reshape(-1, dims) if dims else np.zeros((len(ids), 0))
            cells = cells.astype(np.float64)
            key, query_id, vec_id, score = [], [], [], []
            for q, question in zip(asked.tolist(), questions, strict=True):
                own = int.from_bytes(hashlib.blake2b(question.tobytes(), digest_size=8).digest(), "little", signed=True)
                for s, i in search_block(ids, cells, values, low, step, q, question, k):
                    key.append(own)
                    query_id.append(q)
                    vec_id.append(i)
                    score.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (key, query_id, vec_id, score)], ["key", "query_id", "vec_id", "score"])

    pairs = approximations.crossJoin(queries).filter("b_dims = q_dims")
    found = pairs.mapInArrow(search, "key long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
