"""Lexical retrieval packing: a BM25 index per shard names unused neighbours for every seed.

All token lists are cut into windows. What a long document has in whole windows fills windows of its
own; the rests are dealt to shards of a bounded number of tokens by what they say, so that a seed finds its
neighbours in its own shard however many there are. In a shard, an inverted index returns the unused pieces
most like the seed; they fill the seed's window in that order, the last one is cut, and what
is left of it seeds the next window. So only the last window of a shard is padded.
Terms are token ids; how many pieces hold a term is counted over the whole corpus.

Byte-pair merges are numbered as they are learned, common ones first, so a piece's largest ids are its most special
terms. Its three largest are its place (`near`): pieces of one largest id make a group, groups share a shard
or take several, and in those the other two ids decide. Where too many pieces have one place they are dealt to
some cells of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.llm.bpe import word_bpe
from palate.llm.common import batches, stage, strings

WINDOW = 4096
END = 2
SHARD_TOKENS = 1 << 21
#: What a shard is planned for, and a cell of one place, as shares of that: hashes fill them unevenly.
PLANNED, CELL = 3 / 4, 1 / 12
#: Entries of the index that are added up at once.
ENTRIES = 1 << 20
K1, B = 1.2, 0.75
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def token_windows(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of kind 0, (doc_id, start, doc_tokens, length, near, ids): every document's ids, its end id
    included, in runs of `window` and a rest; and of kind 1: how many runs of a batch hold each id."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer_path)
        for part in batches(parts, 8192, 8 << 20):
            ends, ids = bpe.texts(strings(part.column(1)))
            lengths = np.diff(ends) + 1
            all_ids = np.insert(ids, ends[1:], end).astype("<u4")
            firsts = np.concatenate([[0], np.cumsum(lengths)])
            runs = -(-lengths // window)
            doc = np.repeat(np.arange(len(lengths)), runs)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)) * window
            length = np.minimum(window, lengths[doc] - start)
            spread, near = np.zeros(bpe.size, np.int64), np.zeros(len(doc), np.int64)
            at = firsts[doc] + start
            for i, (a, n) in enumerate(zip(at.tolist(), length.tolist(), strict=True)):
                own = np.unique(all_ids[a : a + n])
                spread[own] += 1
                for k, term in enumerate(own[:-4:-1].tolist()):
                    near[i] |= term << (42 - 21 * k)
            data = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(np.append(at * 4, len(all_ids) * 4).astype(np.int64).tobytes()), pa.py_buffer(all_ids.tobytes())])
            n = len(doc) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(np.zeros(n - 1, np.int32), 1), pa.int32()),
                    pa.concat_arrays([part.column(0).take(pa.array(doc)).cast(pa.int64()), pa.nulls(1, pa.int64())]),
                    pa.array(np.append(start, 0)),
                    pa.array(np.append(lengths[doc], 0)),
                    pa.array(np.append(length, 0)),
                    pa.array(np.append(near, 0)),
                    pa.concat_arrays([data.cast(pa.binary()), pa.array([spread.astype("<i8").tobytes()], pa.binary())]),
                ],
                ["kind", "doc_id", "start", "doc_tokens", "length", "near", "ids"],
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(cut, "kind int, doc_id long, start long, doc_tokens long, length long, near long, ids binary")


def _spread_terms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for part in parts:
        for value in part.column(0):
            counts = np.frombuffer(value.as_buffer(), "<i8")
            total = counts.copy() if total is None else total + counts
    if total is not None:
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(total[terms])], ["term", "df"])


def deal(runs: DataFrame, shard_tokens: int) -> DataFrame:
    """runs with their shard. What is counted on the driver has a row per id of the vocabulary at most; places with
    too many tokens are joined to the runs."""
    planned, cell = max(1, int(shard_tokens * PLANNED)), max(1, int(shard_tokens * CELL))
    head = F.shiftright("near", 42)
    sizes = runs.groupBy(head.alias("head")).agg(F.sum("length").alias("tokens")).orderBy("head").toArrow()
    heads, first, shards, shard, room = sizes["head"].to_pylist(), [], [], -1, 0
    for tokens in sizes["tokens"].to_pylist():
        if tokens > planned:
            shards.append(-(-tokens // planned))
            first.append(shard + 1)
            shard, room = shard + shards[-1], 0
            continue
        if tokens > room:
            shard, room = shard + 1, planned
        room -= tokens
        first.append(shard)
        shards.append(1)
    spark = runs.sparkSession
    table = spark.createDataFrame(list(zip(heads, first, shards, strict=True)), "head long, first long, shards long")
    crowded = stage(runs.groupBy("near").agg(F.sum("length").alias("tokens")).filter(F.col("tokens") > cell).selectExpr("near", f"tokens div {cell} + 1 AS cells"), "crowded")
    own = F.when(F.col("cells").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id", "start", "ids"), "cells"))
    met = runs.withColumn("head", head).join(F.broadcast(table), "head").join(crowded, "near", "left")
    return met.withColumn("shard", F.col("first") + F.pmod(F.xxhash64("near", own), "shards")).select(*runs.columns, "shard")


def fill_windows(lists: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (piece, first, end) over pieces shorter than a window, in their order. A seed
    asks with all its terms."""
    terms, docs, weights = [], [], []
    for i, ids in enumerate(lists):
        own, tf = np.unique(ids, return_counts=True)
        value = idf[own] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean))
        terms.append(own)
        docs.append(np.full(len(own), i, np.int32))
        weights.append(value.astype(np.float32))
    if not lists:
        return
    term, doc, weight = np.concatenate(terms), np.concatenate(docs), np.concatenate(weights)
    order = np.argsort(term, kind="stable")
    term, doc, weight = term[order], doc[order], weight[order]
    firsts = np.searchsorted(term, np.arange(len(idf) + 1))
    unused, next_unused = np.ones(len(lists), bool), 0
    carry: tuple[int, int] | None = None
    made: list[tuple[int, int, int]] = []
    room = window

    def add(i: int, first: int) -> tuple[int, int] | None:
        """Put what fits of piece i into the window; the cut, if any is left."""
        nonlocal room
        end = min(len(lists[i]), first + room)
        made.append((i, first, end))
        room -= end - first
        return (i, end) if end < len(lists[i]) else None

    while True:
        if carry is None:
            while next_unused < len(lists) and not unused[next_unused]:
                next_unused += 1
            if next_unused == len(lists):
                break
            carry = (next_unused, 0)
            unused[next_unused] = False
        seed = carry[0]
        carry = add(*carry)
        if room and carry is None:
            score, asked = np.zeros(len(lists)), terms[seed]
            steps = np.cumsum(firsts[asked + 1] - firsts[asked]) // ENTRIES
            for own in np.split(asked, np.flatnonzero(np.diff(steps)) + 1):
                spans = [slice(firsts[t], firsts[t + 1]) for t in own]
                score += np.bincount(np.concatenate([doc[s] for s in spans]), np.concatenate([weight[s] for s in spans]), len(lists))
            near = np.flatnonzero(unused & (score > 0))
            for i in near[np.argsort(-score[near], kind="stable")].tolist():
                unused[i] = False
                carry = add(i, 0)
                if not room:
                    break
        if not room:
            yield made
            made, room = [], window
    if made:
        yield made


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ids in windows of at most `window`: one row per piece (PIECES), ids as
    little-endian unsigned 32-bit numbers.

    Null and empty texts are the end id alone. Repeated rows are packed each; their starts repeat too.
    A shard's rows meet in one task: about shard_tokens ids, whatever the corpus size and however many
    copies a text has. An empty table gives no rows. Other columns are ignored."""
    spark = docs.sparkSession
    staged = stage(token_windows(docs, tokenizer_path, window, END, id_col, text_col), "windows")
    runs = staged.filter("kind = 0").drop("kind")
    n, total = runs.agg(F.count("*"), F.sum("length")).first()
    spread = staged.filter("kind = 1").select("ids").mapInArrow(_spread_terms, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    found = spread.toArrow().to_pandas()  # at most one row per id of the vocabulary
    df = np.zeros(int(found["term"].max()) + 1 if len(found) else 1)
    df[found["term"].to_numpy(np.int64)] = found["df"]
    n, total = n or 1, total or 1
    idf = spark.sparkContext.broadcast(np.log1p((n - df + 0.5) / (df + 0.5)))

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("doc_tokens", "ascending"), ("ids", "ascending")]).combine_chunks()
        shard = table.column("shard")[0].as_py()
        ids = [np.frombuffer(x.as_buffer(), "<u4") for x in table.column("ids")]
        length = np.asarray(table.column("length"))
        whole = np.flatnonzero(length == window)
        rests = np.flatnonzero(length < window)
        pieces = [[(int(i), 0, window)] for i in whole]
        pieces += [[(int(rests[i]), a, b) for i, a, b in w] for w in fill_windows([ids[i] for i in rests], idf.value, total / n, window)]
        rows, sequence, offset, first, data = [], [], [], [], []
        for k, made in enumerate(pieces):
            at = 0
            for i, a, b in made:
                rows.append(i)
                first.append(a)
                sequence.append(shard << 32 | k)
                offset.append(at)
                data.append(ids[i][a:b].tobytes())
                at += b - a
        rows = np.array(rows, np.int64)
        taken = table.take(pa.array(rows))
        return pa.table(
            [
                taken.column("doc_id"),
                pa.array(np.asarray(taken.column("start")) + np.array(first, np.int64)),
                pa.array([len(d) // 4 for d in data], pa.int64()),
                taken.column("doc_tokens"),
                pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
                pa.array(data, pa.binary()),
            ],
            ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )

    return deal(runs, shard_tokens).drop("near").groupBy("shard").applyInArrow(fill, PIECES)
