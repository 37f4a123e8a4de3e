"""Helpers that several operators share: staged tables, batches of texts, hashes."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palate.operators.staging import discard, staging_path

#: Odd 64-bit multipliers of the mixing steps.
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xD6E8FEB86659FD93)


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer file is; PALATE_TOKENIZERS names another folder."""
    if folder := os.environ.get("PALATE_TOKENIZERS"):
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def package_path(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it, unless it is installed there,
    and let them give large arrays back to the machine as soon as they are freed."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    env.setdefault("MALLOC_MMAP_THRESHOLD_", str(1 << 20))
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")


def stage(df: DataFrame, label: str) -> DataFrame:
    """df, written once below the shared folder and read back: cuts the lineage, survives the loss
    of executors and is computed once however often it is read."""
    path = staging_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, group: str, order: Sequence[Column], label: str) -> DataFrame:
    """df sorted by group (null first) and order, staged, with `at`, a number that rises along the sort and
    counts without gaps inside each range of it (at >> 33). A large group spreads over many ranges; end order
    with something that makes rows distinct, or equal rows share one range."""
    return stage(df.orderBy(F.asc_nulls_first(group), *order).withColumn("at", F.monotonically_increasing_id()), label)


def group_places(placed: DataFrame, group: str) -> DataFrame:
    """The rows of `in_order` with their 0-based `place` in their group (null is a group), the group's size `n`
    and its `base`, the `at` of its first row. Counts meet per range and group, so no task sees a whole group."""
    part = F.shiftright("at", 33)
    runs = placed.groupBy(part.alias("_run"), F.col(group).alias("_group")).agg(F.count("*").alias("_rows"), F.min("at").alias("_first"))
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_run", "_group", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("n"), F.min("_first").over(whole).alias("base"))
    met = placed.join(runs, (part == F.col("_run")) & F.col(group).eqNullSafe(F.col("_group")))
    return met.select(*placed.columns, (F.col("_before") + F.col("at") - F.col("_first")).alias("place"), "n", "base")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * MIX_B
    x = x ^ (x >> np.uint64(29))
    x = x * MIX_A
    return x ^ (x >> np.uint64(32))


def strings(column: pa.Array) -> pa.Array:
    """The column as strings without nulls (null: empty), copied if it is a part of a longer one:
    the ASCII case kernel reads such parts wrongly."""
    values = pc.fill_null(column.cast(pa.large_string()), "")
    first = np.frombuffer(values.buffers()[1], np.int64, 1, 8 * values.offset) if len(values) else [0]
    return values.take(pa.array(range(len(values)), pa.int64())) if first[0] else values


def split_words(texts: pa.Array, ascii_only: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between white space of many texts: (offsets of the texts, codes, distinct words)."""
    lists = (pc.ascii_split_whitespace if ascii_only else pc.utf8_split_whitespace)(texts)
    return encode_lists(lists)


def encode_lists(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Lists of strings as (offsets, codes, distinct strings), empty strings left out."""
    words = lists.flatten()
    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    full = np.asarray(pc.not_equal(words, ""))
    if not full.all():
        kept = np.concatenate([[0], np.cumsum(full)])
        offsets, words = kept[offsets], words.filter(pa.array(full))
    coded = words.dictionary_encode()
    return offsets.astype(np.int64), np.asarray(coded.indices), coded.dictionary


def hash_strings(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same on every machine: its words of eight bytes, mixed with
    their places, added up and mixed again."""
    values = values.cast(pa.large_string())
    if not len(values):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    lengths = np.diff(offsets)
    data = np.zeros(offsets[-1] - offsets[0] + 8, np.uint8)  # eight more, so that every byte starts a word
    if offsets[-1] > offsets[0]:
        data[:-8] = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    counts = lengths // 8 + 1
    ends = np.cumsum(counts)
    place = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
    word = words[np.repeat(offsets[:-1] - offsets[0], counts) + 8 * place]
    rest = (8 * (lengths % 8)).astype(np.uint64)
    word[ends - 1] &= (np.uint64(1) << rest) - np.uint64(1)
    total = np.add.reduceat(mix(word + (place + 1).astype(np.uint64) * MIX_A), ends - counts)
    return mix(total + lengths.astype(np.uint64) * MIX_B)


def batches(parts: Iterator[pa.RecordBatch], rows: int = 4096, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded rows and bytes, one long row at least."""
    for part in parts:
        start = 0
        while start < part.num_rows:
            n = min(rows, part.num_rows - start)
            while n > 1 and part.slice(start, n).nbytes > size:
                n //= 2
            yield part.slice(start, n)
            pa.default_memory_pool().release_unused()
            start += n


#: Bits of a filter of hashes: its size is fixed, 8 MB, so it may be broadcast whatever it holds.
FILTER_BITS = 26


def hash_filter(hashes: DataFrame, name: str) -> np.ndarray:
    """A Bloom filter of a column of 64-bit hashes, two bits each, as 64-bit words; at most 2^20 rows
    reach the driver. The more hashes, the more others pass it."""
    mask = (1 << FILTER_BITS) - 1
    places = F.explode(F.array(F.col(name).bitwiseAND(F.lit(mask)), F.shiftrightunsigned(name, 32).bitwiseAND(F.lit(mask))))
    bits = hashes.select(places.alias("at")).select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    found = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter; all that are pass."""
    hashes, mask = hashes.view(np.uint64), np.uint64((1 << FILTER_BITS) - 1)
    passed = np.ones(len(hashes), bool)
    for at in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        passed &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return passed


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of a graph with edges (a long, b long): (node, root), root being the
    smallest node reachable. Nodes without an edge to another node are not listed.

    Alternates large-star and small-star steps until nothing changes; every step is a
    grouped minimum and a join, staged, and holds no more rows than there are edges."""
    a, b = F.col("a"), F.col("b")
    now = stage(edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), f"{label}-edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64(a, b).cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(a.alias("node"), b.alias("root"))
        seen = state
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(b.alias("x"), a.alias("y"), "m")
        small = small.select(F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("m").alias("b")), F.struct(F.col("y").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        before, now = now, stage(small.filter(a != b).distinct(), f"{label}-star")
        discard(before)


class KeyTable:
    """An immutable open hash table in arrays: 64-bit keys to their index, -1 for others."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.append(keys.astype(np.uint64), np.uint64(0))
        self.bits = max(10, int(len(keys)).bit_length() + 4)
        self.slots = np.full(1 << self.bits, -1, np.int32)
        for i, at in enumerate(self._home(keys.astype(np.uint64)).tolist()):
            while self.slots[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.slots[at] = i

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MIX_A) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        shape, keys = keys.shape, keys.ravel()
        at = self._home(keys)
        out = self.slots[at]
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            out[open_] = got = self.slots[at[open_]]
            open_ = open_[(got >= 0) & (self.keys[got] != keys[open_])]
        return out.reshape(shape)


def gather(offsets: np.ndarray, values: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value lists of codes one after another, and their new offsets."""
    lengths = (offsets[1:] - offsets[:-1])[codes]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    out = np.empty(ends[-1], values.dtype)
    for a in range(0, len(codes), 1 << 17):  # some at a time, for the sake of memory
        own, from_, to = codes[a : a + (1 << 17)], ends[a], ends[min(a + (1 << 17), len(codes))]
        first = ends[a : a + len(own)] - from_
        out[from_:to] = values[np.repeat(offsets[own] - first, lengths[a : a + len(own)]) + np.arange(to - from_)]
    return out, ends
