"""Similarity join on word n-grams with an R-tree over count vectors.

A document is the set of its shingles' hashes. The range of hashes is cut into groups, and a set is
the point of its counts per group. Sums of coordinate minima bound the overlap of two sets, and of a set with
all sets in a box.

The upper level of the tree is a fixed set of boxes. Two sets that link differ in at most t shingles, t
following from their size. If the range is cut into t + 1 + m groups, at least m + 1 groups hold the
same shingles in both. So a set lies in one box per group, named by what the group holds. The m boxes of a
set that hold the fewest shingles are left out, as unlike sets share those most often: linked sets have m + 1 boxes in
common and leave out by one order, so they still share one. Boxes with one set are dropped. Each other set lives in
the fullest of its boxes, a leaf, and visits the leaves of the sets it shares a box with; leaves and their visitors
are dealt in blocks of bounded size.

Sets that share a box by chance grow faster than the corpus, and a set is larger than its text. So bitmaps of the
sets meet in the leaves first: places that only one of two bitmaps has are shingles that only one of the sets has.
Sets that are ruled out with every other set leave the leaf before sets are made and shuffled.

In a leaf, points are packed by size into nodes with their upper corners. Nodes, then points, are
dropped by the bound; survivors are verified on the sets themselves. Pairs that are already connected
are not looked at again, so a leaf gives a forest of links, never all pairs of a group. Equal
sets are one point.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.llm.common import MIX_A, batches, components, hash_filter, hash_strings, in_filter, mix, split_words, stage, strings
from palate.llm.line_dedup import Bitmaps, bitmaps
from palate.operators.staging import discard

#: Bytes of sets in a leaf, and visitors dealt to one task with it.
LEAF_BYTES = 8 << 20
VISITORS = 16384
NODE = 32


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: A-Z in lower case, words between ASCII
    white space; a text of fewer words is one shingle, one without words has none."""
    offsets, codes, distinct = split_words(pc.ascii_lower(texts), ascii_only=True)
    hashes = hash_strings(distinct)[codes]
    lengths = np.diff(offsets)
    span = np.minimum(lengths, words)
    counts = np.where(lengths > 0, lengths - span + 1, 0)
    ends = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(offsets[:-1] - ends[:-1], counts) + np.arange(ends[-1])
    each = np.repeat(span, counts)
    value = each.astype(np.uint64)
    for k in range(words):
        more = each > k
        step = value * MIX_A + hashes[np.minimum(at + k, max(len(hashes) - 1, 0))] if len(hashes) else value
        value = np.where(more, mix(step), value)
    return [np.unique(value[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def name_of(found: np.ndarray) -> int:
    """A set's own hash, as a signed number."""
    ends = np.array([len(found)], np.uint64) * MIX_A + mix(found).sum(dtype=np.uint64)
    return int(mix(ends).view(np.int64)[0])


@cache
def _size_classes(top: int, p: int, q: int) -> tuple[int, ...]:
    """Upper sizes of classes: a set in one links only into its own, the class below and that above."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, out[-1] * q // p))
    return tuple(out)


def box_keys(found: np.ndarray, p: int, q: int) -> np.ndarray:
    """The names of the boxes of a set, for links at p/q or more: as the smaller set of its size
    class, and as the larger one of the class below. Boxes that are left out are the last in the order of their shingles' number and
    their names, which is the same for all sets."""
    n = len(found)
    tops = _size_classes(1 << max(16, n.bit_length() + 1), p, q)
    own = int(np.searchsorted(tops, n))
    mixed, keys = mix(found), []
    for c in (own, own - 1):
        differ = tops[c] * (q - p) // p if c >= 0 else 0
        if not differ or not n:
            continue
        spare = 2 + differ // 4
        groups = differ + 1 + spare
        cuts = _cuts(groups)
        firsts = np.searchsorted(found, cuts)
        counts = np.diff(np.append(firsts, n))
        full = np.flatnonzero(counts)
        sums = np.zeros(groups, np.uint64)
        sums[full] = np.add.reduceat(mixed, firsts[full])
        names = mix(sums + mix(np.arange(groups, dtype=np.uint64) * MIX_A + np.uint64(c)) + counts.astype(np.uint64))
        keys.append(names[np.lexsort([names, counts])[spare:]])
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


@cache
def _cuts(groups: int) -> np.ndarray:
    return np.array([-(-(j << 64) // groups) for j in range(groups)], np.uint64)


def _sets_of(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, node, bits, text_hash) of every row; node and bits are null for a document without words."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 4096, 8 << 20):
            sets = shingle_sets(strings(part.column(1)), words)
            sizes = np.array([len(found) for found in sets], np.int64)
            full = np.flatnonzero(sizes)
            nodes = pa.array([name_of(sets[i]) for i in full], pa.int64())
            starts, flat = bitmaps(np.append(0, np.cumsum(sizes[full])), np.concatenate([*sets, np.zeros(0, np.uint64)]))
            maps = pa.Array.from_buffers(pa.large_binary(), len(full), [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(flat)])
            which = pa.array(np.cumsum(sizes > 0) - 1, mask=sizes == 0)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), nodes.take(which), maps.take(which).cast(pa.binary()), part.column(2)], ["doc_id", "n_shingles", "node", "bits", "text_hash"])

    return docs.select("doc_id", "text", _text_hash()).mapInArrow(cut, "doc_id long, n_shingles long, node long, bits binary, text_hash long")


def _text_hash() -> Column:
    return F.xxhash64("text").alias("text_hash")


def _boxes_of(docs: DataFrame, words: int, p: int, q: int) -> DataFrame:
    """(key, node): the boxes of every set that is not empty, once per batch. They are several times the size
    of the texts, so they are made where they are shuffled and not written before."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 4096, 8 << 20):
            seen, nodes, keys = set(), [], []
            for found in shingle_sets(strings(part.column(0)), words):
                if len(found) and (node := name_of(found)) not in seen:
                    seen.add(node)
                    nodes.append(node)
                    keys.append(box_keys(found, p, q).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["node", "keys"])

    found = docs.select("text").mapInArrow(cut, "node long, keys array<long>")
    return found.select(F.explode("keys").alias("key"), "node")


def count_vectors(sets: list[np.ndarray]) -> np.ndarray:
    """Points of the sets: counts in equal groups of the hashes' range, at least one group for two
    members of the largest set."""
    bits = min(13, max(6, (max(map(len, sets)) // 2).bit_length()))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    group = (np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64)
    counts = np.bincount((owner << bits) + group, minlength=len(sets) << bits).reshape(len(sets), 1 << bits)
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.int32)


def leaf_links(sets: list[np.ndarray], own: np.ndarray, p: int, q: int) -> list[tuple[int, int]]:
    """A forest of links p/q among sets, which are in the order of their sizes: every link between a
    set of the leaf (own) and any other is implied by it."""
    sizes = np.array([len(s) for s in sets])
    points = count_vectors(sets)
    firsts = np.arange(0, len(sets), NODE)
    corners = np.maximum.reduceat(points, firsts, axis=0)
    component = np.arange(len(sets))
    links: list[tuple[int, int]] = []

    def needed(i: int, others: np.ndarray) -> np.ndarray:
        return -(-p * (sizes[i] + others) // (p + q))

    for i in np.flatnonzero(own).tolist():
        # an own set meets later own sets, and all visitors that are close enough in size
        low, high = np.searchsorted(sizes, [-(-sizes[i] * p // q), sizes[i] * q // p + 1])
        if high - low < 2:
            continue
        nodes = np.arange(low // NODE, (high - 1) // NODE + 1)
        reach = np.minimum(corners[nodes], points[i]).sum(axis=1, dtype=np.int64)
        nodes = nodes[reach >= needed(i, np.maximum(sizes[firsts[nodes]], sizes[low]))]
        other = (nodes[:, None] * NODE + np.arange(NODE)).ravel()
        other = other[(other >= low) & (other < high)]
        other = other[(component[other] != component[i]) & (~own[other] | (other > i))]
        if not len(other):
            continue
        bound = np.minimum(points[other], points[i]).sum(axis=1, dtype=np.int64)
        keep = bound >= needed(i, sizes[other])
        other = other[keep][np.argsort(-bound[keep], kind="stable")]
        while len(other):
            _, first = np.unique(component[other], return_index=True)
            tried = np.zeros(len(other), bool)
            tried[first] = True
            tried[:16] = True
            now = other[tried]
            lists = [sets[j] for j in now]
            same = np.add.reduceat(np.isin(np.concatenate(lists), sets[i]), np.concatenate([[0], np.cumsum(sizes[now])[:-1]]), dtype=np.int64)
            for j in now[same >= needed(i, sizes[now])].tolist():
                if component[j] != component[i]:
                    links.append((i, j))
                    component[component == component[j]] = component[i]
            other = other[~tried]
            other = other[component[other] != component[i]]
    return links


def partnered(maps: Bitmaps, own: np.ndarray, p: int, q: int) -> np.ndarray:
    """Which sets, in the order of their sizes, their bitmaps do not rule out with every other: two of the leaf (own), or one
    of the leaf and a visitor. Pairs of sets that are both known to stay are not looked at."""
    sizes, stay = maps.sizes, np.zeros(len(own), bool)
    for i in np.flatnonzero(own).tolist():
        other = np.arange(*np.searchsorted(sizes, [-(-sizes[i] * p // q), sizes[i] * q // p + 1]))
        other = other[(~own[other] | (other > i)) & ~(stay[i] & stay[other])]
        if len(other):
            near = other[maps.may_link(np.full(len(other), i), other)]
            stay[near] = True
            stay[i] |= len(near) > 0
    return stay


def _visits(shared: DataFrame, sizes: DataFrame) -> DataFrame:
    """(leaf, node, own) from (key, node, sharers) and (node, n_shingles): a row per set and leaf it meets."""
    per_leaf = F.greatest(F.lit(16), F.floor(F.lit(LEAF_BYTES) / (F.col("n_shingles") * 8)))
    home = shared.groupBy("node").agg(F.max(F.struct("sharers", "key")).alias("home")).join(sizes, "node")
    home = stage(home.select("node", F.xxhash64("home.key", F.pmod(F.xxhash64("node"), F.ceil(F.col("home.sharers") / per_leaf))).alias("home")), "homes")
    lived = shared.select("key", "node").join(home, "node")
    leaves = lived.select("key", F.col("home").alias("leaf")).distinct()
    met = lived.join(leaves, "key").filter(F.col("leaf") <= F.col("home"))  # of two leaves, the lesser compares
    visits = stage(met.select("leaf", "node", (F.col("leaf") == F.col("home")).alias("own")).distinct(), "visits")
    discard(home)
    return visits


def _open(dealt: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """The rows (leaf, block, node, own) of dealt whose sets may link with another one of the block, with the text_hash of a text
    that has the set."""

    def check(table: pa.Table) -> pa.Table:
        table = table.take(np.lexsort([table.column("node"), table.column("n_shingles")])).combine_chunks()
        own = np.asarray(table.column("own"))
        maps = Bitmaps(table.column("bits").chunk(0), np.asarray(table.column("n_shingles")), p / q)
        return table.select(["leaf", "block", "node", "own", "text_hash"]).filter(pa.array(partnered(maps, own, p, q)))

    known = sets.filter("node is not null").select("node", "n_shingles", "bits", "text_hash").dropDuplicates(["node"])
    return dealt.join(known, "node").groupBy("leaf", "block").applyInArrow(check, "leaf long, block int, node long, own boolean, text_hash long")


def links(docs: DataFrame, sets: DataFrame, words: int, p: int, q: int) -> DataFrame:
    """Edges (a, b) between the sets of docs (text), of which `sets` tells: a forest of the links' components."""
    keyed = _boxes_of(docs, words, p, q)
    box = Window.partitionBy("key")
    shared = keyed.withColumn("sharers", F.count("*").over(box)).filter("sharers > 1").withColumn("least", F.min("node").over(box)).withColumn("most", F.max("node").over(box))
    shared = stage(shared.filter("least <> most").select("key", "node", "sharers").distinct(), "boxes")
    visits = _visits(shared, sets.select("node", "n_shingles").distinct())
    crowd = visits.filter(~F.col("own")).groupBy("leaf").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.coalesce("n", F.lit(0)) / VISITORS).cast("int")
    dealt = visits.join(crowd, "leaf", "left").withColumn("blocks", F.greatest(blocks, F.lit(1)))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    one = F.array(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.select("leaf", "node", "own", F.explode(F.when(F.col("own"), every).otherwise(one)).alias("block"))
    rest = stage(_open(dealt, sets, p, q), "open")
    discard(shared, visits)
    bits = docs.sparkSession.sparkContext.broadcast(hash_filter(rest.select("text_hash").distinct(), "text_hash"))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = (part.filter(pa.array(in_filter(bits.value, np.asarray(part.column(1))))) for part in parts)
        for part in batches(named, 4096, 8 << 20):
            seen, names, data = set(), [], []
            for found in shingle_sets(strings(part.column(0)), words):
                if len(found) and (node := name_of(found)) not in seen:
                    seen.add(node)
                    names.append(node)
                    data.append(found.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(data, pa.binary())], ["node", "members"])

    def compare(table: pa.Table) -> pa.Table:
        names = np.asarray(table.column("node"))
        found = [np.frombuffer(x.as_buffer(), "<u8") for x in table.column("members")]
        own = np.asarray(table.column("own"))
        order = np.lexsort([names, [len(s) for s in found]])
        forest = np.array(leaf_links([found[i] for i in order], own[order], p, q), np.int64).reshape(-1, 2)
        return pa.table([pa.array(names[order[forest[:, 0]]]), pa.array(names[order[forest[:, 1]]])], ["a", "b"])

    members = docs.select("text", _text_hash()).mapInArrow(cut, "node long, members binary").dropDuplicates(["node"])
    meet = rest.select("leaf", "block", "node", "own").join(members, "node")
    return meet.groupBy("leaf", "block").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: rows link when the Jaccard similarity of
    their shingle sets is similarity (a fraction of whole numbers) or more; component_id is the least
    id that is reachable by links.

    Rows without words or text have no shingles and link with nothing. Equal sets always link.
    Repeated rows are in one component. Null ids are never the least; a component of null ids only has a null one. Empty
    tables give no rows; other columns are ignored."""
    p, q = similarity
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = stage(_sets_of(source, words), "shingle-sets")
    roots = components(links(source, sets, words, p, q), "documents").select("node", "root")
    classed = sets.filter("node is not null").select("doc_id", "n_shingles", "node").join(roots, "node", "left").select("doc_id", "n_shingles", F.coalesce("root", "node").alias("root"))
    least = classed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = sets.filter("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return classed.join(least, "root").select("doc_id", "n_shingles", "component_id").unionByName(alone)
