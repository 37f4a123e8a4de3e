"""Fuzzy line deduplication: MinHash bands find similar lines, exact Jaccard decides, one line stays.

Lines are compared by their character shingles. A signature is the least hash in each of 60
bins of the shingles' hashes (one pass over a line, empty bins borrow from the next full one); 12
bands of 5 find 99 % of the pairs at the threshold and more above it.

Most lines of a bucket are unlike all others there. A bitmap of each line's shingles tells: a place that only one
of two bitmaps has is a shingle that only one of the lines has, so too many such places rule a pair out, and
no similar pair. Lines that are ruled out with every other line of their bucket leave it before texts are read. In what is
left of a bucket every line is checked against the first line, which connects most of what belongs together. Where the others
are not all connected by that, they are compared with each other, in blocks of bounded size; pairs that are
connected already are not looked at again. Checked
pairs are the edges of a graph; of each component the first line in the corpus stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palate.llm.common import MIX_A, batches, components, gather, hash_filter, hash_strings, in_filter, mix, stage, strings
from palate.operators.staging import discard

SHINGLE = 5
BANDS, ROWS = 12, 5
SIMILARITY = 0.8
#: Lines of a bucket, and bytes of their shingles, that meet as many others in one task.
BLOCK_LINES = 4096
BLOCK_BYTES = 8 << 20
#: Lines whose shingles are made at once, so that they stay in the processor's cache.
CACHED = 256
#: Places of the smallest bitmap; a larger one has a power of two, twice the line's shingles or more.
BITS = 256
#: Shingles of a line from which repeats are left out of their number.
LONG = 1024
#: Keys that meet in one part.
PART_KEYS = 1 << 20
#: Pairs whose sets are compared by one sort.
SORTED = 1024
#: Lines of a block of a bucket whose pairs are listed.
FEW = 64
#: Words of bitmaps that are compared at once.
WORDS = 1 << 20
EMPTY = np.uint64(2**64 - 1)
#: Odd factors of a shingle's characters.
FACTORS = [np.uint64(f | 1) for f in mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)).tolist()]


#: What a line with other white space than single spaces between words has, and a few more.
SPACED = r"^ |  | $|[\x00-\x1f\x{7f}-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}\x{3000}\x{feff}]"


def normal(lines: pa.Array) -> pa.Array:
    """Lines in lower case, white space as one space, none at the ends."""
    lower = pc.utf8_lower(lines)
    spaced = pc.match_substring_regex(lower, SPACED)
    if not pc.any(spaced).as_py():
        return lower
    words = pc.utf8_split_whitespace(lower.filter(spaced))
    return pc.replace_with_mask(lower, spaced, pc.utf8_trim_whitespace(pc.binary_join(words, pa.scalar(" ", words.type.value_type))))


def shingles(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes) of the character shingles of each line, repeats included; a line that is
    shorter than a shingle is one itself."""
    lengths = np.asarray(pc.utf8_length(lines)).astype(np.int64)
    counts = np.maximum(1, lengths - SHINGLE + 1)
    ends = np.concatenate([[0], np.cumsum(counts)])
    if not ends[-1]:
        return ends, np.zeros(0, np.uint64)
    gap = "\0" * (SHINGLE - 1)  # between lines, so that a short line's only shingle ends in it
    codes = np.frombuffer((gap.join(lines.to_pylist()) + gap + "\0").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = len(codes) - SHINGLE + 1
    value = codes[:size] * FACTORS[0]
    for k in range(1, SHINGLE):
        value += codes[k : k + size] * FACTORS[k]
    firsts = np.cumsum(lengths + len(gap)) - lengths - len(gap)
    value = value[np.repeat(firsts - ends[:-1], counts) + np.arange(ends[-1])]
    value ^= value >> np.uint64(32)
    value *= MIX_A
    value ^= value >> np.uint64(29)
    return ends, value


def bitmaps(ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets in bytes, bytes) of a bitmap of each line's shingles, by their last bits."""
    sizes = np.diff(ends)
    places = np.maximum(BITS, 1 << np.ceil(np.log2(2 * sizes)).astype(np.int64))
    starts = np.concatenate([[0], np.cumsum(places)])
    flat = np.zeros(starts[-1], bool)
    flat[np.repeat(starts[:-1], sizes) + (hashes & np.repeat((places - 1).astype(np.uint64), sizes)).view(np.int64)] = True
    return starts // 8, np.packbits(flat, bitorder="little")


def band_keys(lines: pa.Array) -> np.ndarray:
    """BANDS keys of each line."""
    return _band_keys(*shingles(lines))


def _band_keys(ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bins = BANDS * ROWS
    n = len(ends) - 1
    where = np.repeat(np.arange(n) * bins, np.diff(ends)) + (((hashes >> np.uint64(40)) * np.uint64(bins)) >> np.uint64(24)).astype(np.int64)
    flat = np.full(n * bins, EMPTY)
    np.minimum.at(flat, where, hashes & np.uint64(0xFFFFFFFFFF))
    signature = flat.reshape(n, bins)
    full = signature.copy()
    short = np.flatnonzero((signature == EMPTY).any(axis=1))
    for step in range(1, bins):
        if not len(short):
            break
        own = full[short]
        lent = np.roll(signature[short], -step, axis=1)
        lent = np.where(lent == EMPTY, EMPTY, lent + np.uint64(step << 41))
        full[short] = own = np.where(own == EMPTY, lent, own)
        short = short[(own == EMPTY).any(axis=1)]
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (n, BANDS)).copy()
    for r in range(ROWS):
        keys = mix(keys * MIX_A + full[:, r::ROWS])
    return keys


def signs(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(keys, sizes, bitmaps) of lines; a size counts shingles, with repeats unless there are many."""
    keys, sizes, ends, data = [np.zeros((0, BANDS), np.uint64)], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], [np.zeros(0, np.uint8)]
    for at in range(0, len(lines), CACHED):
        own = shingles(lines.slice(at, CACHED))
        keys.append(_band_keys(*own))
        sizes.append(np.diff(own[0]))
        for i in np.flatnonzero(sizes[-1] > LONG).tolist():
            sizes[-1][i] = len(np.unique(own[1][own[0][i] : own[0][i + 1]]))
        starts, flat = bitmaps(*own)
        ends.append(starts[1:] + ends[-1][-1])
        data.append(flat)
    maps = pa.Array.from_buffers(pa.large_binary(), len(lines), [None, pa.py_buffer(np.concatenate(ends)), pa.py_buffer(np.concatenate(data))])
    return np.concatenate(keys), np.concatenate(sizes), maps


def _cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, place in it, line) of the lines of texts, as they are."""
    lists = pc.split_pattern(strings(texts), "\n")
    rows = np.asarray(pc.list_parent_indices(lists)).astype(np.int64)
    return rows, np.arange(len(rows)) - (np.asarray(lists.offsets) - lists.offsets[0].as_py())[rows], lists.flatten()


def _place(uid: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return mix(uid.view(np.uint64) + pos.astype(np.uint64) * MIX_A).view(np.int64)


def _lines_of(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, pos, line, keys, size, bits, place) of every line that is not blank, from (uid, doc_id, text). What
    comes after line is set once for each distinct line of a batch."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 1024, 2 << 20):
            rows, pos, lines = _cut(part.column(2))
            lines = normal(lines)
            full = np.asarray(pc.not_equal(lines, ""))
            rows, pos, lines = rows[full], pos[full], lines.filter(pa.array(full))
            if not len(rows):
                continue
            coded = lines.dictionary_encode()
            codes = np.asarray(coded.indices).astype(np.int64)
            name = hash_strings(coded.dictionary).view(np.int64)
            _, first = np.unique(codes, return_index=True)  # codes are numbered as they come
            keys, sizes, maps = signs(coded.dictionary)
            has = np.zeros(len(codes), bool)
            has[first] = True
            which = pa.array(np.where(has, codes, 0), mask=~has)
            ends = np.concatenate([[0], np.cumsum(has * BANDS)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64)[codes[has]].ravel()), mask=pa.array(~has))
            uid = part.column(0).take(pa.array(rows))
            place = pa.array(_place(np.asarray(uid), pos), mask=~has)
            yield pa.RecordBatch.from_arrays(
                [uid, part.column(1).take(pa.array(rows)), pa.array(pos, pa.int32()), pa.array(name[codes]), lists, pa.array(sizes, pa.int64()).take(which), maps.take(which).cast(pa.binary()), place],
                ["uid", "doc_id", "pos", "line", "keys", "size", "bits", "place"],
            )

    return docs.mapInArrow(cut, "uid long, doc_id long, pos int, line long, keys array<long>, size long, bits binary, place long")


def _texts_of(places: DataFrame, docs: DataFrame) -> DataFrame:
    """(line, text) of the lines at these places and, as the filter lets a few others pass, some more."""
    bits = docs.sparkSession.sparkContext.broadcast(hash_filter(places, "place"))

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 1024, 2 << 20):
            rows, pos, lines = _cut(part.column(1))
            kept = in_filter(bits.value, _place(np.asarray(part.column(0))[rows], pos))
            lines = normal(lines.filter(pa.array(kept)))
            yield pa.RecordBatch.from_arrays([pa.array(hash_strings(lines).view(np.int64)), lines.cast(pa.string())], ["line", "text"])

    return docs.select("uid", "text").mapInArrow(read, "line long, text string").dropDuplicates(["line"])


def _buckets(lines: DataFrame, n_lines: int) -> DataFrame:
    """(bucket, line) of the buckets with more than one line. Bands whose buckets hold the same lines are one.

    Keys travel in packed lists to parts of a bounded number of keys, where equal ones meet."""
    spark = lines.sparkSession
    parts_ = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_lines * BANDS // PART_KEYS))

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column(0)
            key = np.asarray(lists.flatten())
            line = np.repeat(np.asarray(part.column(1)), np.diff(np.asarray(lists.offsets)))
            own = (mix(key.view(np.uint64)) % np.uint64(parts_)).astype(np.int32)
            order = np.argsort(own, kind="stable")
            both = np.stack([key[order], line[order]], axis=1)
            names, starts = np.unique(own[order], return_index=True)
            ends = np.append(starts, len(own))
            data = pa.Array.from_buffers(pa.large_binary(), len(names), [None, pa.py_buffer(ends.astype(np.int64) * 16), pa.py_buffer(both)])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), data.cast(pa.binary())], ["part", "rows"])

    def meet(table: pa.Table) -> pa.Table:
        key, line = np.concatenate([np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 2) for x in table.column("rows")]).T
        order = np.lexsort([line, key])
        key, line = key[order], line[order]
        new = np.append(True, (key[1:] != key[:-1]) | (line[1:] != line[:-1]))
        key, line = key[new], line[new].view(np.uint64)
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        counts = np.diff(np.append(starts, len(key)))
        bucket = np.repeat(mix(np.add.reduceat(mix(line), starts) + counts.astype(np.uint64) * MIX_A), counts)
        many = np.repeat(counts > 1, counts)
        return pa.table([pa.array(bucket[many].view(np.int64)), pa.array(line[many].view(np.int64))], ["bucket", "line"])

    dealt = lines.filter("keys is not null").select("keys", "line").mapInArrow(deal, "part int, rows binary")
    return dealt.groupBy("part").applyInArrow(meet, "bucket long, line long").distinct()


def _marks(lines: DataFrame, names: DataFrame) -> DataFrame:
    """(line, size, bits, place) of the named lines and, as the filter lets a few others pass, some more."""
    bits = lines.sparkSession.sparkContext.broadcast(hash_filter(names, "line"))

    def named(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield part.filter(pa.array(in_filter(bits.value, np.asarray(part.column(0)))))

    marks = lines.filter("keys is not null").select("line", "size", "bits", "place")
    return marks.mapInArrow(named, marks.schema).dropDuplicates(["line"])


class Bitmaps:
    """Bitmaps of many lines, narrowed where a narrower one is asked against them."""

    def __init__(self, maps: pa.Array, sizes: np.ndarray, similarity: float) -> None:
        maps = maps.cast(pa.large_binary())
        ends = np.frombuffer(maps.buffers()[1], np.int64)[maps.offset : maps.offset + len(maps) + 1]
        data = np.frombuffer(maps.buffers()[2], np.uint8)
        self.words, self.sizes = np.diff(ends) // 8, sizes
        #: By width, wide to narrow: where each line's bitmap is, and the bitmaps.
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.share = (1 - similarity) / (1 + similarity)
        wide, held = np.zeros((0, 0), np.uint64), np.zeros(0, np.int64)
        for width in (BITS // 64 << np.arange(40))[::-1].tolist():
            own = np.flatnonzero(self.words == width)
            if not len(own) and not len(held):
                continue
            wide = wide[:, :width] | wide[:, width:] if len(held) else np.zeros((0, width), np.uint64)
            flat, _ = gather(ends, data, own)
            wide, held = np.concatenate([wide, flat.view("<u8").reshape(len(own), width)]), np.concatenate([held, own])
            at = np.full(len(maps), -1)
            at[held] = np.arange(len(held))
            self.tables[width] = at, wide

    def may_link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs are not ruled out: their shingles may have the similarity."""
        width = np.minimum(self.words[a], self.words[b])
        out = np.zeros(len(a), bool)
        for w in np.unique(width).tolist():
            at, table = self.tables[w]
            for pairs in np.split(np.flatnonzero(width == w), range(max(1, WORDS // w), len(a), max(1, WORDS // w))):
                x, y = a[pairs], b[pairs]
                unlike = np.bitwise_count(table[at[x]] ^ table[at[y]]).sum(axis=1, dtype=np.int64)
                out[pairs] = unlike <= self.share * (self.sizes[x] + self.sizes[y]) + 1e-6
        return out


def _with_partner(rows: DataFrame, similarity: float, listed: bool = False) -> DataFrame:
    """Of rows (bucket, low, high, line, root, block, size, bits, ...), those whose line may be similar to a line of another root
    in the same bucket, low and high; if low is not high, in the other block. Or, listed, all such pairs: lines (a, b) and roots (ra, rb)."""
    box = ["bucket", "low", "high"]
    inner = [c for c in rows.columns if c not in box]
    schema = "a long, b long, ra long, rb long" if listed else rows.select(*box, *inner).schema

    def check(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 4096, 16 << 20):
            lists = part.column(3)
            counts = np.diff(np.asarray(lists.offsets))
            group = np.repeat(np.arange(len(counts)), counts)
            ends = np.cumsum(counts)[group]
            flat = lists.flatten()
            line, root, block = (np.asarray(flat.field(c)) for c in ("line", "root", "block"))
            two = (np.asarray(part.column(1)) != np.asarray(part.column(2)))[group]
            maps = Bitmaps(flat.field("bits"), np.asarray(flat.field("size")), similarity)
            found, links = np.zeros(len(flat), bool), []
            a, step = np.arange(len(flat)), 0
            while len(a):
                step += 1
                a = a[a + step < ends[a]]
                b = a + step
                open_ = ~(found[a] & found[b]) & (root[a] != root[b]) & (~two[a] | (block[a] != block[b]))
                x, y = a[open_], b[open_]
                near = maps.may_link(x, y)
                if listed:
                    links.append(np.stack([x[near], y[near]]))
                else:
                    found[x[near]] = found[y[near]] = True
            if listed:
                x, y = np.concatenate(links, axis=1)
                x, y = np.where(line[x] < line[y], x, y), np.where(line[x] < line[y], y, x)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (line[x], line[y], root[x], root[y])], ["a", "b", "ra", "rb"])
                continue
            own, taken = pa.array(group[found]), flat.filter(pa.array(found))
            yield pa.RecordBatch.from_arrays([*(part.column(i).take(own) for i in range(3)), *taken.flatten()], [*part.schema.names[:3], *(f.name for f in taken.type)])

    return rows.groupBy(*box).agg(F.collect_list(F.struct(*inner)).alias("lines")).mapInArrow(check, schema)


def similar_pairs(ends: np.ndarray, hashes: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs (a, b) of lists have sets of that Jaccard similarity or more; SORTED pairs at most. A shingle is
    known by the first 53 bits of its hash, the others name the pair and the side, so that one sort makes all sets meet."""
    sides = []
    for k, codes in enumerate((a, b)):
        flat, at = gather(ends, hashes, codes)
        tag = (np.arange(len(codes)) * 2 + k).astype(np.uint64)
        sides.append((flat & ~np.uint64(2 * SORTED - 1)) | np.repeat(tag, np.diff(at)))
    found = np.sort(np.concatenate(sides))
    found = found[np.append(True, found[1:] != found[:-1])] >> np.uint64(1)
    pair = (found & np.uint64(SORTED - 1)).astype(np.int64)
    held = np.bincount(pair, minlength=len(a))
    both = np.bincount(pair[1:][found[1:] == found[:-1]], minlength=len(a))
    return both >= similarity * (held - both)


def _similar(pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b, and other columns of numbers) whose lines' shingle sets have that Jaccard similarity or more, from their a_text and b_text."""
    rest = [c for c in pairs.columns if c not in ("a_text", "b_text")]

    def check(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 128, 1 << 18):
            n = part.num_rows
            coded = pa.concat_arrays([part.column(k).cast(pa.large_string()) for k in (0, 1)]).dictionary_encode()
            ends, hashes = shingles(coded.dictionary)
            codes = np.asarray(coded.indices).astype(np.int64)
            yield part.select(rest).filter(pa.array(similar_pairs(ends, hashes, codes[:n], codes[n:], similarity)))

    return pairs.select("a_text", "b_text", *rest).mapInArrow(check, pairs.select(*rest).schema)


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("line").alias(side), F.col("text").alias(f"{side}_text")), side)
    return pairs


def block_links(sets: list[np.ndarray], side: np.ndarray, component: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """A forest of links among sets of different components: every link of two sets is implied by it and by the
    components. If there are two sides, only sets of different sides are compared.

    The members of a set that are in the fewest others come first; sets that link share one of the first ones, as
    at least that share of the larger set is in both."""
    sizes = np.array([len(s) for s in sets])
    _, member, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.lexsort([member, held[member], owner])
    member = member[order]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    firsts = sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1
    listed = np.flatnonzero((np.arange(len(member)) - ends[owner] < firsts[owner]) & (held[member] > 1))
    listed = listed[np.argsort(member[listed], kind="stable")]
    holders, starts = owner[listed], np.searchsorted(member[listed], np.arange(len(held) + 1))
    component = component.copy()
    two = bool((side != side[0]).any())
    links: list[tuple[int, int]] = []
    for i in range(len(sets)):
        own = member[ends[i] : ends[i] + firsts[i]]
        other = np.concatenate([holders[starts[m] : starts[m + 1]] for m in own])
        other = other[(other > i) & (component[other] != component[i])]
        if two:
            other = other[side[other] != side[i]]
        other = np.unique(other)
        other = other[np.minimum(sizes[other], sizes[i]) >= similarity * np.maximum(sizes[other], sizes[i])]
        while len(other):
            _, first = np.unique(component[other], return_index=True)
            tried = np.zeros(len(other), bool)
            tried[first] = True
            tried[:16] = True
            now = other[tried]
            same = np.add.reduceat(np.isin(np.concatenate([sets[j] for j in now]), sets[i]), np.concatenate([[0], np.cumsum(sizes[now])[:-1]]), dtype=np.int64)
            for j in now[same >= similarity * (sizes[i] + sizes[now] - same)].tolist():
                if component[j] != component[i]:
                    links.append((i, j))
                    component[component == component[j]] = component[i]
            other = other[~tried]
            other = other[component[other] != component[i]]
    return links


def _rest_links(entries: DataFrame, roots: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) between components (line, root) whose lines are similar and share a bucket, from the lines
    (bucket, line, size, bits) of each bucket."""
    box = Window.partitionBy("bucket")
    known = entries.join(roots, "line", "left").withColumn("root", F.coalesce("root", "line"))
    open_ = known.withColumn("least", F.min("root").over(box)).withColumn("most", F.max("root").over(box)).filter("least <> most").drop("least", "most")
    sized = open_.withColumn("n", F.count("*").over(box)).withColumn("bytes", F.sum("size").over(box) * 8)
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_LINES, F.col("bytes") / BLOCK_BYTES)).cast("int")
    rest = stage(sized.select("bucket", "line", "root", "size", "bits", blocks.alias("blocks")), "line-rests")
    block = F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int")
    meet = rest.withColumn("block", block).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = meet.select("bucket", "line", "root", "block", "size", "bits", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
    left = _with_partner(dealt, similarity).withColumn("n", F.count("*").over(Window.partitionBy("bucket", "low", "high")))
    left = stage(left, "line-open")
    pairs = _with_partner(left.filter(F.col("n") <= FEW).drop("n"), similarity, True).distinct()
    linked = _similar(_with_texts(pairs, texts), similarity).select(F.col("ra").alias("a"), F.col("rb").alias("b"))

    def compare(table: pa.Table) -> pa.Table:
        names, roots, side = (np.asarray(table.column(c)) for c in ("line", "root", "block"))
        order = np.argsort(names)
        ends, hashes = shingles(table.column("text").combine_chunks().cast(pa.large_string()).take(pa.array(order)))
        sets = [np.unique(hashes[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        roots = roots[order]
        found = np.array(block_links(sets, side[order], np.unique(roots, return_inverse=True)[1], similarity), np.int64).reshape(-1, 2)
        return pa.table([pa.array(roots[found[:, 0]]), pa.array(roots[found[:, 1]])], ["a", "b"])

    many = left.filter(F.col("n") > FEW).select("bucket", "line", "root", "block", "low", "high")
    return linked.unionByName(many.join(texts, "line").groupBy("bucket", "low", "high").applyInArrow(compare, "a long, b long"))


def _entries(lines: DataFrame, n_lines: int, similarity: float) -> DataFrame:
    """(bucket, line, size, bits, place) of the lines that may be similar to another of their bucket; all lines of buckets that are
    more than a block."""
    buckets = stage(_buckets(lines, n_lines), "line-buckets")
    marks = _marks(lines, buckets.select("line").distinct())
    met = stage(buckets.join(marks, "line"), "line-marks")
    discard(buckets)
    large = met.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("size")).filter((F.col("n") > BLOCK_LINES) | (F.col("size") * 8 > BLOCK_BYTES)).select("bucket")
    large = F.broadcast(stage(large, "large-buckets"))  # each has a block of lines or bytes
    zero = F.lit(0)
    one = met.join(large, "bucket", "left_anti").select("bucket", zero.alias("low"), zero.alias("high"), "line", F.col("line").alias("root"), zero.alias("block"), "size", "bits", "place")
    entries = stage(_with_partner(one, similarity).select(*met.columns).unionByName(met.join(large, "bucket", "left_semi")), "line-partners")
    discard(met)
    return entries


def similar_lines(lines: DataFrame, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(line, root) of the lines that are similar to another: components of all pairs that share a bucket."""
    entries = _entries(lines, lines.filter("keys is not null").count(), similarity)
    hub = F.min("line").over(Window.partitionBy("bucket"))
    pairs = entries.select("line", hub.alias("a")).filter("a <> line").select("a", F.col("line").alias("b")).distinct()
    texts = stage(_texts_of(entries.select("place").distinct(), docs), "line-texts")
    near = components(_similar(_with_texts(pairs, texts), similarity), "lines").select(F.col("node").alias("line"), "root")
    more = components(_rest_links(entries, near, texts, similarity), "line-rests")
    discard(entries, texts)
    moved = near.join(more.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return moved.select("line", F.coalesce("top", "root").alias("root")).unionByName(more.select(F.col("node").alias("line"), "root"))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text's repeated lines left out, plus n_lines and n_dropped.

    Of all lines that are equal (but for case and white space) or similar through others, the first stays: that with the least
    id, null ids first, and the least place. Blank lines stay, and count as no lines. A null text stays null; a text whose
    lines all go is empty or blank. Two rows with the same id and text keep the same lines. Columns of docs named
    n_lines or n_dropped are replaced. Lines of any length take part whole."""
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    uid = F.xxhash64(F.col(id_col), F.col(text_col))
    keyed = docs.select(uid.alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = stage(_lines_of(keyed), "keyed-lines")
    lines = stage(found.select("uid", "doc_id", "pos", "line"), "lines")
    roots = similar_lines(found, keyed, similarity)
    discard(found)
    places = lines.join(roots, "line", "left").select("uid", F.struct("doc_id", "uid", "pos").alias("at"), "pos", F.coalesce("root", "line").alias("root"))
    firsts = places.groupBy("root").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").select("root", "first")
    dropped = places.join(firsts, "root").filter(~F.col("at").eqNullSafe(F.col("first"))).groupBy("uid").agg(F.collect_set("pos").alias("dropped"))
    inner = [F.col(c).alias(f"c{i}") for i, c in enumerate(rest)]
    at = rest.index(text_col)
    schema = docs.select(*rest).schema.add("n_lines", "long").add("n_dropped", "long")

    def rebuild(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 1024, 8 << 20):
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(part.column(at).to_pylist(), part.column(len(rest)).to_pylist(), strict=True):
                lines = [] if text is None else text.split("\n")
                n_lines.append(sum(1 for x in lines if x.strip()))
                n_dropped.append(len(gone or ()))
                if gone:
                    out = set(gone)
                    text = "\n".join(x for i, x in enumerate(lines) if i not in out)
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(part.columns[:-1])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], schema.names)

    joined = docs.select(*inner, uid.alias("uid")).join(dropped, "uid", "left").select(*[f"c{i}" for i in range(len(rest))], "dropped")
    return joined.mapInArrow(rebuild, schema)
