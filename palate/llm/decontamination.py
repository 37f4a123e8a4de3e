"""Benchmark decontamination: rare shared word pairs name passages, local alignment scores them.

A seed is a pair of an item's words, next to each other or with one word between. In an alignment that keeps a
share `keep` of an item's score, at least keep * L - 1 of the neighbouring matches of its L words have at most one
error between them, and each of these is a seed that the document holds. So it is enough to look for the
rarest L - (keep * L - 1) places of an item: one of them at least is in every copy, however common the rest of the
item is in the corpus. How common a pair is, is counted over all documents.

A document's words around the seeds that it shares with an item are a passage, wide enough for every copy; a
passage is aligned with the item word by word (Smith-Waterman), so that changed, missing and added words
lower the score instead of ending the match. The score is at most the share of the item's words that
the passage has, so passages with too few of them need no alignment.

Test items are a stated query set: they go through the documents in blocks of a fixed number of seeds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palate.llm.common import MIX_A, KeyTable, batches, encode_lists, hash_filter, hash_strings, in_filter, mix, stage, strings

THRESHOLD = 0.5
#: An item of fewer words must be there as it is; a longer one with as many words at least.
LEAST_WORDS = 6
#: Items of at least so many words have seeds; a shorter one is looked for whole.
SEEDED, SPAN = 3, 2
MATCH, MISMATCH, GAP = 2, -1, -1
#: Seeds of test items that go through the documents at once.
BLOCK_GRAMS = 1 << 18
#: Cells of a row of alignments that are worked on together.
CELLS = 1 << 20
#: Seeds found in documents, and words of passages, that are looked at together.
HITS = 1 << 20


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes) of the lower-case runs of letters and digits of each text."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN]+", " ")
    offsets, codes, distinct = encode_lists(pc.utf8_split_whitespace(plain))
    return offsets, hash_strings(distinct)[codes]


def grams(offsets: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of every run of `size` words."""
    counts = np.maximum(0, np.diff(offsets) - size + 1)
    ends = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(ends[-1]) - ends[text]
    at = offsets[text] + place
    value = np.full(len(at), size, np.uint64)
    for k in range(size):
        value = mix(value * MIX_A + words[at + k])
    return text, place, value


def pairs(offsets: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of every two words at a distance of SPAN or less, by the place of the first."""
    found = []
    for distance in range(1, SPAN + 1):
        counts = np.maximum(0, np.diff(offsets) - distance)
        ends = np.concatenate([[0], np.cumsum(counts)])
        text = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(ends[-1]) - ends[text]
        at = offsets[text] + place
        found.append((text, place, mix(mix(words[at] * MIX_A + np.uint64(1)) + words[at + distance])))
    text, place, value = (np.concatenate(x) for x in zip(*found, strict=True))
    return text, place, value


def kept_share(length: np.ndarray, threshold: float) -> np.ndarray:
    """The share of its own score that an item of so many words needs."""
    return np.maximum(threshold, np.minimum(1, LEAST_WORDS / np.maximum(length, 1)))


def needed_places(length: int, threshold: float) -> int:
    """How many places of an item, the rarest, are looked for: one more than a copy may lack."""
    held = max(1, int(np.ceil(kept_share(np.array([length]), threshold)[0] * length - 1 - 1e-9)))
    return length - held


def item_seeds(benchmark: DataFrame, threshold: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(item, item_id, words) of every different item, and (item, size, place, wanted, gram), its seeds: size 0 for pairs,
    else an item of so many words as a whole. Words are kept once per item."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 1024, 4 << 20):
            offsets, words = words_of(strings(part.column(1)))
            own = np.flatnonzero(np.diff(offsets))
            texts = [words[offsets[i] : offsets[i + 1]].tobytes() for i in own.tolist()]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own)), pa.array(texts, pa.binary())], ["item_id", "words"])

    def seed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k, text in enumerate(part.column(1)):
                words = np.frombuffer(text.as_py(), np.uint64)
                n, ends = len(words), np.array([0, len(words)])
                _, place, gram = grams(ends, words, n) if n < SEEDED else pairs(ends, words)
                size, wanted = (n, 1) if n < SEEDED else (0, needed_places(n, threshold))
                m = len(gram)
                yield pa.RecordBatch.from_arrays([part.column(0).slice(k, 1).take(pa.array(np.zeros(m, np.int64))), pa.array(np.full(m, size, np.int32)), pa.array(place), pa.array(np.full(m, wanted, np.int32)), pa.array(gram.view(np.int64))], ["item", "size", "place", "wanted", "gram"])

    rows = benchmark.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).dropDuplicates()
    items = rows.mapInArrow(cut, "item_id long, words binary").dropDuplicates()
    items = stage(items.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words"), "items")
    return items, items.select("item", "words").mapInArrow(seed, "item long, size int, place long, wanted int, gram long")


def rare_seeds(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """The seeds (item, size, place, gram) of each item's rarest places, by how often the documents hold their pairs."""
    names = seeds.filter("size = 0").select("gram").distinct()
    bits = docs.sparkSession.sparkContext.broadcast(hash_filter(names, "gram"))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 512, 2 << 20):
            _, _, gram = pairs(*words_of(strings(part.column(0))))
            gram, times = np.unique(gram[in_filter(bits.value, gram)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(times.astype(np.int64))], ["gram", "times"])

    counts = docs.select("text").mapInArrow(count, "gram long, times long").groupBy("gram").agg(F.sum("times").alias("times"))
    counted = seeds.join(counts, "gram", "left")
    places = counted.groupBy("item", "place", "wanted").agg(F.coalesce(F.sum("times"), F.lit(0)).alias("times"))
    order = F.row_number().over(Window.partitionBy("item").orderBy("times", "place"))
    rarest = places.withColumn("rank", order).filter(F.col("rank") <= F.col("wanted")).select("item", "place")
    return seeds.join(rarest, ["item", "place"]).select("item", "size", "place", "gram")


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """The best local alignment's score of each pair, as a share of the item's own."""
    out = np.zeros(len(items))
    order = sorted(range(len(items)), key=lambda i: (len(passages[i]), len(items[i])))
    start = 0
    while start < len(order):
        wide = len(passages[order[start]]) + 64
        group = [i for i in order[start : start + max(1, min(256, CELLS // wide))] if len(passages[i]) <= wide]
        start += len(group)
        names: dict[int, int] = {}
        rows, columns = max(len(items[i]) for i in group), max(len(passages[i]) for i in group)
        item, passage = np.full((len(group), rows), -1), np.full((len(group), columns), -2)
        for k, i in enumerate(group):
            item[k, : len(items[i])] = [names.setdefault(w, len(names)) for w in items[i].tolist()]
            passage[k, : len(passages[i])] = [names.setdefault(w, len(names)) for w in passages[i].tolist()]
        slope = GAP * np.arange(columns + 1)
        above = np.zeros((len(group), columns + 1), np.int64)
        best = np.zeros(len(group), np.int64)
        for r in range(rows):
            now = np.zeros_like(above)
            now[:, 1:] = np.maximum(0, above[:, :-1] + np.where(passage == item[:, r : r + 1], MATCH, MISMATCH))
            now = np.maximum(now, above + GAP)
            above = np.maximum.accumulate(now - slope, axis=1) + slope  # gaps in the item
            best = np.maximum(best, above.max(axis=1))
        out[group] = best / (MATCH * np.array([len(items[i]) for i in group]))
    return out


def passages(pair: np.ndarray, at: np.ndarray, place: np.ndarray, length: np.ndarray, item_length: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seed, start, end) of the ranges of documents' words to align with an item, from the seeds each pair of a document
    and an item shares: where the item would lie, with room for as many added words as a copy may have; ranges that
    overlap are one, named by its first seed."""
    room = np.ceil(2 * item_length * (1 - keep)).astype(np.int64) + SPAN
    start = at - place - room
    order = np.lexsort([start, pair])
    start, end = np.maximum(start, 0)[order], np.minimum(at - place + item_length + room, length)[order]
    pair = pair[order]
    firsts = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (start[1:] > end[:-1])))
    return order[firsts], start[firsts], end[np.append(firsts[1:], len(order)) - 1]


def item_words(items: list[np.ndarray]) -> tuple[KeyTable, np.ndarray]:
    """The distinct words of each item as keys of a table, and how often the item has each."""
    owner = np.repeat(np.arange(len(items)), [len(i) for i in items])
    keys, counts = np.unique(word_keys(np.concatenate(items), owner), return_counts=True)
    return KeyTable(keys), counts


def word_keys(words: np.ndarray, item: np.ndarray) -> np.ndarray:
    return mix(words * MIX_A + mix(item.astype(np.uint64) + np.uint64(1)))


def common_words(table: KeyTable, counts: np.ndarray, words: np.ndarray, start: np.ndarray, end: np.ndarray, item: np.ndarray) -> np.ndarray:
    """How many words of its item each range of words has, repeats as often as in both."""
    out = np.zeros(len(start), np.int64)
    ends = np.cumsum(end - start)
    a = 0
    while a < len(start):
        from_ = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, from_ + HITS, "right")))
        n = end[a:b] - start[a:b]
        at = np.repeat(start[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        found = table.find(word_keys(words[at], np.repeat(item[a:b], n)))
        own = np.repeat(np.arange(b - a), n)[found >= 0] * len(counts) + found[found >= 0]
        own, times = np.unique(own, return_counts=True)
        out[a:b] = np.bincount(own // len(counts), np.minimum(times, counts[own % len(counts)]), b - a)
        a = b
    return out


def _scores(docs: DataFrame, seeds: pa.Table, items: pa.Table, threshold: float) -> DataFrame:
    """(uid, item, score) of the pairs that score enough, for seeds (item, size, place, gram) and items (item, words)."""
    names = items["item"].to_numpy()
    order = np.argsort(names)
    names, lists = names[order], [np.frombuffer(items["words"][int(i)].as_py(), np.uint64) for i in order]
    sizes_, by_size = seeds["size"].to_numpy(), {}
    for size in np.unique(sizes_).tolist():
        own = seeds.filter(pa.array(sizes_ == size)).sort_by("gram")
        gram = own["gram"].to_numpy().view(np.uint64)
        first = np.append(True, gram[1:] != gram[:-1])
        by_size[size] = KeyTable(gram[first]), np.append(np.flatnonzero(first), len(gram)), np.searchsorted(names, own["item"].to_numpy()), own["place"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast((by_size, names, lists, item_words(lists) if lists else None))

    def scored(uids: pa.Array, offsets: np.ndarray, words: np.ndarray) -> Iterator[pa.RecordBatch]:
        by_size, names, lists, known = shared.value
        found, total = [], 0
        for size, (table, firsts, _, _) in by_size.items():
            text, at, gram = grams(offsets, words, size) if size else pairs(offsets, words)
            seed = table.find(gram)
            text, at, seed = text[seed >= 0], at[seed >= 0], seed[seed >= 0]
            n = firsts[seed + 1] - firsts[seed]
            total += int(n.sum())
            found.append((size, text, at, seed, n))
        if not total:
            return
        half = len(uids) // 2
        if total > HITS and half:
            middle = offsets[half]
            yield from scored(uids.slice(0, half), offsets[: half + 1], words[:middle])
            yield from scored(uids.slice(half), offsets[half:] - middle, words[middle:])
            return
        hits = []
        for size, text, at, seed, n in found:
            _, firsts, owner, places = by_size[size]
            seed = np.repeat(firsts[seed] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            hits.append(np.stack([np.repeat(text, n), owner[seed], np.repeat(at, n), places[seed]]))
        text, item, at, place = np.concatenate(hits, axis=1)
        sizes = np.array([len(x) for x in lists])
        keep = kept_share(sizes, threshold)
        seed, start, end = passages(text * len(lists) + item, at, place, np.diff(offsets)[text], sizes[item], keep[item])
        text, item = text[seed], item[seed]
        start, end = offsets[text] + start, offsets[text] + end
        likely = common_words(*known, words, start, end, item) >= keep[item] * sizes[item] - 1e-9
        text, item, start, end = text[likely], item[likely], start[likely], end[likely]
        score = align([lists[i] for i in item.tolist()], [words[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
        good = np.flatnonzero(score >= keep[item] - 1e-9)
        yield pa.RecordBatch.from_arrays([uids.take(pa.array(text[good])), pa.array(names[item[good]]), pa.array(score[good])], ["uid", "item", "score"])

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 512, 2 << 20):
            yield from scored(part.column(0), *words_of(strings(part.column(1))))

    return docs.select("uid", "text").mapInArrow(search, "uid long, item long, score double")


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(uid, item_id, score) of every pair of a row of docs (uid, text) and a test item whose alignment scores
    threshold or more, from 0.5, as a share of the item's own score, and at least LEAST_WORDS words' worth: an item
    with fewer words must be there whole. All such pairs are found, for items of SEEDED words or more.

    Items may be of any length: their words are kept once, and a passage of a very long one is aligned by itself.
    Items of one id and several texts count each; items without words match nothing."""
    if not threshold >= 0.5:
        raise ValueError("pairs of neighbouring words name all copies only from a threshold of 0.5")
    items, all_seeds = item_seeds(benchmark, threshold, item_id_col, item_text_col)
    seeds = stage(rare_seeds(docs, stage(all_seeds, "item-seeds")), "rare-seeds")
    blocks = max(1, -(-seeds.count() // BLOCK_GRAMS))
    found = None
    for k in range(blocks):
        mine = F.pmod(F.xxhash64("item"), F.lit(blocks)) == k  # about BLOCK_GRAMS seeds
        scored = _scores(docs, seeds.filter(mine).toArrow(), items.filter(mine).select("item", "words").dropDuplicates(["item"]).toArrow(), threshold)
        found = scored if found is None else found.unionByName(scored)
    return found.join(items.select("item", "item_id").distinct(), "item").select("uid", "item_id", "score")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.withColumn("uid", F.xxhash64(F.col(id_col), F.col(text_col)))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, contaminated, item_id, score, n_items) of every row: the item with the best score, ties
    to the smaller id, and how many items the text holds; null and 0 for clean rows.

    Null texts and texts without words are clean; items without words match nothing. Rows of one id and text
    share a result. Empty tables: every document is clean, or there are no rows. Other columns are ignored."""
    keyed = _keyed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    found = matches(keyed, benchmark, threshold).groupBy("uid").agg(F.max(F.struct("score", (-F.col("item_id")).alias("neg"))).alias("best"), F.countDistinct("item_id").alias("n"))
    joined = keyed.select("doc_id", "uid").join(found, "uid", "left")
    return joined.select("doc_id", F.col("best").isNotNull().alias("contaminated"), (-F.col("best.neg")).alias("item_id"), F.col("best.score").alias("score"), F.coalesce("n", F.lit(0)).alias("n_items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that hold a test item."""
    uid = F.xxhash64(F.col(id_col), F.col(text_col))
    keyed = docs.select(uid.alias("uid"), F.col(text_col).alias("text"))
    bad = stage(matches(keyed, benchmark, threshold).select("uid").distinct(), "contaminated")
    names = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    clean = docs.select(*names, uid.alias("uid")).join(bad, "uid", "left_anti")
    return clean.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
