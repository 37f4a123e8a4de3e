"""Line dedup, similarity join, decontamination and the pipeline against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import *  # noqa: F403
from llm_cases import TINY

import __spark_entry__ as entry_point
import corpus_pipeline
from palate.llm import decontamination, jaccard_join, line_dedup, queries
from palate.llm.common import components



class Union:
    def __init__(self, items) -> None:
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y) -> None:
        self.up[self.find(y)] = self.find(x)


def shingles(text: str | None, words: int) -> frozenset:
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(found[k : k + words]) for k in range(max(1, len(found) - words + 1))) if found else frozenset()


def join_by_hand(docs: list[tuple], words: int, p: int, q: int) -> set[tuple]:
    sets = {i: shingles(t, words) for i, t in docs}
    union = Union(sets)
    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if q * both >= p * (len(sets[i]) + len(sets[j]) - both):
                union.join(j, i)
    least = {}
    for i in sets:
        least[union.find(i)] = min(i, least.get(union.find(i), i))
    return {(i, len(sets[i]), least[union.find(i)]) for i in sets}


def edited(own: random.Random, words: list[str], n: int) -> list[str]:
    out = list(words)
    for _ in range(n):
        at = own.randrange(len(out))
        out[at : at + own.choice([0, 1, 1])] = [f"new{own.randrange(10**6)}"]
    return out


def family_docs() -> list[tuple[int, str]]:
    """Families of copies with few to many edits, of short to long texts, that share passages."""
    own = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    common = own.choices(vocabulary, k=60)
    docs = []
    for size in (3, 4, 5, 6, 7, 8, 9, 11, 14, 20, 40, 90, 250, 700):
        base = own.choices(vocabulary, k=size)
        for copy in range(16):
            words = edited(own, base, own.choice([0, 0, 1, 1, 2, max(1, size // 60), max(1, size // 30)]))
            if copy % 5 == 4:
                words += common
            docs.append((len(docs), " ".join(words)))
    own.shuffle(docs)
    return [(i, t) for i, (_, t) in enumerate(docs)]


@pytest.mark.parametrize(("words", "p", "q"), [(4, 85, 100), (5, 80, 100), (1, 90, 100)])
def test_join_equals_brute_force(spark, words, p, q):
    docs = family_docs()
    want = join_by_hand(docs, words, p, q)
    assert len({c for *_, c in want}) < len(docs) - 40  # there is something to find
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert set(map(tuple, jaccard_join.near_duplicates(table, words, (p, q)).collect())) == want


def test_join_with_small_blocks(spark, monkeypatch):
    """Leaves cut in pieces and visitors dealt to several tasks give the same links."""
    monkeypatch.setattr(jaccard_join, "LEAF_BYTES", 1)
    monkeypatch.setattr(jaccard_join, "VISITORS", 3)
    own = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join(edited(own, base, own.randrange(4)))) for i in range(150)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert set(map(tuple, jaccard_join.near_duplicates(table, 4, (85, 100)).collect())) == join_by_hand(docs, 4, 85, 100)


def passage_docs() -> list[tuple[int, str]]:
    """Unlike documents of several sizes with one passage in common, so that they share boxes; three of them have a near copy."""
    own = random.Random(8)
    passage = [f"p{i}" for i in range(90)]
    docs = [passage + [f"w{own.randrange(10**6)}" for _ in range(size)] for size in (200, 210, 330, 1500) for _ in range(25)]
    docs += [edited(own, docs[i], 3) for i in (3, 40, 90)]
    return [(i, " ".join(words)) for i, words in enumerate(docs)]


def test_unlike_sets_of_a_leaf_are_not_shuffled(spark, monkeypatch):
    """Only sets that may link are named for the step that makes and shuffles them."""
    named, real = [], jaccard_join.hash_filter
    monkeypatch.setattr(jaccard_join, "hash_filter", lambda hashes, name: named.append(hashes.count()) or real(hashes, name))
    docs = passage_docs()
    want = join_by_hand(docs, 5, 80, 100)
    assert len({c for *_, c in want}) == len(docs) - 3
    assert set(map(tuple, jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect())) == want
    assert len(named) == 1 and 6 <= named[0] <= 12


def test_bitmaps_leave_every_link():
    """What may link by its bitmap holds all sets that do, over sizes with bitmaps of several widths."""
    sets = sorted((np.sort(x) for x in map(np.unique, jaccard_join.shingle_sets(pa.array([t for _, t in family_docs() + passage_docs()], pa.large_string()), 3)) if len(x)), key=len)
    sizes = np.array([len(x) for x in sets])
    starts, flat = line_dedup.bitmaps(np.append(0, np.cumsum(sizes)), np.concatenate(sets))
    maps = line_dedup.Bitmaps(pa.array([flat[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary()), sizes, 0.8)
    own = np.random.default_rng(3).random(len(sets)) < 0.6
    linked = set()
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if (own[i] or own[j]) and 100 * both >= 80 * (sizes[i] + sizes[j] - both):
                linked |= {i, j}
    stay = set(np.flatnonzero(jaccard_join.partnered(maps, own, 80, 100)).tolist())
    assert linked <= stay and len(linked) > 50 and len(stay) < len(sets) - 50


def test_join_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()]
    assert set(map(tuple, queries.op5_count_vector_join(spark, TINY).collect())) == join_by_hand(docs, 4, 85, 100)


def test_join_of_odd_rows(spark, odd_docs, no_docs):
    got = sorted(((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(odd_docs).collect()), key=repr)
    by_id = {i: (n, c) for i, n, c in got}
    assert len(got) == 10 and by_id[2] == (0, 2) and by_id[3] == (0, 3) and by_id[4] == (0, 4)
    assert by_id[5][1] == by_id[6][1] == 5 and by_id[1][1] == 1 and by_id[-1][1] is None and by_id[8] == (1, 8)
    assert jaccard_join.near_duplicates(no_docs).collect() == []


def test_linked_sets_share_a_box():
    own = np.random.default_rng(2)
    for _ in range(300):
        n = int(own.integers(6, 400))
        a = np.unique(own.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        swap = int(own.integers(0, max(1, len(a) * 3 // 34) + 1))
        b = np.unique(np.concatenate([a[swap:], own.integers(0, 2**63, swap).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
            assert len(np.intersect1d(jaccard_join.box_keys(a, 85, 100), jaccard_join.box_keys(b, 85, 100)))


def test_sets_of_two_sizes_share_a_box():
    """Sets of which one holds the other, just at the threshold, and few shingles."""
    own = np.random.default_rng(4)
    for n in [*range(4, 60), *range(60, 900, 17)]:
        b = np.unique(own.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        for k in range(1, len(b) // 5 + 1, max(1, n // 40)):
            a = np.delete(b, own.choice(len(b), k, replace=False))
            assert 5 * len(a) >= 4 * len(b) and len(np.intersect1d(jaccard_join.box_keys(a, 80, 100), jaccard_join.box_keys(b, 80, 100)))


def test_boxes_of_a_shared_passage_are_few():
    """Boxes with the fewest shingles, which unlike sets share most often, are not named."""
    own = np.random.default_rng(5)
    fresh = lambda n: own.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
    passage, shared = fresh(30), []
    for _ in range(60):
        a, b = (np.unique(np.concatenate([passage, fresh(270)])) for _ in range(2))
        shared.append(len(np.intersect1d(jaccard_join.box_keys(a, 80, 100), jaccard_join.box_keys(b, 80, 100))))
    assert np.mean(shared) < 0.2


def test_components(spark):
    own = random.Random(4)
    edges = [(own.randrange(60), own.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)] + [(7, 7)]
    union = Union({x for e in edges for x in e})
    for a, b in edges:
        union.join(a, b)
    least = {}
    for x in union.up:
        least[union.find(x)] = min(x, least.get(union.find(x), x))
    want = {(x, least[union.find(x)]) for x in union.up if least[union.find(x)] != x}
    frame = spark.createDataFrame(edges, "a long, b long")
    assert set(map(tuple, components(frame, "t").collect())) == want
    assert components(frame.limit(0), "t").collect() == []


def lines_by_hand(docs: list[tuple], similarity: float = 0.8) -> dict:
    """id -> kept text."""
    normal = lambda x: " ".join(x.lower().split())
    grams = lambda x: frozenset(x[i : i + 5] for i in range(max(1, len(x) - 4)))
    lines = sorted({normal(x) for _, t in docs if t for x in t.split("\n") if x.strip()})
    sets, union = {x: grams(x) for x in lines}, Union(lines)
    for k, x in enumerate(lines):
        for y in lines[:k]:
            if min(len(sets[x]), len(sets[y])) >= similarity * max(len(sets[x]), len(sets[y])):
                both = len(sets[x] & sets[y])
                if both >= similarity * (len(sets[x]) + len(sets[y]) - both):
                    union.join(y, x)
    seen, out = set(), {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        kept = []
        for x in (text or "").split("\n"):
            root = union.find(normal(x)) if x.strip() else None
            if root is None or root not in seen:
                kept.append(x)
            seen.add(root)
        out[i] = None if text is None else "\n".join(kept)
    return out


def test_line_dedup_equals_brute_force(spark):
    own = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bdkl" for b in "aeiou" for c in "nrst"]
    lines = [" ".join(own.choices(words, k=own.choice([1, 2, 6, 12, 40]))) for _ in range(40)]
    docs = []
    for i in range(120):
        text = []
        for _ in range(own.randrange(5)):
            line = list(own.choice(lines))
            for _ in range(own.choice([0, 0, 0, 1, 2])):
                line[own.randrange(len(line))] = own.choice("xyzXY ")
            text.append("".join(line))
        docs.append((i, "\n".join(text)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(table).collect()}
    want = lines_by_hand(docs)
    # banding is built to find 99 % of the pairs at the threshold and more above
    assert set(got) == set(want) and sum(got[i] != want[i] for i in want) <= 2


def linked_in_buckets(lines: list[str], similarity: float = 0.8) -> int:
    """How many components the lines have when all pairs of each bucket are compared."""
    sets = [frozenset(x[i : i + 5] for i in range(max(1, len(x) - 4))) for x in lines]
    union, buckets = Union(range(len(lines))), {}
    for i, keys in enumerate(line_dedup.band_keys(pa.array(lines, pa.large_string())).tolist()):
        for key in keys:
            buckets.setdefault(key, []).append(i)
    for own in buckets.values():
        for k, i in enumerate(own):
            for j in own[:k]:
                both = len(sets[i] & sets[j])
                if both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                    union.join(i, j)
    return len({union.find(i) for i in range(len(lines))})


def template_lines() -> list[str]:
    """Variants of templates, and short lines, whose buckets hold lines that are not like the first one."""
    own = random.Random(12)
    words = [f"{a}{b}{c}{d}" for a in "bdkl" for b in "aeiou" for c in "nrst" for d in "aeiou"]
    lines = set()
    for _ in range(6):
        base = own.choices(words, k=14)
        for _ in range(80):
            line = list(base)
            line[own.randrange(14)] = own.choice(words)
            line[own.randrange(14)] = own.choice(words)
            lines.add(" ".join(line))
    for k in range(300):
        lines.add(f"page {k} of {own.randrange(300)}")
    return sorted(lines)


@pytest.mark.parametrize("block", [4096, 16])
def test_line_dedup_compares_all_lines_of_a_bucket(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", block, raising=False)
    lines = template_lines()
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = sum(r.n_lines - r.n_dropped for r in line_dedup.dedup_lines(table).collect())
    assert kept == linked_in_buckets(lines)


def test_bitmaps_rule_out_no_similar_pair():
    own = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdkl" for b in "aeiou" for c in "nrst"]
    lines = ["x", "abcd", "aa " * 2000, "aa " * 2000 + "b", "ab" * 900]
    for _ in range(40):
        base = own.choices(words, k=own.choice([1, 3, 12, 60, 400]))
        for _ in range(4):
            line = list(base)
            for _ in range(own.randrange(len(base) // 6 + 1)):
                line[own.randrange(len(line))] = own.choice(words)
            lines.append(" ".join(line))
    arrow = pa.array(lines, pa.large_string())
    _, sizes, maps = line_dedup.signs(arrow)
    a, b = np.triu_indices(len(lines), 1)
    may = line_dedup.Bitmaps(maps, sizes, 0.8).may_link(a, b)
    sets = [frozenset(x[i : i + 5] for i in range(max(1, len(x) - 4))) for x in lines]
    both = np.array([len(sets[i] & sets[j]) for i, j in zip(a, b, strict=True)])
    near = both >= 0.8 * (np.array([len(sets[i] | sets[j]) for i, j in zip(a, b, strict=True)]))
    assert near.sum() > 100 and not (near & ~may).any() and may.sum() < 2 * near.sum()
    ends, hashes = line_dedup.shingles(arrow)
    for at in range(0, len(a), line_dedup.SORTED):
        part = slice(at, at + line_dedup.SORTED)
        assert (line_dedup.similar_pairs(ends, hashes, a[part], b[part], 0.8) == near[part]).all()


def test_lines_unlike_their_buckets_leave_them(spark):
    """Short lines share buckets without being alike; only those with a partner are read again."""
    lines = template_lines()
    lone = [f"{x} zzz" for x in ("page one of nine", "page two of nine", "page six of nine", "page ten of nine")]
    table = spark.createDataFrame(list(enumerate(lines + lone)), "doc_id long, text string").selectExpr("xxhash64(doc_id, text) uid", "doc_id", "text")
    found = line_dedup._lines_of(table).cache()
    buckets = line_dedup._buckets(found, len(lines) + len(lone))
    want = {}
    for i, keys in enumerate(line_dedup.band_keys(pa.array(lines + lone, pa.large_string())).tolist()):
        for key in keys:
            want.setdefault(key, set()).add(i)
    want = {frozenset(x) for x in want.values() if len(x) > 1}
    assert buckets.select("bucket").distinct().count() == len(want) and buckets.count() == sum(map(len, want))
    entries = line_dedup._entries(found, len(lines) + len(lone), 0.8)
    assert 0 < entries.count() < buckets.count()


def test_line_dedup_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.text for r in queries.op7_minhash_lines(spark, TINY).collect()}
    want = lines_by_hand(docs)
    assert set(got) == set(want) and sum(got[i] != want[i] for i in want) <= 1


def test_line_dedup_of_odd_rows(spark, odd_docs, no_docs):
    got = sorted(((r.doc_id or -1, r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(odd_docs).collect()), key=repr)
    by_id = {r[0]: r[1:] for r in got}
    assert len(got) == 10 and by_id[2] == (None, 0, 0) and by_id[4] == (" \n\t ", 0, 0)
    assert by_id[5][1:] == (1, 0) and by_id[6] == ("", 1, 1) and by_id[8] == ("x", 1, 0)
    assert by_id[1][1:] == (2, 0)  # equal rows keep the same lines
    done = line_dedup.dedup_lines(odd_docs)
    assert {c for c in odd_docs.columns if c not in ("n_lines",)} <= set(done.columns)
    assert line_dedup.dedup_lines(no_docs).collect() == []


ITEM = "the quick brown fox jumps over the lazy dog while seven small birds sing above a quiet river near the old stone mill"


def test_decontamination_finds_copies_and_leaves_others(spark):
    own = random.Random(3)
    vocabulary = [f"v{i}" for i in range(300)] + ITEM.split()
    noise = lambda n: " ".join(own.choices(vocabulary, k=n))
    words = ITEM.split()
    edited_ = [w if k % 5 else "changed" for k, w in enumerate(words)]
    gapped = [w for k, w in enumerate(words) if k % 6] + ["end"]
    added = [x for k, w in enumerate(words) for x in ([w, "extra"] if k % 5 == 4 else [w])]
    rows = [(0, noise(80)), (1, f"{noise(50)} {ITEM} {noise(50)}"), (2, f"{noise(30)}\n{ITEM.upper()}!"), (3, " ".join(edited_)), (4, f"{noise(9)} {' '.join(gapped)}"), (5, " ".join(added)), (6, " ".join(words[:6]) + " " + noise(60)), (7, None), (8, ""), (9, f"{ITEM} {noise(20)} short one"), (None, ITEM), (10, "12 !!")]
    rows += [(100 + i, noise(120)) for i in range(60)]
    docs = spark.createDataFrame([(*r, 1, 1) for r in rows], "doc_id long, text string, score int, item_id int")
    bench = spark.createDataFrame([(7, ITEM, 0), (7, ITEM, 0), (8, None, 0), (9, "...", 0), (10, "short one", 0), (11, "wholly different words that no document of this table holds", 0), (None, "nothing here either", 0)], "item_id long, text string, uid int")
    got = {r.doc_id: r for r in decontamination.contaminated(docs, bench).collect()}
    assert {i for i, r in got.items() if r.contaminated} == {1, 2, 3, 4, 5, 9, None}
    assert got[1].item_id == 7 and got[1].score == 1.0 and got[9].n_items == 2 and got[0].n_items == 0 and got[0].score is None
    assert 0.5 <= got[3].score < 1
    clean = decontamination.decontaminate(docs, bench)
    assert {r.doc_id for r in clean.collect()} == set(got) - {1, 2, 3, 4, 5, 9, None} and clean.columns == docs.columns
    assert not any(r.contaminated for r in decontamination.contaminated(docs, bench.limit(0)).collect())
    assert decontamination.contaminated(docs.limit(0), bench).collect() == []


def test_decontamination_finds_many_copies_of_a_part(spark, monkeypatch):
    """Edited copies that share only those n-grams of the item that most documents hold."""
    own = random.Random(14)
    words = ITEM.split()
    edited_ = lambda: " ".join(w if k % 5 else f"n{own.randrange(10**9)}" for k, w in enumerate(words))
    noise = lambda n: " ".join(own.choices([f"v{i}" for i in range(300)] + words, k=n))
    rows = [(0, ITEM)] + [(1 + i, f"{noise(20)} {edited_()} {noise(20)}") for i in range(40)]
    rows += [(100 + i, f"{noise(40)} {' '.join(words[1:5])} {noise(40)}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, ITEM), (8, "an item no document has")], "item_id long, text string")
    want = sorted(i for i, _ in rows if i < 100)
    got = sorted(map(tuple, decontamination.contaminated(docs, bench).collect()))
    assert [r[0] for r in got if r[1]] == want
    assert sorted(r.doc_id for r in decontamination.decontaminate(docs, bench).collect()) == [100 + i for i in range(40)]
    monkeypatch.setattr(decontamination, "HITS", 50, raising=False)
    assert sorted(map(tuple, decontamination.contaminated(docs, bench).collect())) == got


def test_blocks_of_test_items_give_the_same(spark, monkeypatch):
    want = sorted(map(tuple, queries.op8_rare_seeds(spark, TINY).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_GRAMS", 400)
    assert sorted(map(tuple, queries.op8_rare_seeds(spark, TINY).collect())) == want


def every_pair(docs: list[tuple], items: list[tuple], keep: float = 0.5) -> set[tuple]:
    """(doc_id, item_id) by aligning every document with every item, whole texts, no seeds."""
    cut = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    names = {}
    code = lambda t: np.array([names.setdefault(w, len(names)) for w in cut(t)], np.uint64)
    found = set()
    for item_id, text in items:
        item = code(text)
        if len(item) < 3:
            continue
        scores = decontamination.align([item] * len(docs), [code(t) for _, t in docs])
        need = max(keep, min(1, decontamination.LEAST_WORDS / len(item)))
        found |= {(d, item_id) for (d, _), score in zip(docs, scores, strict=True) if score >= need - 1e-9}
    return found


def edited_copies(own: random.Random, words: list[str]) -> list[str]:
    """Copies about as bad as still count: words changed, lost or added at regular and at random places."""
    new = lambda: f"n{own.randrange(10**9)}"
    out = [" ".join(w if k % step != shift else new() for k, w in enumerate(words)) for step in (3, 4, 5) for shift in range(2)]
    out.append(" ".join(x for w in words for x in (w, new())))  # a word added behind each
    out.append(" ".join(w for k, w in enumerate(words) if k % 3))
    for _ in range(40):
        share = own.choice([0.2, 0.3, 0.35, 0.4])
        kinds = own.choices(["same", "change", "lose", "add"], [1 - share, share / 3, share / 3, share / 3], k=len(words))
        out.append(" ".join(x for w, kind in zip(words, kinds, strict=True) for x in {"same": [w], "change": [new()], "lose": [], "add": [w, new()]}[kind]))
    return out


def test_decontamination_equals_aligning_everything(spark):
    """Recall and precision of 1 for the stated threshold, on edited copies inside texts that use the items' words."""
    own = random.Random(21)
    common = [f"c{i}" for i in range(12)]
    texts = [" ".join(own.choices(common + [f"r{i}" for i in range(200)], k=n)) for n in (3, 5, 7, 12, 13, 30, 30, 31, 60)]
    items = [*enumerate(texts, 1), (20, ITEM)]
    noise = lambda n: " ".join(own.choices(common + [f"r{i}" for i in range(200)], k=n))
    copies = [c for _, text in items for c in edited_copies(own, text.split())]
    docs = [(i, f"{noise(own.randrange(30))} {c} {noise(own.randrange(30))}") for i, c in enumerate(copies)]
    frame = spark.createDataFrame(docs, "uid long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.uid, r.item_id) for r in decontamination.matches(frame, bench).collect()}
    want = every_pair(docs, items)
    assert got == want and len({d for d, _ in want}) > 150 and len(want) < len(docs) * 2


def test_decontamination_equals_aligning_everything_on_the_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").select("item_id", "text").collect()]
    want = {d for d, _ in every_pair(docs, items)}
    assert {r.doc_id for r in queries.op8_rare_seeds(spark, TINY).collect() if r.contaminated} == want


def test_every_third_word_replaced(spark):
    words = [f"w{i}" for i in range(30)]
    copy = " ".join(w if k % 3 else f"x{k}" for k, w in enumerate(words))
    docs = spark.createDataFrame([(1, copy), (2, " ".join(words[:4]))], "doc_id long, text string")
    got = decontamination.contaminated(docs, spark.createDataFrame([(5, " ".join(words))], "item_id long, text string")).collect()
    assert {r.doc_id: r.contaminated for r in got} == {1: True, 2: False}


def test_a_very_long_item(spark):
    own = random.Random(2)
    words = [f"w{own.randrange(3000)}" for _ in range(20_000)]
    changed = [w if k % 9 else "other" for k, w in enumerate(words)]
    docs = spark.createDataFrame([(1, "before " + " ".join(changed)), (2, " ".join(words[:4000])), (3, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(words)), (6, "a short and wholly different item of words")], "item_id long, text string")
    got = {r.doc_id: r.item_id for r in decontamination.contaminated(docs, bench).collect()}
    assert got == {1: 5, 2: None, 3: None}


def test_seeds_are_the_rarest_places(spark):
    docs = spark.createDataFrame([(i, "of the old stone mill and more of the same") for i in range(50)], "uid long, text string")
    bench = spark.createDataFrame([(1, "of the quick brown fox of the old stone mill and more")], "item_id long, text string")
    _, seeds = decontamination.item_seeds(bench, 0.5, "item_id", "text")
    kept = {r.place for r in decontamination.rare_seeds(docs, seeds).collect()}
    assert len(kept) == decontamination.needed_places(12, 0.5) == 7 and {1, 2, 3, 4} <= kept
    with pytest.raises(ValueError, match="0.5"):
        decontamination.matches(docs, bench, threshold=0.3)


def align_by_hand(item: list, passage: list) -> float:
    h, best = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)], 0
    for i, x in enumerate(item, 1):
        for j, y in enumerate(passage, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best / (2 * len(item))


def test_alignment_equals_the_table_by_hand():
    own = np.random.default_rng(8)
    items = [own.integers(0, 6, int(n)).astype(np.uint64) for n in own.integers(1, 30, 80)]
    passages = [own.integers(0, 6, int(n)).astype(np.uint64) for n in own.integers(1, 60, 80)]
    got = decontamination.align(items, passages)
    assert np.allclose(got, [align_by_hand(i.tolist(), p.tolist()) for i, p in zip(items, passages, strict=True)])


def test_exact_holders_are_found(spark):
    normal = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    docs = {r.doc_id: normal(r.text) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    items = [normal(r.text) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    want = {i for i, t in docs.items() if any(x in t for x in items)}
    assert want and {r.doc_id for r in queries.op8_rare_seeds(spark, TINY).collect() if r.contaminated} == want


def test_pipeline_stages_by_hand(spark):
    """Each stage on what the one before kept."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    lang = corpus_pipeline.language_id(spark, docs, TINY)
    kept = {r.doc_id: r.text for r in lang.collect()}
    assert lang.columns == corpus_pipeline.COLUMNS and set(kept) == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text)}
    lines = corpus_pipeline.dedup_lines(spark, lang, TINY)
    after = {r.doc_id: r for r in lines.collect()}
    want = {i: t for i, t in lines_by_hand(sorted(kept.items())).items() if t.strip()}
    assert set(after) == set(want) and sum(after[i].text != want[i] for i in want) <= 1
    assert all(r.n_chars == len(r.text) for r in after.values())
    single = corpus_pipeline.near_duplicates(spark, lines, TINY)
    first = {i for i, _, c in join_by_hand([(i, r.text) for i, r in after.items()], 5, 80, 100) if i == c}
    assert {r.doc_id for r in single.collect()} == first
    clean = corpus_pipeline.decontaminate(spark, single, TINY)
    left = {r.doc_id for r in clean.collect()}
    packed = corpus_pipeline.pack(spark, clean, TINY).select("doc_id", "doc_tokens").distinct().collect()
    assert {r.doc_id for r in packed} == left
    # run() frees what was staged before
    whole = corpus_pipeline.run(spark, TINY).select("doc_id", "doc_tokens").distinct().collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed))


def test_pipeline_keeps_texts_that_share_an_id(spark):
    clean, near = "one text of its own words that nothing else in this table holds", " ".join(f"w{i}" for i in range(60))
    rows = [(1, clean), (1, near), (1, "an other text under the same id which is not like the first"), (2, near + " end"), (4, near), (4, near)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, TINY).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(rows[:3])


def test_pipeline_of_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, TINY)
    # 5 and 6 are equal and 1 is there twice; texts without letters go
    assert {r.doc_id for r in docs.collect()} == {1, 5, 8, None}
    docs = no_docs
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, TINY)
    assert docs.collect() == []


def test_all_queries_are_registered():
    names = set(entry_point.queries())
    assert {f"op{n}" for n in range(1, 11)} == {m[0] for x in names if (m := re.match(r"op\d+", x))} and "pipeline" in names


def test_shingles_of_parts_of_arrays():
    texts = pa.array([f"a{i} b c d a{i}" for i in range(50)])
    whole = jaccard_join.shingle_sets(texts.cast(pa.large_string()), 4)
    assert all(len(s) == 2 for s in whole)
