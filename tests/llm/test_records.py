"""Sharding, archives, pages, vectors and languages against plain Python."""

from __future__ import annotations

import gzip
import hashlib
import html
import os
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import *  # noqa: F403
from llm_cases import TESTDATA, TINY

from palate.llm import html_text, langid, queries, sharding, vafile, warc
from palate.llm.common import stage, tokenizer_file

PIECES = tokenizer_file("piece_bpe_32k.model")


def test_sharding_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    got = queries.op4_virtual_slots(spark, TINY).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in docs.items()}
    shards = {s: sorted(r.slot for r in got if r.shard == s) for s in range(16)}
    assert all(v == list(range(len(v))) for v in shards.values())
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_shards_hold_equal_bytes_and_grow_into_new_ones(spark):
    docs = spark.read.parquet(str(TESTDATA / "sf0.01" / "documents.parquet"))
    slotted = stage(sharding.with_slots(docs), "t")
    weights = stage(sharding.slot_weights(slotted), "t")
    first = stage(sharding.new_map(weights, 4), "t")
    size = {r.virtual_slot: r.bytes for r in weights.collect()}
    old = {r.virtual_slot: r.shard for r in first.collect()}
    assert len(old) == sharding.N_SLOTS
    load = Counter()
    for slot, shard in old.items():
        load[shard] += size[slot]
    assert max(load.values()) - min(load.values()) <= max(size.values())
    # the same greedy rule, by hand
    by_hand, mine = [0] * 4, {}
    for slot in sorted(size, key=lambda s: (-size[s], s)):
        mine[slot] = by_hand.index(min(by_hand))
        by_hand[mine[slot]] += size[slot]
    assert mine == old
    grown = sharding.grow_map(first, weights, 5).collect()
    assert {r.version for r in grown} == {1} and {r.virtual_slot for r in grown} == set(old)
    assert all(r.shard in (old[r.virtual_slot], 4) for r in grown)
    load = Counter()
    for r in grown:
        load[r.shard] += size[r.virtual_slot]
    assert min(load.values()) > 0.95 * sum(load.values()) / 5


def test_maps_are_kept_in_versions(spark, tmp_path):
    docs, path = spark.read.parquet(f"{TINY}/documents.parquet"), str(tmp_path / "map")
    weights = sharding.slot_weights(sharding.with_slots(docs))
    sharding.save_map(sharding.new_map(weights, 4), path, 0)
    first = {r.doc_id: r.shard for r in sharding.shard_documents(docs, slot_map=sharding.load_map(spark, path)).collect()}
    assert first == {r.doc_id: r.shard for r in sharding.shard_documents(docs, n_shards=4).collect()}
    grown = sharding.rebalance(spark, path, docs, 5)
    then = {r.doc_id: r.shard for r in sharding.shard_documents(docs, slot_map=grown).collect()}
    moved = {d for d in first if first[d] != then[d]}
    assert moved and {then[d] for d in moved} == {4}
    again = {r.doc_id: r.shard for r in sharding.shard_documents(docs, slot_map=sharding.load_map(spark, path, 0)).collect()}
    assert again == first and sharding.load_map(spark, path).first()["version"] == 1
    with pytest.raises(Exception, match="(?i)exists"):
        sharding.save_map(grown, path, 1)
    with pytest.raises(ValueError, match="no version 7"):
        sharding.load_map(spark, path, 7)


def test_sharding_of_odd_rows(spark, odd_docs, no_docs):
    got = sharding.shard_documents(odd_docs, 3).collect()
    assert len(got) == odd_docs.count() and sorted(r.size for r in got)[:2] == [1, 1]
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard_documents(no_docs, 3).collect() == []


def test_sharding_runs_no_python(spark, odd_docs):
    text = sharding.shard_documents(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


PAGES = "page_id long, url string, html string, digest string, is_revisit int"


def odd_pages(spark):
    big = "<p>é</p>" * 300
    rows = [(1, "http://a/ü?x=1\r\nX: y", big), (2, None, big), (3, "u", big), (3, "u", big), (4, "u", None), (5, "u", ""), (6, "u", "small"), (7, "u", "small"), (None, "u", big + "!"), (None, None, None), (8, "u", "\r\n\r\nWARC/1.1\r\n\x1f")]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)


def test_archives_of_odd_pages(spark):
    got = warc.archive_and_read(odd_pages(spark)).collect()
    want = Counter()
    big = "<p>é</p>" * 300
    for page_id, text, kind, to in [(1, big, "revisit", 3), (2, big, "revisit", 3), (3, big, "response", None), (3, big, "response", None), (4, "", "response", None), (5, "", "response", None), (6, "small", "response", None), (7, "small", "response", None), (None, big + "!", "response", None), (None, "", "response", None), (8, "\r\n\r\nWARC/1.1\r\n\x1f", "response", None)]:
        want[page_id, len(text.encode()), hashlib.sha1(text.encode()).hexdigest(), kind, to] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert {r.page_id: r.url for r in got}[1] == "http://a/ü?x=1\r\nX: y"
    assert warc.archive_and_read(odd_pages(spark).limit(0)).collect() == []


def sample_records(n: int) -> list[bytes]:
    texts = [f"<p>{i}</p>" * 100 for i in range(n)]
    return [warc.record(i, f"http://x/{i}", t, hashlib.sha1(t.encode()).digest(), None, False, "2024-01-01T00:00:00Z") for i, t in enumerate(texts)]


@pytest.mark.parametrize("compressed", [False, True])
@pytest.mark.parametrize("harm", ["flip", "cut", "garbage", "header", "tail"])
def test_salvage_recovers_all_other_records(compressed, harm):
    parts = [gzip.compress(r, mtime=0) if compressed else r for r in sample_records(8)]
    start = len(parts[0]) + len(parts[1])
    lost = {2}
    if harm == "flip":
        middle = bytearray(parts[2])
        middle[len(middle) // 2] ^= 0x55
        parts[2] = bytes(middle)
    elif harm == "cut":
        parts[2] = parts[2][: len(parts[2]) // 2]
    elif harm == "garbage":
        parts.insert(2, b"\x1f\x8b\x08 not a member, WARC/1.1 nor a record\r\n")
        lost = set()
    elif harm == "header":
        parts[2] = b"X" + parts[2][1:]
    else:
        parts[-1], lost, start = parts[-1][:-40], {7}, sum(map(len, parts[:-1]))
    data = b"".join(parts)
    found = list(warc.salvage("f", data))
    assert [r["page_id"] for r in found if r["kind"] == "record"] == [i for i in range(8) if i not in lost]
    gaps = [r for r in found if r["kind"] == "gap"]
    assert gaps and gaps[0]["at"] == start and all(g["reason"] for g in gaps)
    assert sum(r["length"] for r in found) == len(data)


@pytest.mark.parametrize(("harm", "whole"), [("header", [0, 1, 3, 4, 5, 6, 7]), ("tail", list(range(7))), ("half", [0, 1, 2, 3]), ("flip", [0, 1, 2]), ("none", list(range(8)))])
def test_salvage_inside_one_member(harm, whole):
    """Eight records in one gzip member; the damage lies in the unpacked or in the packed bytes."""
    texts = [f"<p>{os.urandom(3000).hex()}</p>" for _ in range(8)]
    records = [warc.record(i, f"http://x/{i}", t, hashlib.sha1(t.encode()).digest(), None, False, "2024-01-01T00:00:00Z") for i, t in enumerate(texts)]
    plain = b"".join(records)
    if harm == "header":
        at = len(records[0]) + len(records[1]) + records[2].index(b"Content-Length") + len(b"Content-Length")
        plain = plain[:at] + b"X" + plain[at + 1 :]
    data = gzip.compress(plain, mtime=0)
    if harm == "tail":
        data = data[:-10]
    elif harm == "half":
        data = data[: int(len(data) * 0.55)]
    elif harm == "flip":
        middle = int(len(data) * 0.45)
        data = data[:middle] + bytes(b ^ 0xFF for b in data[middle : middle + 40]) + data[middle + 40 :]
    found = list(warc.salvage("f", data + gzip.compress(sample_records(1)[0])))
    got = [r["page_id"] for r in found if r["kind"] == "record"]
    assert got[-1] == 0 and got[:-1][: len(whole)] == whole and len(got) - 1 <= len(whole) + (harm == "tail")
    gaps = [r for r in found if r["kind"] == "gap"]
    assert bool(gaps) == (harm != "none") and all(g["reason"] for g in gaps)
    if harm == "header":
        assert [(g["inner_at"], g["inner_length"]) for g in gaps] == [(len(records[0]) + len(records[1]), len(records[2]))]


def test_reader_takes_plain_and_damaged_files(spark, tmp_path):
    records = sample_records(3)
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(records[0]) + b"junk" + gzip.compress(records[1]))
    (tmp_path / "c.warc").write_bytes(b"")
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert Counter(r.kind for r in got) == {"record": 5, "gap": 1}
    assert [(r.length, bytes(r.payload) if r.payload else None) for r in got if r.kind == "gap"] == [(4, None)]


def plain_article(source: str) -> str:
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", source, re.S)
    blocks = re.split(r"</?(?:p|h1)>", body[1]) if body else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", " ", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_extraction_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{TINY}/pages.parquet").collect()}
    got = queries.op6_boosted_dom(spark, TINY).collect()
    assert {r.page_id: r.text for r in got} == {k: plain_article(v) for k, v in pages.items()}
    assert all(r.n_chars == len(r.text) for r in got)


def test_extraction_without_landmarks_and_of_odd_pages(spark):
    train = spark.read.parquet(f"{TINY}/pages.parquet").select("page_id", "html")
    long = "Some long text without any class names at all, which is dense, and has commas, words and full stops. It should be kept. "
    bare = f"<body><div><ul><li><a href=a>One</a><li><a>Two</a><li><a>Three</a></ul></div><div><p>{long}</p><p>{long}&amp; so on</p></div><div>&copy; 2024 Foo</div></body>"
    noted = f"<article><h1>T</h1><p>{long}</p><aside><p>{long}</p></aside></article><div class='reader-comments'><p>{long}</p></div>"
    rows = [(-1, None), (-2, ""), (-3, bare), (-4, noted), (-5, "<p>x<script>bad</script"), (None, "<div" + "<div>" * 3000 + "x"), (-3, bare)]
    pages = train.unionByName(spark.createDataFrame(rows, "page_id long, html string")).selectExpr("*", "'clash' AS text", "'u' AS url")
    got = [r for r in html_text.extract(pages).collect() if r.page_id is None or r.page_id < 0]
    text = {r.page_id: r.text for r in got}
    assert len(got) == 7 and text[-1] == text[-2] == ""
    assert text[-3] == f"{long.strip()}\n{long}& so on"
    assert "bad" not in text[-5] and text[-4].split("\n")[-1] == long.strip() and text[-4].count(long.strip()) == 1
    assert html_text.extract(pages.limit(0)).collect() == []


def test_broken_pages_take_time_in_proportion():
    """Tags that close nothing, and elements that are never closed."""
    began = time.perf_counter()
    deep = html_text.parse("<div>x</section>" * 70_000)
    assert len(deep.tag) == 140_001 and time.perf_counter() - began < 5
    began = time.perf_counter()
    html_text.parse("<p><table>" + "<ul><div>x" * 40_000)
    assert time.perf_counter() - began < 5


def test_digits_of_whole_blocks_count():
    page = html_text.parse("<p>" + "a" * 500 + "7" * 2500 + "</p>")
    shares = html_text.features(page)[:, html_text.FEATURES.index("digits")]
    assert np.isclose(shares[page.tag.index("#text")], 2500 / 3000, atol=0.01)


def test_decoding_keeps_ancestors():
    page = html_text.parse("<div><nav><p>a</p></nav><p>b</p></div>")
    own = np.random.default_rng(1)
    for _ in range(50):
        picked = html_text.decode(page, own.normal(size=len(page.tag)))
        assert all(picked[page.parent[i]] for i in np.flatnonzero(picked) if i)


def test_vectors_against_brute_force(spark):
    rows = [r for r in spark.read.parquet(f"{TINY}/embeddings.parquet").collect()]
    ids, x = np.array([r.vec_id for r in rows]), np.floor(np.array([r.embedding for r in rows], float) * 1024).astype(int)
    got = sorted(map(tuple, queries.op3_va_file(spark, TINY).select("query_id", "rank", "vec_id", "score").collect()))
    want = []
    for q in ids[ids % 100 == 0].tolist():
        scores = x @ x[ids == q][0]
        best = sorted((-int(s), int(i)) for s, i in zip(scores, ids, strict=True) if i != q)[:10]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (None, [9.0, 9.0]), (8, [3e38, 3e38]), (9, []), (100, [])]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in vafile.top_k(vectors).collect())
    one = 1024 * 1024 * 5
    assert got == [(0, 1, 8, 2**63 - 1), (0, 2, 1, one), (0, 3, 2, one), (0, 4, 2, one), (100, 1, 9, 0)]
    assert vafile.top_k(vectors.limit(0)).collect() == []


def test_languages(spark):
    got = queries.op9_piece_unigrams(spark, str(TESTDATA / "sf0.01")).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(str(TESTDATA / "sf0.01" / "documents.parquet")).collect()}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_rows(spark, odd_docs, no_docs):
    got = {r.doc_id: r for r in langid.identify(odd_docs, PIECES, held_out="false").collect()}
    assert len(got) == 9 and got[2].lang_pred == got[3].lang_pred == got[4].lang_pred == got[7].lang_pred == "und"
    assert got[5].lang_pred == "la" and got[7].score == 0
    assert langid.identify(no_docs, PIECES).collect() == []


def test_forward_sums_all_segmentations():
    import itertools

    import pyarrow as pa

    pieces, p = ["▁", "a", "b", "ab", "▁a", "ba", "aba"], np.array([[0.1, 0.3], [0.2, 0.1], [0.1, 0.1], [0.2, 0.2], [0.1, 0.1], [0.1, 0.1], [0.2, 0.1]])
    model = langid.PieceUnigrams(pieces, p)

    def by_hand(word: str, k: int) -> float:
        total = 0.0
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            parts, at = [], 0
            for i, c in enumerate((*cuts, 1), 1):
                if c:
                    parts.append(word[at:i])
                    at = i
            total += np.prod([p[pieces.index(x), k] if x in pieces else (langid.UNKNOWN if len(x) == 1 else 0) for x in parts])
        return float(np.log(total))

    words = ["a", "ab", "abab", "babaab", "axb", "abababababababa"]
    got = model.score(pa.array(words))
    assert np.allclose(got, [[by_hand("▁" + w, k) for k in (0, 1)] for w in words])
    assert np.isfinite(model.score(pa.array(["ab" * 6000]))).all()
