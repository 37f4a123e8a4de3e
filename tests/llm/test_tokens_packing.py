"""Token counts and packing against the tokenizer libraries."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import *  # noqa: F403
from llm_cases import TINY
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from palate.llm import packing, queries, token_counts
from palate.llm.bpe import WordBpe
from palate.llm.common import KeyTable, batches, hash_strings, strings, tokenizer_file

WORDS, PIECES = tokenizer_file("word_bpe_49k.json"), tokenizer_file("piece_bpe_32k.model")
ODD = ["", "Hello World's it's A.B--c 12³ ½ don't", "<|endoftext|> x <|ENDOFTEXT|>", "Œuvre ﬁ 漢字 \x1c a", "a b é É ÀÖ×÷ªº µ _x_ 'S", "x" * 1000 + " y", "ÿ ß İ", "  lead\n\ttrail ", "a\x00b", "''s'sx 'll", "\xad \u0085x", "a  b\n\n c\r\nd", "▁x ▁▁", "<s> <0x0A>"]


def random_texts(n: int) -> list[str]:
    own = random.Random(3)
    letters = [chr(c) for c in [*range(32, 127), *range(161, 256), 10, 0x3B1, 0x4E2D]]
    return ["".join(own.choices(letters, k=30)) for _ in range(n)] + ["".join(own.choices("abth e'srnd\n", k=60)) for _ in range(n)]


def test_array_bpe_equals_the_library():
    bpe, library, texts = WordBpe(WORDS), Tokenizer.from_file(WORDS), ODD + random_texts(500)
    ends, ids = bpe.texts(pa.array(texts, pa.large_string()))
    for k, text in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("limit", [5, 1 << 18])
def test_array_bpe_remembers_what_it_has_merged(monkeypatch, limit):
    monkeypatch.setattr("palate.llm.bpe.REMEMBERED", limit)
    bpe, library, texts = WordBpe(WORDS), Tokenizer.from_file(WORDS), ODD + random_texts(300)
    merged, words = [], bpe.words
    monkeypatch.setattr(bpe, "words", lambda own: merged.append(len(own)) or words(own))
    for part in (texts[:100], texts[50:], texts[::-1], texts):
        ends, ids = bpe.texts(pa.array(part, pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [library.encode(x, add_special_tokens=False).ids for x in part]
    assert len(bpe.known) <= limit and (merged[-1] < merged[0] / 10) == (limit > 5)


def test_pre_token_counts_equal_the_library():
    counter, library = token_counts.PieceCounter(PIECES), SentencePieceProcessor(model_file=PIECES)
    for text in ODD + random_texts(500):
        words = counter.cut(text)
        assert sum(counter.count(words).tolist() if words else []) == len(library.encode(text)), repr(text)


def test_token_counts_of_odd_rows(spark, odd_docs, no_docs):
    library = SentencePieceProcessor(model_file=PIECES)
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in odd_docs.collect())
    got = token_counts.count_tokens(odd_docs, PIECES).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got) and any(r.over_limit for r in got)
    assert token_counts.count_tokens(no_docs, PIECES).collect() == []


def test_a_bucket_is_shared_by_tasks(spark, monkeypatch):
    """With one bucket, and less room than its lists take, its blocks go to several tasks, with the same counts."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet").repartition(16)
    want = sorted(map(tuple, token_counts.count_tokens(docs, PIECES).collect()))
    monkeypatch.setattr(token_counts, "GROUP_BYTES", 20_000)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        done = token_counts.count_tokens(docs, PIECES)
        text = done._jdf.queryExecution().toString()
        assert int(re.search(r"pmod\(xxhash64\(block#\d+L, 42\), (\d+)\)", text)[1]) > 4
        assert sorted(map(tuple, done.collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_token_count_query(spark):
    library = SentencePieceProcessor(model_file=PIECES)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    got = queries.op2_piece_counts(spark, TINY).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == {k: (len(t.encode()), len(library.encode(t))) for k, t in docs.items()}


def check_packed(pieces, ids_of) -> None:
    """Every id of every document in one piece, windows gapless, little padding."""
    by_doc, by_window = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_window.setdefault(p.sequence_id, []).append(p)
    for doc, own in by_doc.items():
        variants, at = ids_of[doc], 0
        copies = len(variants)
        for p in sorted(own, key=lambda p: p.start)[:: copies] if copies > 1 else sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(variants[0])
            assert p.ids_crc32 == zlib.crc32(np.array(variants[0][at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(variants[0])
    for own in by_window.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 4096


def test_packing_query(spark):
    library, ids = Tokenizer.from_file(WORDS), {}
    for r in spark.read.parquet(f"{TINY}/documents.parquet").collect():
        ids[r.doc_id] = [[*library.encode(r.text or "", add_special_tokens=False).ids, 2]]
    got = queries.op1_bm25_packing(spark, TINY).collect()
    assert set(ids) == {p.doc_id for p in got}
    check_packed(got, ids)
    total, windows = sum(p.length for p in got), len({p.sequence_id for p in got})
    assert windows == -(-total // 4096)  # one shard: only its last window is padded


def test_packing_of_odd_rows(spark, odd_docs, no_docs):
    got = packing.pack(odd_docs, WORDS).collect()
    library = Tokenizer.from_file(WORDS)
    want = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
    assert sum(p.length for p in got) == want
    assert {p.doc_id for p in got} == {None, *range(1, 9)}
    assert all(len(p.ids) == 4 * p.length for p in got)
    assert packing.pack(no_docs, WORDS).collect() == []


def test_neighbours_come_from_the_index():
    """A seed's window is filled with the pieces that share its rare terms, in order of likeness."""
    lists = [np.array(x, np.uint32) for x in ([1, 2, 3, 50], [7, 7, 7], [1, 9, 9], [1, 2, 3, 51], [8, 8, 8])]
    idf = np.ones(60)
    windows = list(packing.fill_windows(lists, idf, 3.4, 11))
    assert [p[0] for p in windows[0]] == [0, 3, 2]
    assert sorted(p for w in windows for p in w) == [(i, 0, len(x)) for i, x in enumerate(lists)]


def test_a_seed_asks_with_all_its_terms(monkeypatch):
    """The best neighbour shares only terms that are not among the seed's heaviest."""
    idf = np.append(np.full(50, 4.0), np.full(50, 1.0))
    seed, near, far = np.arange(80), np.arange(50, 80), np.append(np.arange(3), np.full(27, 99))
    lists = [x.astype(np.uint32) for x in (seed, far, near)]
    score = [sum(idf[t] for t in set(x.tolist()) & set(seed.tolist())) for x in (near, far)]
    assert score[0] > score[1]
    for entries in (1 << 20, 1):
        monkeypatch.setattr(packing, "ENTRIES", entries, raising=False)
        assert [[p[0] for p in w] for w in packing.fill_windows(lists, idf, 40, 140)] == [[0, 2, 1]]


def test_near_copies_share_a_window_at_every_number_of_shards(spark):
    """Each text has a copy with one more word; shards a 64th the size must not part them."""
    rows = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").filter("length(text) between 200 and 6000").orderBy("doc_id").limit(500).collect()
    pairs = [(2 * i + k, r.text + " word" * k) for i, r in enumerate(rows) for k in (0, 1)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)

    def together(shard_tokens: int) -> tuple[float, int]:
        windows = {}
        pieces = packing.pack(docs, WORDS, shard_tokens=shard_tokens).select("doc_id", "sequence_id").collect()
        for p in pieces:
            windows.setdefault(p.doc_id, set()).add(p.sequence_id)
        return sum(bool(windows[2 * i] & windows[2 * i + 1]) for i in range(len(rows))) / len(rows), len({p.sequence_id >> 32 for p in pieces})

    found = {size: together(size) for size in (1 << 21, 1 << 17, 1 << 15)}
    assert found[1 << 21][1] == 1 and found[1 << 15][1] > 12
    assert min(share for share, _ in found.values()) > 0.9, found


def test_many_copies_of_one_text_are_dealt_to_several_shards(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the very same words again and again in every copy', concat('text ', id, ' of ', hash(id))) as text")
    pieces = packing.pack(docs, WORDS, shard_tokens=4096).collect()
    sizes = Counter()
    for p in pieces:
        sizes[p.sequence_id >> 32] += p.length
    assert len(sizes) > 8 and max(sizes.values()) < 3 * 4096
    assert {p.doc_id for p in pieces} == set(range(3000))


def test_index_order_equals_bm25_by_hand():
    """Neighbours of every seed in the order of scores computed term by term."""
    own = np.random.default_rng(4)
    lists = [own.integers(0, 40, int(n)).astype(np.uint32) for n in own.integers(5, 30, 60)]
    idf, mean = own.random(40) + 0.1, float(np.mean([len(x) for x in lists]))

    def score(seed: np.ndarray, other: np.ndarray) -> float:
        counts = Counter(other.tolist())
        return sum(idf[t] * counts[t] * 2.2 / (counts[t] + 1.2 * (0.25 + 0.75 * len(other) / mean)) for t in set(seed.tolist()) if counts[t])

    first = next(packing.fill_windows(lists, idf, mean, sum(map(len, lists))))
    want = sorted(range(1, 60), key=lambda i: -score(lists[0], lists[i]))
    got = [i for i, *_ in first][1:]
    assert np.allclose([score(lists[0], lists[i]) for i in got if score(lists[0], lists[i]) > 0], [score(lists[0], lists[i]) for i in want if score(lists[0], lists[i]) > 0], rtol=1e-5)


def test_last_neighbour_is_cut_and_seeds_the_next_window():
    lists = [np.full(3, 5, np.uint32), np.full(3, 5, np.uint32)]
    windows = list(packing.fill_windows(lists, np.ones(6), 3, 4))
    assert windows == [[(0, 0, 3), (1, 0, 1)], [(1, 1, 3)]]


def test_helpers_on_parts_of_arrays():
    values = pa.array([f"word {i}" for i in range(100)])
    part = next(iter(list(batches(iter([pa.RecordBatch.from_arrays([values], ["a"])]), 40))[1:]))
    assert strings(part.column(0)).to_pylist() == values.to_pylist()[40:80]
    assert hash_strings(values.slice(40, 40)).tolist() == hash_strings(values)[40:80].tolist()
    long = pa.array(["a" * 9000, "a" * 9001, "a" * 8999 + "b", "", "a"])
    assert len(set(hash_strings(long).tolist())) == 5
    table = KeyTable(np.arange(5, 5000, 7).astype(np.uint64))
    assert table.find(np.array([5, 6, 12, 4996], np.uint64)).tolist() == [0, -1, 1, 713]


@pytest.mark.parametrize("text", [None, ""])
def test_empty_text_is_the_end_id_alone(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (piece,) = packing.pack(docs, WORDS).collect()
    assert (piece.start, piece.length, piece.doc_tokens, bytes(piece.ids)) == (0, 1, 1, b"\x02\0\0\0")
