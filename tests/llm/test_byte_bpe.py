"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import rows
from llm_cases import TINY, no_docs, odd_docs, workers_find_the_package  # noqa: F401

from palate.llm import byte_bpe, queries
from palate.llm.common import tokenizer_file

PIECES = [" ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", " ", "a", "The", "é", "é", "'s", "'LL", "'ll", "1", "²", "१", ".", "!!", "中文", "\U0001f600", "<|endoftext|>", "_", "-"]


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary.read(tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def ids(vocabulary, texts: list[str]) -> list[list[int]]:
    ends, found = byte_bpe.Encoder(vocabulary).encode(pa.array(texts, pa.large_string()))
    return [found[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]


def test_all_characters(vocabulary, library):
    characters = (chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    texts = [f"a{c}b 1{c}2 {c} {c}x  {c}" for c in characters]
    for few in range(0, len(texts), 1 << 16):
        part = texts[few : few + (1 << 16)]
        assert ids(vocabulary, part) == [library.encode_ordinary(t) for t in part]


def test_random_texts(vocabulary, library):
    pick = random.Random(3)
    texts = ["".join(pick.choices(PIECES, k=pick.randint(0, 20))) for _ in range(30000)]
    assert ids(vocabulary, texts) == [library.encode_ordinary(t) for t in texts]


def test_long_pre_tokens(vocabulary, library):
    pick = random.Random(4)
    texts = ["a" * 100_000, "".join(pick.choices("abcde", k=100_000)), " " * 50_000 + "x", "漢字" * 20_000, "", "ab" * 3]
    assert ids(vocabulary, texts) == [library.encode_ordinary(t) for t in texts]


def test_forgetting_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 2)
    texts = [f"zqxj{i} wvkq{i % 5} zqxj{i // 2}" for i in range(200)]
    assert ids(vocabulary, texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 5000])
def test_the_hash_is_perfect_and_minimal(n):
    keys = np.random.default_rng(n).choice(1 << 62, n, replace=False).astype(np.uint64)
    made = byte_bpe.PerfectHash(keys)
    assert sorted(made.find(keys)) == list(range(n))
    others = made.find(keys + np.uint64(1))
    assert others.min() >= 0 and others.max() < n


def test_a_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError, match="rank"):
        byte_bpe.Vocabulary({b"a": 0}, ".")


def expected(library, doc_id, text) -> tuple:
    found = library.encode_ordinary(text or "")
    return doc_id, len(found), hashlib.sha256(",".join(map(str, found)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query(spark, library):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()
    assert rows(queries.op11_perfect_hash_bpe(spark, TINY)) == sorted((expected(library, *d) for d in docs), key=repr)


def test_odd_rows(spark, library, odd_docs, no_docs, monkeypatch):  # noqa: F811
    docs = odd_docs.select("doc_id", "text").collect()
    monkeypatch.setattr(queries, "_read", lambda *_: odd_docs)
    assert rows(queries.op11_perfect_hash_bpe(spark, "")) == sorted((expected(library, *d) for d in docs), key=repr)
    monkeypatch.setattr(queries, "_read", lambda *_: no_docs)
    assert rows(queries.op11_perfect_hash_bpe(spark, "")) == []


def test_ids_without_a_text(spark, vocabulary):
    frame = spark.createDataFrame([(1, [0, 1, 255]), (2, []), (3, None)], "doc_id long, ids array<int>")
    tokens = {rank: token for token, rank in vocabulary.ranks.items()}
    got = {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(frame, vocabulary).collect()}
    assert got == {1: tokens[0] + tokens[1] + tokens[255], 2: b"", 3: b""}
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>"), vocabulary).collect()
