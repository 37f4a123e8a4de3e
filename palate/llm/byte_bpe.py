"""Byte-level BPE by a table of ranks: texts to ids, and ids back to bytes.

A text is cut into pre-tokens, each encoded by itself. Most pre-tokens are in the vocabulary as they are: a minimal
perfect hash gives each one its only possible id, and its bytes are compared. The others are merged byte by
byte, the pair of least rank first, with a heap over linked bytes. The work is done once per distinct pre-token
of a batch of texts; nothing is shuffled.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.llm.common import MIX_A, batches, gather, hash_strings, mix, strings

#: Merged pre-tokens that a task remembers between batches.
REMEMBERED = 1 << 18
#: Keys of a bucket of the perfect hash, on average; trials per step of its construction.
BUCKET, TRIALS = 4, 64
#: Chunks that are one pre-token: an optional space, then letters that every version of Unicode knows.
ONE_WORD = r"^ ?[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{17f}]+$"


class PerfectHash:
    """A minimal perfect hash: n different 64-bit keys to 0 .. n - 1, any other key to one of these.

    Keys fall into buckets, and a bucket's displacement is the first that sends its keys to free places; the largest
    buckets choose first, and those of one key are given the places that are left."""

    def __init__(self, keys: np.ndarray) -> None:
        self.n, self.buckets = len(keys), max(1, len(keys) // BUCKET)
        self.moves = np.zeros(self.buckets, np.int64)
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        free = np.ones(self.n, bool)
        for b in np.argsort(-sizes, kind="stable").tolist():
            if sizes[b] < 2:
                break
            own, first = keys[order[ends[b] - sizes[b] : ends[b]]], 0
            while True:
                tried = self._place(own, np.arange(first, first + TRIALS)[:, None])
                ranked = np.sort(tried, 1)
                good = free[tried].all(1) & (ranked[:, 1:] != ranked[:, :-1]).all(1)
                if good.any():
                    at = int(good.argmax())
                    self.moves[b], free[tried[at]] = first + at, False
                    break
                first += TRIALS
        alone = np.flatnonzero(sizes == 1)
        self.moves[alone] = -1 - np.flatnonzero(free)[: len(alone)]

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys ^ MIX_A) % np.uint64(self.buckets)).astype(np.int64)

    def _place(self, keys: np.ndarray, move: np.ndarray) -> np.ndarray:
        return (mix(keys + move.astype(np.uint64) * MIX_A) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        move = self.moves[self._bucket(keys)]
        return np.where(move < 0, -1 - move, self._place(keys, np.maximum(move, 0)))


def _ends(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of large strings."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def _as_strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """Large strings over the given bytes, which are not looked at."""
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


class Vocabulary:
    """Tokens by rank, the perfect hash over them, and the pattern that cuts texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, pattern
        tokens, self.ids = list(ranks), np.fromiter(ranks.values(), np.int64, len(ranks))
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"bytes {missing} have no rank")
        self.longest = max(map(len, tokens))
        self.ends = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        keys = hash_strings(_as_strings(self.ends, self.bytes))
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two tokens have one hash")
        self.hash = PerfectHash(keys)
        self.at = np.empty(len(keys), np.int64)
        self.at[self.hash.find(keys)] = np.arange(len(keys))
        self.of_id = np.full(int(self.ids.max()) + 1, -1)
        self.of_id[self.ids] = np.arange(len(tokens))

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as file:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}, pattern)

    def whole(self, words: pa.Array) -> np.ndarray:
        """The id of each word that is a token, -1 for the others."""
        offsets, data = _ends(words)
        lengths = np.diff(offsets)
        found = self.at[self.hash.find(hash_strings(words))]
        able = np.flatnonzero((lengths > 0) & (lengths == np.diff(self.ends)[found]))
        out = np.full(len(words), -1)
        if len(able):
            own, ends = gather(offsets, data, able)
            other, _ = gather(self.ends, self.bytes, found[able])
            same = np.add.reduceat(own != other, ends[:-1]) == 0
            out[able[same]] = self.ids[found[able[same]]]
        return out

    def merge(self, piece: bytes) -> list[int]:
        """The ids of a pre-token: of all neighbours the pair of least rank is merged, the leftmost of equal ones.

        Symbols are known by their first byte; `end` and `before` link them. An entry of the heap is a number made of the
        rank, the first byte and the end of a pair, and holds if the pair still stands as it was."""
        n, get, longest = len(piece), self.ranks.get, self.longest
        bits = n.bit_length()
        end, before, mask = list(range(1, n + 1)), list(range(-1, n - 1)), (1 << bits) - 1
        heap = [((rank << bits | i) << bits) + i + 2 for i in range(n - 1) if (rank := get(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i, stop = entry >> bits & mask, entry & mask
            middle = end[i]
            if middle <= i or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (far := end[stop]) - i <= longest and (rank := get(piece[i:far])) is not None:
                    heappush(heap, (rank << bits | i) << bits | far)
            if (left := before[i]) >= 0 and stop - left <= longest and (rank := get(piece[left:stop])) is not None:
                heappush(heap, (rank << bits | left) << bits | stop)
        out, i = [], 0
        while i < n:
            out.append(get(piece[i : end[i]]))
            i = end[i]
        return out


class Encoder:
    """Ids of many texts at once."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.known = vocabulary, {}
        self.cut = regex.compile(vocabulary.pattern).findall

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of distinct pre-tokens."""
        ids = self.vocabulary.whole(words)
        missed, known, merge = np.flatnonzero(ids < 0), self.known, self.vocabulary.merge
        lists = []
        for word in words.take(pa.array(missed)).to_pylist():
            if (found := known.get(word)) is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[word] = array("i", merge(word.encode())).tobytes()
            lists.append(found)
        counts = np.ones(len(words), np.int64)
        counts[missed] = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        ends = np.concatenate([[0], np.cumsum(counts)])
        whole = np.repeat(ids >= 0, counts)
        out = np.empty(ends[-1], np.int32)
        out[whole], out[~whole] = ids[ids >= 0], np.frombuffer(b"".join(lists), np.int32)
        return ends, out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of texts, large strings without nulls."""
        chunks, texts_at = space_chunks(texts)
        coded = chunks.dictionary_encode()
        codes, chunks = np.asarray(coded.indices), coded.dictionary
        single = np.asarray(pc.match_substring_regex(chunks, ONE_WORD))
        cut = [self.cut(c) for c in chunks.filter(pa.array(~single)).to_pylist()]
        counts = np.ones(len(chunks), np.int64)
        counts[~single] = np.fromiter(map(len, cut), np.int64, len(cut))
        ends = np.concatenate([[0], np.cumsum(counts)])
        words = pa.concat_arrays([chunks.filter(pa.array(single)), pa.array(chain.from_iterable(cut), pa.large_string())]).dictionary_encode()
        own = np.zeros(ends[-1], bool)
        own[ends[:-1][single]] = True
        word = np.empty(ends[-1], np.int64)
        word[own], word[~own] = np.split(np.asarray(words.indices), [int(single.sum())])
        word_ends, ids = self._words(words.dictionary)
        by_word, word_at = gather(word_ends, ids, word)
        by_chunk, chunk_at = gather(word_at[ends], by_word, codes)
        return chunk_at[texts_at], by_chunk


def space_chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut before spaces that begin a pre-token for sure, those before a character that is no white space, and
    the first chunk of each text (and one more, the end). A space at the end of a text, or before a
    byte that may begin other white space, is no cut; a chunk may hold any number of pre-tokens."""
    offsets, data = _ends(texts)
    begins = np.zeros(256, bool)
    begins[0x21:0x7F] = begins[0xC3:0xE1] = begins[0xE4:0xF5] = True
    cut, is_end = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    is_end[offsets] = True
    cut[: max(len(data) - 1, 0)] = (data[:-1] == 0x20) & begins[data[1:]] & ~is_end[1:-1]
    bounds = np.flatnonzero(cut | is_end)
    return _as_strings(bounds, data), np.searchsorted(bounds, offsets)


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row: `ids array<int>` as tiktoken's encode_ordinary gives them for these ranks and this
    pattern. Strings of special tokens are ordinary text.

    A null text counts as empty: no ids. Repeated rows are encoded each, an empty table gives no rows, other columns are not
    looked at. A text without a space is one chunk, and a pre-token may be as long as its text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for part in batches(parts, 4096, 8 << 20):
            ends, ids = encoder.encode(strings(part.column(1)))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """encoded (doc_id, ids) with `decoded`, the bytes of the ids. No ids, or null, give no bytes; an id that the
    vocabulary does not have is an error. Bytes need not be UTF-8 where ids were cut."""
    of_id, ends, data = vocabulary.of_id, vocabulary.ends, vocabulary.bytes

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 4096, 8 << 20):
            lists = pc.fill_null(part.column(1), pa.scalar([], part.column(1).type)) if part.column(1).null_count else part.column(1)
            ids, at = np.asarray(lists.flatten()), np.asarray(lists.offsets).astype(np.int64)
            known = (ids >= 0) & (ids < len(of_id))
            if not known.all() or (of_id[ids] < 0).any():
                raise ValueError("an id is not in the vocabulary")
            own, own_ends = gather(ends, data, of_id[ids])
            texts = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(own_ends[at - at[0]].astype(np.int64)), pa.py_buffer(own)])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts.cast(pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
