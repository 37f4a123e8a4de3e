"""Ids of a word-level BPE (a tokenizers JSON file) for many texts at once.

Nearly every text is made of Latin-1 characters. For those the distinct words of a batch are merged
together, one step of every word at a time, in arrays, and remembered for later batches; all other texts, very long words and texts with the
strings of special tokens go to the tokenizers library itself.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from palate.llm.common import KeyTable, encode_lists, gather

#: Characters for which lower case, white space and composition are the same everywhere.
PLAIN = r"^[\t\n\r\x20-\x7e\x{a1}-\x{ff}]*$"
#: The file's fixed word pattern, for lower-case Latin-1.
LETTER, NUMBER = "a-zª-ªµºß-öø-ÿ", "0-9²³¹¼½¾"
WORD = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{LETTER}]+|[{NUMBER}]|[^\\s{LETTER}{NUMBER}]+")
LONGEST = 256
#: Strings between white space, of LONGEST bytes at most, whose ids are remembered.
REMEMBERED = 1 << 19


class WordBpe:
    """Token ids as `Tokenizer.from_file(path).encode(text, add_special_tokens=False)` gives them."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, pairs = spec["model"]["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        end = spec["model"]["end_of_word_suffix"]
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.special = [t["content"] for t in spec["added_tokens"]]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in printable)}
        self.inner = np.array([vocab[names[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[names[b] + end] for b in range(256)], np.int64)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.uint64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.table, self.none = KeyTable(keys), len(pairs)
        self.known, self.known_ends, self.known_ids = pa.array([], pa.large_string()), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = self.table.find((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64))
        return np.where(found < 0, self.none, found)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of words without white space, each of one byte at least."""
        words = words.cast(pa.large_string())
        if not len(words):
            return np.zeros(1, np.int64), np.zeros(0, np.int32)
        ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        symbol, owner = self.inner[data], np.repeat(np.arange(len(words)), np.diff(ends))
        symbol[ends[1:] - 1] = self.last[data[ends[1:] - 1]]
        rank = np.append(self._ranks(symbol[:-1], symbol[1:]), self.none)
        rank[ends[1:] - 1] = self.none
        done = []
        while len(owner):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best, lengths = np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(owner)))
            live = best < self.none
            alive = np.repeat(live, lengths)
            done.append((owner[~alive], symbol[~alive]))
            owner, symbol, rank, best = owner[alive], symbol[alive], rank[alive], best[live]
            if not len(owner):
                break
            hits = np.flatnonzero(rank == np.repeat(best, lengths[live]))
            at = hits[np.append(True, owner[hits[1:]] != owner[hits[:-1]])]
            symbol[at] = self.merged[best]
            keep = np.ones(len(owner), bool)
            keep[at + 1] = False
            owner, symbol, rank = owner[keep], symbol[keep], rank[keep]
            at = at - np.arange(len(at))
            for i in (at, at[(at > 0) & (owner[at - 1] == owner[at])] - 1):
                inside = np.append(owner, -1)[i + 1] == owner[i]
                rank[i] = np.where(inside, self._ranks(symbol[i], np.append(symbol, 0)[i + 1]), self.none)
        owner = np.concatenate([o for o, _ in done])
        order = np.argsort(owner, kind="stable")
        counts = np.bincount(owner, minlength=len(words))
        return np.concatenate([[0], np.cumsum(counts)]), np.concatenate([s for _, s in done])[order].astype(np.int32)

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of strings between white space, in lower case."""
        pure = pc.match_substring_regex(chunks, f"^[{LETTER}]+$")  # one word each
        cut = [WORD.findall(c) for c in chunks.filter(pc.invert(pure)).to_pylist()]
        pure = np.asarray(pure)
        counts = np.ones(len(chunks), np.int64)
        counts[~pure] = np.fromiter(map(len, cut), np.int64, len(cut))
        chunk_ends = np.concatenate([[0], np.cumsum(counts)])
        coded = pa.concat_arrays([chunks.filter(pa.array(pure)), pa.array(chain.from_iterable(cut), pa.large_string())]).dictionary_encode()
        first = np.zeros(chunk_ends[-1], bool)
        first[chunk_ends[:-1][pure]] = True
        word_codes = np.empty(chunk_ends[-1], np.int32)
        word_codes[first], word_codes[~first] = np.split(np.asarray(coded.indices), [int(pure.sum())])
        words = coded.dictionary
        long = np.flatnonzero(np.asarray(pc.greater(pc.binary_length(words), LONGEST)))
        ends, ids = self.words(pc.if_else(pc.greater(pc.binary_length(words), LONGEST), "a", words) if len(long) else words)
        if len(long):
            ends, ids = self._replace(ends, ids, {int(i): self.library.encode(words[int(i)].as_py(), add_special_tokens=False).ids for i in long})
        flat, flat_ends = gather(ends, ids, word_codes)
        return flat_ends[chunk_ends], flat

    def _remembered(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, ids, which list each of the chunks has); the first REMEMBERED chunks ever seen are looked up."""
        at = pc.index_in(chunks, value_set=self.known)
        new = np.asarray(at.is_null())
        fresh, n = chunks.filter(pa.array(new)), len(self.known)
        ends, ids = self._chunks(fresh)
        which = np.where(new, n + np.cumsum(new) - 1, np.asarray(at.fill_null(0))).astype(np.int64)
        all_ends, all_ids = np.concatenate([self.known_ends, ends[1:] + self.known_ends[-1]]), np.concatenate([self.known_ids, ids])
        kept = np.flatnonzero(np.asarray(pc.less_equal(pc.binary_length(fresh), LONGEST)))[: max(0, REMEMBERED - n)]
        if len(kept):
            more, more_ends = gather(ends, ids, kept)
            self.known = pa.concat_arrays([self.known, fresh.take(pa.array(kept))])
            self.known_ends, self.known_ids = np.concatenate([self.known_ends, more_ends[1:] + self.known_ends[-1]]), np.concatenate([self.known_ids, more])
        return all_ends, all_ids, which

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of texts without nulls."""
        plain = pc.match_substring_regex(texts, PLAIN)
        for token in self.special:
            plain = pc.and_not(plain, pc.match_substring(texts, token))
            plain = pc.and_not(plain, pc.match_substring(texts, token, ignore_case=True))
        offsets, codes, chunks = encode_lists(pc.utf8_split_whitespace(pc.utf8_lower(pc.if_else(plain, texts, ""))))
        ends, ids, which = self._remembered(chunks.cast(pa.large_string()))
        out, out_ends = gather(ends, ids, which[codes])
        out_ends = out_ends[offsets]
        odd = np.flatnonzero(~np.asarray(plain))
        if len(odd):
            out_ends, out = self._replace(out_ends, out, {int(i): self.library.encode(texts[int(i)].as_py(), add_special_tokens=False).ids for i in odd})
        return out_ends, out

    @staticmethod
    def _replace(ends: np.ndarray, ids: np.ndarray, new: dict[int, list[int]]) -> tuple[np.ndarray, np.ndarray]:
        parts, at, lengths = [], 0, np.diff(ends)
        for i, own in sorted(new.items()):
            parts += [ids[at : ends[i]], np.array(own, np.int32)]
            at, lengths[i] = ends[i + 1], len(own)
        return np.concatenate([[0], np.cumsum(lengths)]), np.concatenate([*parts, ids[at:]])


@lru_cache(maxsize=1)
def word_bpe(path: str) -> WordBpe:
    """The one of this Python worker, which remembers from task to task."""
    return WordBpe(path)
