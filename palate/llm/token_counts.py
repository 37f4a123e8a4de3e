"""Token counts without token ids: pieces are counted once per distinct pre-token.

Texts are cut where the vocabulary can not merge: before white space and around line breaks. A block
of documents lists its pre-tokens with the documents that hold them. Lists meet by a hash of the
pre-token, where each distinct one is counted once and multiplied with its frequencies; what comes back to the
block is one sum per document and bucket.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.llm.common import batches, hash_strings, stage, strings

SPACE = "▁"
#: A pre-token that this share of a block's documents holds is dealt by its block too.
COMMON = 1 / 16
#: Packed bytes of a bucket that one task takes; a larger bucket is dealt by blocks.
GROUP_BYTES = 32 << 20
BLOCK = "block long, bucket int, words binary, word_sizes binary, n_docs binary, docs binary, freqs binary, ids array<long>, sizes array<long>"
_BLOCK_TYPES = [pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.list_(pa.int64())]
_BLOCK_NAMES = [x.split()[0] for x in BLOCK.split(", ")]


class PieceCounter:
    """Numbers of pieces of pre-tokens, by the sentencepiece library."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or "\n" in p for p in pieces) or self.library.encode("  a", out_type=str) != [SPACE * 2, SPACE + "a"]:
            raise ValueError("this vocabulary merges across white space, or its normaliser changes texts")
        self.pattern = re.compile(f"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+")
        self.base = len(self.library.encode("\n"))

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def count(self, words: list[str]) -> np.ndarray:
        """The library puts a space before every text, so a word that has one goes without it, and
        any other goes behind a line break, whose pieces are taken off."""
        texts = [w[1:] if w[0] == SPACE else "\n" + w for w in words]
        bare = np.fromiter((w == SPACE for w in words), bool, len(words))
        counts = np.fromiter(map(len, self.library.encode(texts, num_threads=1)), np.int64, len(words))
        counts -= self.base * np.fromiter((w[0] != SPACE for w in words), np.int64, len(words))
        counts[bare] = 1  # the library gives nothing for an empty text
        return counts


def squeeze(values: bytes | np.ndarray) -> bytes:
    return zstandard.compress(values if isinstance(values, bytes) else values.tobytes(), 3)


def spread(value: pa.Scalar) -> bytes:
    return zstandard.decompress(value.as_py())


def _blocks(docs: DataFrame, path: str, buckets: int) -> DataFrame:
    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(path)
        task = TaskContext.get().partitionId() << 32
        for number, part in enumerate(batches(parts, 8192, 16 << 20)):
            block = task | number
            texts = strings(part.column(1))
            lengths, found = [], []
            for few in range(0, len(texts), 256):  # Python strings of a few texts at a time
                lists = [counter.cut(t) for t in texts.slice(few, 256).to_pylist()]
                lengths += map(len, lists)
                found.append(pa.array(chain.from_iterable(lists), pa.large_string()))
            lengths = np.array(lengths, np.int64)
            coded = pa.concat_arrays(found).dictionary_encode()
            del found, lists
            words, n = coded.dictionary, len(lengths)
            held, freq = np.unique(np.asarray(coded.indices).astype(np.int64) * n + np.repeat(np.arange(n), lengths), return_counts=True)
            word, doc = np.divmod(held, n)
            held_by = np.bincount(word, minlength=len(words))
            bucket = hash_strings(words) + np.where(held_by > COMMON * n, hash_strings(pa.array([str(block)]))[0], np.uint64(0))
            bucket = (bucket % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            postings = np.argsort(bucket[word], kind="stable")  # by bucket, then in the words' order
            words, sizes = words.take(pa.array(order)), held_by[order]
            doc, freq = doc[postings].astype("<u2"), freq[postings].astype("<u4")
            firsts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            rows = []
            for k in np.flatnonzero(np.diff(firsts)).tolist():
                a, b = firsts[k], firsts[k + 1]
                own = words.slice(a, b - a)
                listed = "".join(own.to_pylist()).encode(), np.asarray(pc.utf8_length(own)).astype("<u4"), sizes[a:b].astype("<u4"), doc[ends[a] : ends[b]], freq[ends[a] : ends[b]]
                rows.append((block, k, *map(squeeze, listed), None, None))
            rows.append((block, None, None, None, None, None, None, part.column(0).to_pylist(), np.asarray(pc.binary_length(texts)).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _BLOCK_TYPES, strict=True)], _BLOCK_NAMES)

    return docs.mapInArrow(cut, BLOCK)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row: as many tokens as
    `SentencePieceProcessor.encode(text)` gives.

    A null text counts as empty, with no bytes and no tokens. Repeated rows are counted each.
    Empty tables give no rows; other columns are ignored. There are as many buckets as shuffle partitions; where they
    hold more than GROUP_BYTES, several tasks share one, a block going to one of them. A
    pre-token that many documents share is dealt to several buckets, by block; each task counts it once."""
    spark = docs.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    staged = stage(_blocks(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), model_path, buckets), "pre-tokens")

    def count(table: pa.Table) -> pa.Table:
        counter = PieceCounter(model_path)
        lists = []
        for words, ends in zip(table.column("words"), table.column("word_sizes"), strict=True):
            text, ends = spread(words).decode(), np.cumsum(np.frombuffer(spread(ends), "<u4"), dtype=np.int64).tolist()
            lists.append([text[a:b] for a, b in zip([0, *ends], ends, strict=False)])
        coded = pa.array(chain.from_iterable(lists), pa.large_string()).dictionary_encode()
        pieces = counter.count(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        out, at = [], 0
        for words, block, n_docs, docs_, freqs in zip(lists, *(table.column(c) for c in ("block", "n_docs", "docs", "freqs")), strict=True):
            own = pieces[at : at + len(words)]
            at += len(words)
            value = np.repeat(own, np.frombuffer(spread(n_docs), "<u4")) * np.frombuffer(spread(freqs), "<u4")
            doc, where = np.unique(np.frombuffer(spread(docs_), "<u2"), return_inverse=True)
            total = np.zeros(len(doc), np.int64)
            np.add.at(total, where, value)
            out.append((block.as_py(), squeeze(doc.astype("<u2")), squeeze(total.astype("<i8"))))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["block", "docs", "sums"])

    def add(table: pa.Table) -> pa.Table:
        rows = next(i for i, x in enumerate(table.column("ids")) if x.is_valid)
        ids, sizes = table.column("ids")[rows].values, table.column("sizes")[rows].values
        total = np.zeros(len(sizes), np.int64)
        for docs_, sums in zip(table.column("docs"), table.column("sums"), strict=True):
            if docs_.is_valid:
                total[np.frombuffer(spread(docs_), "<u2")] += np.frombuffer(spread(sums), "<i8")
        return pa.table([ids, sizes, pa.array(total), pa.array(total > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    lists = staged.filter("bucket is not null").select("block", "bucket", "words", "word_sizes", "n_docs", "docs", "freqs")
    size = lists.agg(F.sum(F.octet_length("words") + F.octet_length("docs") + F.octet_length("freqs"))).first()[0] or 0
    share = F.pmod(F.xxhash64("block"), F.lit(max(1, -(-size // (buckets * GROUP_BYTES)))))
    sums = lists.groupBy("bucket", share.alias("share")).applyInArrow(count, "block long, docs binary, sums binary")
    rows = staged.filter("bucket is null").select("block", F.lit(None).cast("binary").alias("docs"), F.lit(None).cast("binary").alias("sums"), "ids", "sizes")
    back = sums.select("*", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<long>").alias("sizes")).unionByName(rows)
    return back.groupBy("block").applyInArrow(add, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
