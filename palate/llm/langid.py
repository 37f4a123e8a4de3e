"""Language of a text by unigrams of pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary. Each language has a probability for every
piece, estimated on a bounded sample of labelled texts. A word's probability is the sum over all
ways to cut it into pieces, by the forward algorithm; a text's is the product over its words. Every
distinct word of a batch is scored once, all words of one length together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.llm.common import MIX_A, KeyTable, batches, encode_lists, mix, strings

SPACE = "▁"
#: About so many labelled texts of each language are learned from.
SAMPLE_TEXTS = 2000
#: The weight of the pieces' frequency in all languages, and of an even share.
SMOOTHING = 0.01
#: The probability of a character that the vocabulary lacks.
UNKNOWN = 1e-7
#: Forward sums are scaled after so many characters.
SCALE_EVERY = 12


def letter_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Lower-case runs of letters: (offsets of the texts, codes, distinct words)."""
    return encode_lists(pc.utf8_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL]+", " ")))


def training_rows(docs: DataFrame, held_out: str, sample_texts: int = SAMPLE_TEXTS, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """About sample_texts distinct texts (text, lang) of each language whose rows are not held out, by
    a hash. Rows without text or language are left out, and repeated texts count once."""
    rows = docs.filter(F.coalesce(~F.expr(held_out), F.lit(True)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"))
    sizes = rows.groupBy("lang").count().collect()  # a row per language, as many as the model has columns
    share = F.lit(0.0)
    for row in sizes:
        share = F.when(F.col("lang") == row["lang"], F.lit(sample_texts / row["count"] * 2.0**32)).otherwise(share)
    return rows.filter(F.pmod("h", F.lit(1 << 32)) < share).select("text", "lang").distinct()


class PieceUnigrams:
    """ln P(word) in each language."""

    def __init__(self, pieces: list[str], probability: np.ndarray) -> None:
        self.longest = max(map(len, pieces), default=1)
        powers = np.ones(1 << 12, np.uint64)
        powers[1:] = np.uint64(0x100000001B3)
        self.powers = np.cumprod(powers, dtype=np.uint64)
        inverse = pow(0x100000001B3, -1, 1 << 64)
        powers[1:] = np.uint64(inverse)
        self.inverse = np.cumprod(powers, dtype=np.uint64)
        self.table = KeyTable(np.array([self._hash(p) for p in pieces], np.uint64))
        n_langs = probability.shape[1]
        self.p = np.vstack([probability, np.full((1, n_langs), UNKNOWN), np.zeros((1, n_langs))])
        self.unknown, self.nothing = len(pieces), len(pieces) + 1

    def _hash(self, piece: str) -> int:
        codes = np.frombuffer(piece.encode("utf-32-le"), "<u4").astype(np.uint64)
        return int((mix(codes + MIX_A) * self.powers[: len(codes)]).sum(dtype=np.uint64)) ^ len(codes)

    def score(self, words: pa.Array) -> np.ndarray:
        """One row per word; words need one character at least."""
        texts = pc.binary_join_element_wise(pa.scalar(SPACE, pa.large_string()), words.cast(pa.large_string()), pa.scalar("", pa.large_string()))
        lengths = np.asarray(pc.utf8_length(texts)).astype(np.int64)
        out = np.zeros((len(texts), self.p.shape[1]))
        for n in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == n)
            step = max(1, 400_000 // n)
            for a in range(0, len(rows), step):
                own = rows[a : a + step]
                codes = np.frombuffer("".join(texts.take(pa.array(own)).to_pylist()).encode("utf-32-le"), "<u4")
                out[own] = self._forward(codes.reshape(len(own), n).astype(np.uint64))
        return out

    def _forward(self, codes: np.ndarray) -> np.ndarray:
        m, n = codes.shape
        values = mix(codes + MIX_A)
        langs = self.p.shape[1]
        ring = [np.ones((m, langs))]  # sums up to the last positions, newest last
        logs = np.zeros((m, langs))
        reach = min(self.longest, n)
        width = len(self.powers) - reach
        for first in range(0, n, width):  # very long words: in stretches that the powers cover
            base = max(0, first - reach)
            stretch = values[:, base : first + width]
            sums = np.concatenate([np.zeros((m, 1), np.uint64), np.cumsum(stretch * self.powers[: stretch.shape[1]], axis=1, dtype=np.uint64)], axis=1)
            found = []
            for size in range(1, reach + 1):
                if stretch.shape[1] < size:
                    break
                keys = (sums[:, size:] - sums[:, :-size]) * self.inverse[: stretch.shape[1] - size + 1] ^ np.uint64(size)
                at = self.table.find(keys)
                found.append(np.where(at < 0, self.unknown if size == 1 else self.nothing, at))
            for end in range(first + 1, min(n, first + width) + 1):
                now = ring[-1] * self.p[found[0][:, end - 1 - base]]
                for size in range(2, min(end, len(found)) + 1):
                    now += ring[-size] * self.p[found[size - 1][:, end - size - base]]
                ring.append(now)
                if len(ring) > reach:
                    del ring[0]
                if end % SCALE_EVERY == 0:
                    scale = now.copy()
                    ring = [x / scale for x in ring]
                    logs += np.log(scale)
        return logs + np.log(ring[-1])


def train(rows: DataFrame, vocabulary_path: str) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """(languages, pieces, probabilities, ln of the languages' shares) from rows (text, lang).

    Each text is cut into pieces by the vocabulary's own library; counts are added up by Spark.
    What reaches the driver is at most one number per piece and language."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=vocabulary_path)
        totals: dict[str, np.ndarray] = {}
        for part in batches(parts):
            texts = pc.replace_substring_regex(pc.utf8_lower(strings(part.column(0))), r"[^\pL]+", " ")
            for ids, lang in zip(library.encode(texts.to_pylist(), num_threads=1), part.column(1).to_pylist(), strict=True):
                total = totals.setdefault(lang, np.zeros(library.get_piece_size() + 1, np.int64))
                total += np.bincount(ids, minlength=len(total)) if ids else 0
                total[-1] += 1
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])], ["lang", "piece", "n"])

    from sentencepiece import SentencePieceProcessor

    counts = rows.mapInArrow(count, "lang string, piece long, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    library = SentencePieceProcessor(model_file=vocabulary_path)
    size = library.get_piece_size()
    langs = sorted(counts["lang"].unique())
    table = np.zeros((size + 1, len(langs)))
    table[counts["piece"].to_numpy(np.int64), [langs.index(x) for x in counts["lang"]]] = counts["n"]
    texts, table = table[-1], table[:-1]
    usable = np.array([not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i)) for i in range(size)])
    pieces = [library.id_to_piece(i) for i in np.flatnonzero(usable).tolist()]
    table = table[usable]
    share = table / np.maximum(table.sum(axis=0), 1)
    even = table.sum(axis=1, keepdims=True) / max(table.sum(), 1)
    p = (1 - 2 * SMOOTHING) * share + SMOOTHING * even + SMOOTHING / len(pieces)
    return langs, pieces, p, np.log(np.maximum(texts, 1) / max(texts.sum(), 1))


def identify(docs: DataFrame, vocabulary_path: str, held_out: str = "pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2", sample_texts: int = SAMPLE_TEXTS, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """docs with lang_pred and score, the winner's probability. Languages are learned from labelled
    rows for which the SQL condition held_out is not true.

    A null text, one without a letter, and every text where nothing could be learned get `und` and
    0. Ties go to the first language in order. Columns of docs named lang_pred or score are replaced.
    Words of any length are scored whole."""
    spark = docs.sparkSession
    langs, pieces, p, shares = train(training_rows(docs, held_out, sample_texts, text_col, lang_col, id_col), vocabulary_path)
    model = spark.sparkContext.broadcast((pieces, p))
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*rest).schema.add("lang_pred", "string").add("score", "double")
    at = rest.index(text_col)

    def label(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigrams = PieceUnigrams(*model.value) if langs else None
        for part in batches(parts, 4096, 12 << 20):
            offsets, codes, words = letter_words(strings(part.column(at)))
            n_words = np.diff(offsets)
            pred, score = np.full(part.num_rows, "und", object), np.zeros(part.num_rows)
            some = np.flatnonzero(n_words)
            if langs and len(some):
                each = unigrams.score(words)
                total = np.stack([np.add.reduceat(each[:, k][codes], offsets[some]) for k in range(len(langs))], axis=1) + shares
                best = total.argmax(axis=1)
                pred[some] = np.array(langs, object)[best]
                score[some] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred, pa.string()), pa.array(score)], [*rest, "lang_pred", "score"])

    return docs.select(*rest).mapInArrow(label, schema)
