"""The operators as queries over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from palate.llm import byte_bpe, conversations, decontamination, html_text, jaccard_join, langid, line_dedup, merkle, packing, sharding, sql, token_counts, vafile, warc
from palate.llm.common import package_path, tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    package_path(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = packing.pack(_read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return done.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op3_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(_read(spark, sf_dir, "embeddings"))


def op5_count_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_read(spark, sf_dir, "documents"), words=4, similarity=(85, 100))


def op6_boosted_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op7_minhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "text", "n_lines", "n_dropped")


def op8_rare_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_piece_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    done = langid.identify(docs, tokenizer_file("piece_bpe_32k.model"))
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    return done.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sharding.shard_documents(_read(spark, sf_dir, "documents"), n_shards=16)
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = warc.archive_and_read(_read(spark, sf_dir, "pages"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_perfect_hash_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = byte_bpe.Vocabulary.read(tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    done = byte_bpe.decode(byte_bpe.encode(_read(spark, sf_dir, "documents"), vocabulary), vocabulary)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_path_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged conversations, repaired; every conversation is listed, with zeros if no row of it is left."""
    rows = _read(spark, sf_dir, "conversations")
    report, repaired = conversations.repair(conversations.damage(rows))
    found = rows.select("conv_id").distinct()
    for part in (report, conversations.digests(repaired)):
        part = part.withColumnRenamed("conv_id", "_conv")
        found = found.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    counts = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_nested_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents (by a checksum of their id) have lost their line breaks since the manifest was made."""
    lost = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    made = merkle.with_proofs(_read(spark, sf_dir, "documents"), F.coalesce(lost, F.lit(False)), F.replace("text", F.lit("\n"), F.lit("")))
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return made.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest("path").alias("proof_sha256"), "folded_root", verified)


QUERIES: dict[str, Query] = {
    "op1_bm25_packing": op1_bm25_packing,
    "op2_piece_counts": op2_piece_counts,
    "op3_va_file": op3_va_file,
    "op4_virtual_slots": op4_virtual_slots,
    "op5_count_vector_join": op5_count_vector_join,
    "op6_boosted_dom": op6_boosted_dom,
    "op7_minhash_lines": op7_minhash_lines,
    "op8_rare_seeds": op8_rare_seeds,
    "op9_piece_unigrams": op9_piece_unigrams,
    "op10_warc": op10_warc,
    "op11_perfect_hash_bpe": op11_perfect_hash_bpe,
    "op12_path_ranking": op12_path_ranking,
    "op13_nested_intervals": op13_nested_intervals,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op12_path_ranking": sql.CONVERSATIONS,
    "op13_nested_intervals": sql.MERKLE,
    "op3_va_file": """
        WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                          CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
                   FROM u q JOIN u c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 10""",
    "op10_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
             d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
             w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top_id FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND top_id IS NOT NULL AND page_id IS DISTINCT FROM top_id
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top_id THEN top_id END AS refers_to
        FROM w""",
}
