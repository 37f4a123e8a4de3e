"""From raw documents to packed sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm import decontamination, jaccard_join, langid, line_dedup, packing
from palate.llm.common import package_path, stage, tokenizer_file
from palate.operators.staging import clear_staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _begin(spark: SparkSession, docs: DataFrame) -> None:
    """What stages before have staged is not needed once their result is written; docs tells if not."""
    package_path(spark)
    clear_staged(spark, keep=docs, label="llm-")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with that language in lang. Texts without a letter go."""
    _begin(spark, docs)
    done = langid.identify(docs.select(*COLUMNS), tokenizer_file("piece_bpe_32k.model"))
    return done.filter("lang_pred <> 'und'").withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those that keep no line go."""
    _begin(spark, docs)
    done = line_dedup.dedup_lines(docs.select(*COLUMNS)).filter("n_lines > n_dropped")
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id. Rows of one id with different texts are
    different documents, rows of one id and text are one. Rows without an id get one from their text, a negative one,
    for this stage."""
    _begin(spark, docs)
    order = F.coalesce("doc_id", -F.shiftrightunsigned(F.xxhash64("text"), 1) - 1)
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("key"))
    found = jaccard_join.near_duplicates(keyed, words=5, similarity=(80, 100), id_col="key")
    groups = found.select(F.col("doc_id").alias("key"), "component_id").distinct()
    firsts = keyed.select("key", order.alias("order")).join(groups, "key").groupBy("component_id").agg(F.min(F.struct("order", "key")).alias("first"))
    kept = stage(firsts.select("first.key"), "kept-documents")
    return keyed.join(kept, "key", "left_semi").dropDuplicates(["key"]).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    _begin(spark, docs)
    return decontamination.decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    _begin(spark, docs)
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("bm25_packing", pack),
]

#: SQL can express none of the stages on whole tables; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    package_path(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
