"""The operators bound to the driver's tables: one query each, over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonnage.llm import decontamination, fingerprints, language, lines, packing, repeats, scoring, simhash, token_files, warc
from tonnage.llm.common import small_batches, table


def word_bpe() -> str:
    """Where the public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_hit words of each document lie in ten-word windows of benchmark items: :func:`decontamination.contamination`."""
    small_batches(spark)
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.drop("items", "spans")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 ids: :func:`packing.pack_documents`."""
    small_batches(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_bpe(), capacity=4096, end_id=1)


def op3_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of all documents, learned from four of five folds: :func:`scoring.scored`."""
    small_batches(spark)
    docs, block = scoring.file_blocks(table(spark, sf_dir, "documents"))
    return scoring.scored(docs, block=block, folds=5, fold=1)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without bytes that 100-byte strings repeat: :func:`repeats.without_repeats`."""
    small_batches(spark)
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), length=100)
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds: :func:`language.predicted`."""
    small_batches(spark)
    return language.predicted(table(spark, sf_dir, "documents"), folds=4, fold=2)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occur before: :func:`lines.without_repeated_runs`; a null text is kept empty."""
    small_batches(spark)
    found = lines.without_repeated_runs(table(spark, sf_dir, "documents"), run=2, long_words=20)
    return found.withColumn("kept_sha256", F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256)).drop("kept")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of documents and of edited ones, and their likeness: :func:`fingerprints.compared`."""
    small_batches(spark)
    return fingerprints.compared(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components within four bits: :func:`simhash.near_duplicates`."""
    small_batches(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as the archives give them back: :func:`warc.archived`."""
    small_batches(spark)
    return warc.archived(table(spark, sf_dir, "pages"), min_bytes=0)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and checksums of documents in the token files: :func:`token_files.token_file_index`."""
    small_batches(spark)
    return token_files.token_file_index(table(spark, sf_dir, "documents"), word_bpe(), end_id=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_benchmark_decontamination, op2_best_fit_packing, op3_ppm_scoring, op4_suffix_array_dedup, op5_language_id, op6_line_dedup, op7_document_fingerprints, op8_simhash_near_dedup, op9_warc_revisits, op10_token_files)
}

ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": decontamination.ORACLE,
    "op4_suffix_array_dedup": repeats.ORACLE,
    "op6_line_dedup": lines.ORACLE,
    "op9_warc_revisits": warc.ORACLE,
}
