"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise import scratch
from tillwise.llm import (
    common, decisions, divergence, minhash, mixing, neighbours, oracle, orchard, packing, quotes, rotated_codes, secrets, toxicity,
    warc, windows)

Query = Callable[[SparkSession, str], DataFrame]


def op1_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply structure of all conversations, mailed with quotes of the turns before."""
    mail = quotes.mailbox(common.table(common.prepare(spark), sf_dir, "conversations"))
    return quotes.messages(mail, "conv_id", "turn", "role", "text")


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages."""
    return warc.derivatives(warc.responses(common.table(common.prepare(spark), sf_dir, "pages")))


def op3_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by their labelled neighbours' votes."""
    spark = common.prepare(spark)
    return neighbours.quality(common.table(spark, sf_dir, "documents"),
                              common.table(spark, sf_dir, "labels"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(common.table(common.prepare(spark), sf_dir, "documents"))


def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all documents and the learnt rules' verdict."""
    spark = common.prepare(spark)
    return decisions.judge(common.table(spark, sf_dir, "documents"),
                           common.table(spark, sf_dir, "labels"))


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, scanned through a ledger that begins empty."""
    spark = common.prepare(spark)
    return secrets.secret_scan(common.table(spark, sf_dir, "documents"),
                               scratch.new_folder(spark, "ledger"))


def op7_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest neighbours of every vector whose id is divisible by 100, among all vectors."""
    return rotated_codes.search(common.table(common.prepare(spark), sf_dir, "embeddings"),
                                F.col("vec_id") % 100 == 0)


def op8_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from voters."""
    spark = common.prepare(spark)
    return toxicity.toxicity(common.table(spark, sf_dir, "documents"),
                             common.table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document for the mix of all sources."""
    return mixing.mix(common.table(common.prepare(spark), sf_dir, "documents")).drop("key")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised and packed."""
    import public_tokenizers

    return packing.pack(common.table(common.prepare(spark), sf_dir, "documents"),
                        public_tokenizers.path(packing.TOKENIZER))


def op11_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, their errors and the digest of the codebooks."""
    return orchard.compress(common.table(common.prepare(spark), sf_dir, "embeddings"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised and put into windows by best fit."""
    import public_tokenizers

    return windows.pack(common.table(common.prepare(spark), sf_dir, "documents"),
                        public_tokenizers.path(windows.TOKENIZER))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, and by which terms."""
    return divergence.audit(common.table(common.prepare(spark), sf_dir, "documents"))


ALL: tuple[Query, ...] = (
    op1_quotes, op2_warc_derivatives, op3_neighbour_quality, op4_minhash, op5_decision_list, op6_secret_ledger, op7_rotated_codes,
    op8_weak_toxicity, op9_mixing, op10_packing, op11_orchard_codes, op12_best_fit, op13_source_divergence)
# SQL for those that SQL can express.
SQL: dict[str, str] = oracle.STATEMENTS
