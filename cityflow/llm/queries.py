"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cityflow.llm import (alignment, embeddings, exact_mphf, fingerprints, forest, gam, langid, mixing, packing, ranking, templates, units,
                          warc)
from cityflow.llm.common import table


def tokenizer_path() -> str:
    """The public byte-level vocabulary used by default; operators take any path."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    """The public sentence-piece model aligned with it by default."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op1_warc(table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.op2_line_dedup(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op3_mixing(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.op4_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.op5_unit_dedup(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_mphf.op6_exact_dedup(table(spark, sf_dir, "documents"))


def op7_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.op7_embeddings(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op8_langid(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.op9_jaccard(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op10_packing(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.op11_alignment(table(spark, sf_dir, "documents"), tokenizer_path(), piece_model_path())


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.op12_fingerprints(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.op13_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc, op2_line_dedup, op3_mixing, op4_quality, op5_substring_dedup, op6_exact_dedup,
                            op7_embedding_near_dup, op8_language_id, op9_ngram_jaccard, op10_packing,
                            op11_alignment, op12_fingerprints, op13_ranked_search)}

#: SQL for the queries it can express; the others are tested against brute force, round trips or held-out accuracy.
ORACLE: dict[str, str] = {
    "op1_warc": warc.OP1_SQL, "op3_mixing": mixing.OP3_SQL,
    "op5_substring_dedup": units.OP5_SQL, "op6_exact_dedup": exact_mphf.OP6_SQL,
    "op7_embedding_near_dup": embeddings.OP7_SQL, "op9_ngram_jaccard": forest.OP9_SQL,
    "op13_ranked_search": ranking.OP13_SQL}
