"""Corpus pipeline: language, recurring lines, near duplicates, mixing, packing.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns what it keeps of ``docs``. All but the last return the
columns of ``documents``. Any column may be null, texts may be empty or very
long, rows may repeat and the table may be empty; extra columns are carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.llm import forest, langid, mixing, packing, templates
from cityflow.llm.common import materialise, table
from cityflow.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents the language model rejects: no text, no letter, or a score below its calibrated threshold."""
    found = langid.identify(docs, langid.train(docs))
    return found.where(~F.col("lang_rejected")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines of recurring templates; documents left without any text go, ``n_chars`` follows the text."""
    cleaned = templates.drop_recurring(docs)
    kept = cleaned.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    size = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", size).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest document id of each class of Jaccard-linked texts."""
    return forest.keep_one(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that a source weighs the root of its size, in a global random order."""
    return mixing.replicate(docs, mixing.target_rates(docs)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every remaining copy with their sequences."""
    return packing.op10_packing(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing_weights),
    ("packing", packed),
]

#: Language model, MinHash classes and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
