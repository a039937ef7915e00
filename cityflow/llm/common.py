"""Helpers the operators share: shared storage, keys, folds."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.session import ensure_checkpoint_dir

#: Everything a text loses before exact comparison: space and 0x09-0x0D.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage: a lost executor re-reads files every node can see, and a
    value that several branches need is computed once.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reshuffled(key: Column) -> Column:
    """The same binary or string key as an expression the planner does not recognise.

    An aggregate's output is already partitioned on its key, so a join on
    that key gets an exchange on one side only and AQE cannot split a skewed
    partition of the other side. With this key both sides get their own
    exchange and a hot key is split.
    """
    return F.substring(key, 1, 1 << 20)


def row_key(id_col: str, text_col: str) -> Column:
    """Identity of a document row: its id with a hash of its text.

    Rows that repeat an id with another text stay apart; rows equal in both
    are handled alike everywhere, so they may share the key. Null ids and
    null texts have keys of their own.
    """
    return F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"),
                    F.hex(F.xxhash64(F.col(text_col).isNull(), F.col(text_col))))


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32(id as text) mod 4 is 2 (never learned from). Null ids are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))
