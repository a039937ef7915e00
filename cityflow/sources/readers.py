"""Readers: merged parquet scans, table/folder scans with origin, documents.

Readers are lazy: filters and column selections applied later reach the scan
(parquet predicate pushdown and column pruning) through Catalyst.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .merging import merged


def scan_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet") -> DataFrame:
    """A folder (``fmt`` reader) or a catalog table name (no '/' in it)."""
    if "/" not in path_or_name and spark.catalog.tableExists(path_or_name):
        return spark.table(path_or_name)
    return spark.read.format(fmt).load(path_or_name)


def scan_merged(spark: SparkSession, paths, schema_map: dict | None = None, fmt: str = "parquet", tag=None) -> DataFrame:
    """All files under ``paths`` with the union of their columns.

    Without ``schema_map`` missing columns are null, and columns whose types
    differ between files get the narrowest type that holds all of them (see
    ``merging``; whole numbers and floats meet as double). With
    ``schema_map={path: {col: type}}`` each family is read and cast on its
    own, then unioned by name. ``tag`` is applied to every scan before the
    union (e.g. to keep scan metadata).
    """
    tag = tag or (lambda df: df)
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not schema_map:
        return merged(spark, paths, fmt, tag)
    parts = []
    for p in paths:
        df = tag(spark.read.format(fmt).load(p))
        casts = schema_map.get(p, {})
        if casts:
            df = df.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})
        parts.append(df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_many(spark: SparkSession, root: str, fmt: str = "parquet", origin_col: str = "origin",
              schema=None, partitions=()) -> DataFrame:
    """Every sub-folder of ``root`` in one scan; ``origin_col`` is the name of
    the folder right below ``root`` (no per-folder loop, one job for all).
    ``partitions`` names ``key=value`` folders further down whose values
    become text columns."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.option("recursiveFileLookup", "true").load(root)
    path, name = F.col("_metadata.file_path"), root.rstrip("/").rsplit("/", 1)[-1]
    below = F.element_at(F.split(path, "/" + re.escape(name) + "/"), -1)
    values = {p: F.url_decode(F.regexp_extract(path, f"/{re.escape(p)}=([^/]*)/", 1)) for p in partitions}
    return df.withColumns({origin_col: F.url_decode(F.substring_index(below, "/", 1)), **values})


def scan_documents(spark: SparkSession, path: str, schema, multiline: bool = True) -> DataFrame:
    """JSON documents with a declared schema, one row per document.

    A value that does not fit its type is null here; ``rescue.scan_records``
    keeps such documents apart with a reason.
    """
    return spark.read.schema(schema).option("multiLine", str(multiline).lower()).json(path)
