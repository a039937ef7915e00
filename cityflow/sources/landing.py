"""Incremental silver: only files that are new are read, only rows that are new are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin

DIGEST = "_row_digest"


def land_new_files(spark: SparkSession, source: str, schema, target: str, checkpoint: str, fmt: str = "json",
                   transform=None, max_files: int | None = None) -> int:
    """Append the rows of files that came to ``source`` since the last run to the Parquet table ``target``; returns how many rows.

    A file stream with ``availableNow``: ``checkpoint`` remembers the files
    that were read, and a batch that was cut off is written again under the
    same number, so a file's rows are in ``target`` exactly once. ``transform``
    is applied to each batch of rows (no state across runs). ``max_files``
    bounds the files of a batch, not of a run.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(source)
    rows = transform(rows) if transform else rows
    run = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return sum(p["numInputRows"] for p in run.recentProgress)


def row_digest(df: DataFrame, cols=None) -> Column:
    """128 bits of all values of a row, nulls apart from empty texts; equal rows have equal digests.

    Times count to the microsecond, and a negative zero is a zero, as in ``dropDuplicates``.
    """
    kinds = dict(df.dtypes)
    values = [(F.col(f"`{c}`") + F.lit(0.0).cast(kinds[c])).alias(c) if kinds[c] in ("float", "double") else F.col(f"`{c}`") for c in cols or df.columns]
    return F.md5(F.to_json(F.struct(*values), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                                               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}))


def append_distinct(df: DataFrame, table: str, buckets: int = 64, path: str | None = None) -> int:
    """Append the rows of ``df`` that the stored table does not have yet; returns how many.

    Over several calls the table is ``dropDuplicates`` of everything. It is
    bucketed and sorted by a digest of the row (column ``_row_digest``), so
    that only the new rows are shuffled: the stored side of the anti join is
    read bucket by bucket. The table is external below ``path``, else managed.
    """
    spark = df.sparkSession
    fresh = df.withColumn(DIGEST, row_digest(df)).dropDuplicates([DIGEST])
    if spark.catalog.tableExists(table):
        fresh = new_rows(fresh, spark.table(table))
    # Written once: to count them, and so that the table is not read while it grows.
    fresh = pin(fresh)
    n = fresh.count()
    writer = fresh.repartition(buckets, DIGEST).write.format("parquet").bucketBy(buckets, DIGEST).sortBy(DIGEST).mode("append")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return n


def new_rows(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``fresh`` whose digest the stored table lacks."""
    return fresh.join(stored.select(DIGEST), DIGEST, "left_anti")
