"""Nested documents: parallel arrays to rows, JSON in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zip_to_rows(df: DataFrame, struct_col: str, fields, keep=()) -> DataFrame:
    """``{f1: [..], f2: [..]}`` -> one row per array position with columns
    ``f1, f2, ...`` (shorter arrays padded with null); ``keep`` columns repeat."""
    fields = list(fields)
    zipped = F.arrays_zip(*[F.col(f"{struct_col}.{f}") for f in fields])
    return df.select(*keep, F.inline(zipped))


def parse_json(df: DataFrame, col: str, schema, out: str | None = None) -> DataFrame:
    """JSON text -> nested value with a declared schema.

    Bad text gives a struct of nulls, as missing fields do;
    ``sources.parse_records`` tells the two apart with a reason.
    """
    return df.withColumn(out or col, F.from_json(F.col(col), schema))


def rows_as_json(df: DataFrame, cols=None, out: str = "json") -> DataFrame:
    """One JSON object per row (null fields omitted)."""
    cols = list(cols) if cols else df.columns
    return df.select(F.to_json(F.struct(*cols)).alias(out))
