"""Star schema refresh: date dimension for the reporting window and one fact
table per gold table, each keyed by ``DateKey`` (C12)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import report_window
from ..operators.calendar import dim_date, dim_date_range, spine_between, with_date_key, with_dim
from ..sources.writers import refresh_tables


def star_tables(spark: SparkSession, facts: dict, as_of=None, start=None, end=None) -> dict:
    """``{"DimDate": dim, name: fact_with_key, ...}`` from ``{name: (df, date_col)}``.

    The dimension covers [start, end] (default: the report window of
    ``as_of``) with no cap on its length.
    """
    if start is None or end is None:
        start, end = report_window(as_of)
    tables = {"DimDate": dim_date_range(spark, start, end)}
    for name, (df, col) in facts.items():
        tables[name] = with_date_key(df, col)
    return tables


def unknown_dates(dim: DataFrame, facts: dict) -> dict[str, int]:
    """Rows of each fact whose ``DateKey`` is null or not in the dimension (facts without such rows are left out).

    One aggregation over the keys of all facts; a figure a fact reaches the
    driver.
    """
    keys = reduce(lambda a, b: a.union(b), [f.select(F.lit(n).alias("fact"), "DateKey") for n, f in facts.items()])
    counted = keys.groupBy("fact", "DateKey").agg(F.count("*").alias("n"))
    lost = counted.join(dim.select("DateKey"), "DateKey", "left_anti").groupBy("fact").agg(F.sum("n").alias("n"))
    return {r.fact: r.n for r in lost.collect()}


def refresh_star(spark: SparkSession, facts: dict, as_of=None, start=None, end=None, fmt: str = "parquet",
                 dim: str = "DimDate", location: str | None = None) -> list:
    """Replace the dimension and all facts as one unit.

    Everything is written first; every ``DateKey`` must be in the new
    dimension, else nothing is switched and the old star stays whole.
    """
    tables = star_tables(spark, facts, as_of, start, end)
    tables = {dim if name == "DimDate" else name: df for name, df in tables.items()}

    def check(written: dict) -> None:
        lost = unknown_dates(written[dim], {n: df for n, df in written.items() if n != dim}) if len(written) > 1 else {}
        if lost:
            raise ValueError(f"rows without a day in {dim}: {lost}")
    return refresh_tables(spark, tables, fmt, location, check)


def dim_for_span(df: DataFrame, col: str) -> DataFrame:
    """Calendar dimension from the first to the last date present in ``df``."""
    bounds = df.agg(F.min(F.to_date(col)).alias("s"), F.max(F.to_date(col)).alias("e"))
    return dim_date(spine_between(bounds, "s", "e"))


__all__ = ["star_tables", "refresh_star", "unknown_dates", "dim_for_span", "with_dim", "with_date_key"]
