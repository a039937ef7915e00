"""Date spine, date dimension, number generator and date keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import as_date_lit, day_sequence


def date_spine(spark, start, end, col: str = "date") -> DataFrame:
    """One row per day in [start, end] (literal bounds)."""
    return spark.range(1).select(F.explode(day_sequence(as_date_lit(start), as_date_lit(end))).alias(col))


def spine_between(bounds: DataFrame, start: str, end: str, col: str = "date", keep=()) -> DataFrame:
    """One row per day between two date columns of each input row."""
    return bounds.select(*keep, F.explode(day_sequence(F.col(start), F.col(end))).alias(col))


def numbered_days(bounds: DataFrame, start: str, end: str, n: str = "n", col: str = "date") -> DataFrame:
    """(n, date) with n = 0..days-1: the number generator and the spine in one."""
    return bounds.select(F.posexplode(day_sequence(F.col(start), F.col(end))).alias(n, col))


def numbers(spark, count: int, col: str = "n") -> DataFrame:
    return spark.range(count).withColumnRenamed("id", col)


def dim_date(dates: DataFrame, col: str = "date") -> DataFrame:
    """DateKey, Year, Month, MonthName, DayOfWeek (English names)."""
    d = F.col(col).cast("date")
    return dates.select(
        d.alias("DateKey"),
        F.year(d).alias("Year"),
        F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.date_format(d, "EEEE").alias("DayOfWeek"),
    )


def dim_date_range(spark, start, end) -> DataFrame:
    return dim_date(date_spine(spark, start, end))


def with_date_key(df: DataFrame, col: str, key: str = "DateKey") -> DataFrame:
    """``CAST(col AS DATE) AS DateKey, *`` — the fact keeps its own date too."""
    return df.select(F.col(col).cast("date").alias(key), *[F.col(c) for c in df.columns])


def with_dim(fact: DataFrame, dim: DataFrame, on: str = "DateKey", how: str = "left") -> DataFrame:
    """Fact joined to a date dimension. The dimension has one row per day of
    a bounded calendar, so the planner broadcasts it by measured size."""
    return fact.join(dim, on=on, how=how)
