"""Weather: column-oriented documents -> daily rows -> quality suite, gold
table and alert rows (C11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.nested import zip_to_rows
from ..operators.quality import alert_rows, between, checked_write, not_null, report_text, run_suite, summarise
from ..sources.writers import overwrite

WEATHER_FIELDS = ["time", "temperature_2m_max", "temperature_2m_min", "precipitation_sum"]
MEASURES = WEATHER_FIELDS[1:]

# The weather expectation suite (inclusive bounds).
WEATHER_RULES = [
    not_null("time"),
    between("temperature_2m_max", -30, 50),
    between("temperature_2m_min", -40, 40),
    between("precipitation_sum", 0, 300),
]
ALERT_ROWS = 2


def weather_silver(docs: DataFrame, keep=()) -> DataFrame:
    """One row per day of every document; measures as 32-bit floats, time as text."""
    rows = zip_to_rows(docs, "daily", WEATHER_FIELDS, keep=keep)
    return rows.select(*keep, F.col("time").cast("string").alias("time"),
                       *[F.col(c).cast("float").alias(c) for c in MEASURES])


def weather_quality(silver: DataFrame, rules=None) -> DataFrame:
    return run_suite(silver, rules or WEATHER_RULES)


def weather_report(silver: DataFrame, title: str, rules=None) -> DataFrame:
    return report_text(summarise(weather_quality(silver, rules)), title)


def weather_alerts(silver: DataFrame, by=(), k: int = ALERT_ROWS) -> DataFrame:
    """Newest ``k`` days (per station when ``by``), measures as 2-decimal text."""
    return alert_rows(silver, "time", MEASURES, k=k, digits=2, by=by)


def weather_gold(silver: DataFrame, target: str, rules=None, location: str | None = None) -> DataFrame:
    """Write the gold table and return its quality results, from one pass over ``silver``.

    Failing rules do not stop the write (the check reports, it does not gate); alerts come from the written table.
    """
    return checked_write(silver, rules or WEATHER_RULES, lambda df: overwrite(df, target, location=location))
