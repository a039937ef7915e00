"""Data-quality suite in one scan, its summary, report text and alert rows.

Every rule becomes a ``count_if`` inside a single aggregation, so a suite of
any size costs one pass over the table; the per-rule table is built from the
one-row result with an explode.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.scalar import fixed_text


@dataclass(frozen=True)
class Rule:
    """One expectation; ``failing()`` is true for an unexpected value."""
    name: str
    column: str
    lo: float | None = None
    hi: float | None = None

    def failing(self) -> Column:
        c = F.col(self.column)
        if self.name == NOT_NULL:
            return c.isNull()
        bad = F.lit(False)
        if self.lo is not None:
            bad = bad | (c < F.lit(self.lo))
        if self.hi is not None:
            bad = bad | (c > F.lit(self.hi))
        return c.isNotNull() & bad  # nulls are not failures of a range rule


# Expectation names.
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"


def not_null(col: str) -> Rule:
    return Rule(NOT_NULL, col)


def between(col: str, lo=None, hi=None) -> Rule:
    """Inclusive bounds; nulls are ignored (not failures)."""
    return Rule(BETWEEN, col, lo, hi)


def run_suite(df: DataFrame, rules) -> DataFrame:
    """One row per rule: rule, column, element_count, unexpected_count, success (an empty table fails none)."""
    rules = list(rules)
    counts = df.agg(*_observed(rules))
    per_rule = F.array(*[
        F.struct(F.lit(i).alias("rule_index"), F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                 F.col("_n").alias("element_count"), F.col(f"_f{i}").alias("unexpected_count"))
        for i, r in enumerate(rules)])
    return (counts.select(F.inline(per_rule))
            .withColumn("success", F.col("unexpected_count") == 0))


def _observed(rules) -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), *[F.count_if(r.failing()).alias(f"_f{i}") for i, r in enumerate(rules)]]


def checked_write(df: DataFrame, rules, write) -> DataFrame:
    """``write(df)`` with the rules counted in the same pass; returns the rows of :func:`run_suite`.

    The counts are metrics that Spark takes while the rows go to the sink, so
    the input is computed once. They are those of the rows that were written:
    ``write`` must run one query over all rows it is given.
    """
    rules, seen = list(rules), Observation()
    write(df.observe(seen, *_observed(rules)))
    counts = seen.get
    rows = [(i, r.name, r.column, counts["_n"], counts[f"_f{i}"], counts[f"_f{i}"] == 0) for i, r in enumerate(rules)]
    return df.sparkSession.createDataFrame(rows, "rule_index int, rule string, column string, element_count long, unexpected_count long, success boolean")


def rule_mask(df: DataFrame, rules, out: str = "failed_rules") -> DataFrame:
    """``df`` with a bit mask of the rules each row fails (bit i: rule i; 0: none), for at most 63 rules."""
    rules = list(rules)
    if len(rules) > 63:
        raise ValueError("a mask holds 63 rules")
    bits = [F.when(r.failing(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(rules)]
    return df.withColumn(out, reduce(lambda a, b: a.bitwiseOR(b), bits) if bits else F.lit(0).cast("long"))


def failed_names(rules, mask: str = "failed_rules") -> Column:
    """The failed rules of a mask as an array of ``rule(column)``."""
    names = F.array(*[F.when(F.col(mask).bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(f"{r.name}({r.column})")) for i, r in enumerate(rules)])
    return F.array_compact(names)


def fail_on(results: DataFrame) -> None:
    """Raises with the names of failed rules (a result has one row per rule); writes go on without it."""
    failed = [r["rule"] for r in results.where(~F.col("success")).select("rule").collect()]
    if failed:
        raise ValueError(f"data quality rules failed: {', '.join(failed)}")


def summarise(results: DataFrame) -> DataFrame:
    """success, success_percent, evaluated_expectations, unsuccessful_expectations."""
    n = F.count(F.lit(1))
    bad = F.count_if(~F.col("success"))
    return results.agg(
        (bad == 0).alias("success"),
        (F.lit(100.0) * (n - bad) / n).alias("success_percent"),
        n.cast("int").alias("evaluated_expectations"),
        bad.cast("int").alias("unsuccessful_expectations"),
    )


# Layout of the quality message.
REPORT_FORMAT = ("**Data Quality report for %s**\n**Status:** %s\n**Success Rate:** %.1f%%\n"
                 "**Checks Run:** %d\n**Failures:** %d")


def report_text(summary: DataFrame, title: str, out: str = "report") -> DataFrame:
    """The one-row summary with its message text (PASSED / FAILED)."""
    status = F.when(F.col("success"), F.lit("PASSED")).otherwise(F.lit("FAILED"))
    return summary.withColumn(out, F.format_string(
        REPORT_FORMAT, F.lit(title), status, F.col("success_percent"),
        F.col("evaluated_expectations"), F.col("unsuccessful_expectations")))


def latest(df: DataFrame, order: str, k: int = 2, by=()) -> DataFrame:
    """Newest ``k`` rows by ``order`` (per series when ``by`` is given).

    Global form plans as TakeOrderedAndProject (per-task top-k, then merge).
    """
    by = list(by)
    if not by:
        return df.orderBy(F.col(order).desc()).limit(k)
    w = Window.partitionBy(*by).orderBy(F.col(order).desc())
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k).drop("_rk")


def alert_rows(df: DataFrame, order: str, cols, k: int = 2, digits: int = 2, by=()) -> DataFrame:
    """Latest ``k`` rows with ``cols`` as fixed-point text."""
    cols = list(cols)
    top = latest(df.select(*by, order, *cols), order, k, by)
    return top.select(*by, order, *[fixed_text(c, digits).alias(c) for c in cols])
