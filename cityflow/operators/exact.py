"""Sums and means of doubles of any size that do not depend on the order of the rows.

A double is taken as the decimal number it is written as (at most 17 digits).
Most values fit one decimal sum; the others, too large or with digits too far
behind the point, are split into digits and power of ten and added up per
range of powers, so nothing is cut off. The few sums of a group are put
together exactly and rounded once.
"""

from __future__ import annotations

from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import SUM_MAX, SUM_TYPE

#: Powers of ten that share a sum. Digits of a value (up to 17) times 10^9, added up over 10^12 rows, stay below 10^38.
RANGE = 10
_DIGITS = "decimal(38,0)"


def _parts(x: Column) -> tuple[Column, Column]:
    """(digits with sign, power of ten) of a finite double: x = digits * 10^power."""
    text = x.cast("string")
    mantissa, power = F.substring_index(text, "E", 1), F.coalesce(F.get(F.split(text, "E"), F.lit(1)).try_cast("int"), F.lit(0))
    after = F.length(F.get(F.split(mantissa, r"\."), F.lit(1)))
    return F.replace(mantissa, F.lit("."), F.lit("")).try_cast(_DIGITS), power - F.coalesce(after, F.lit(0))


def exact_totals(df: DataFrame, by, measures) -> DataFrame:
    """One row per group of ``by`` with each of ``measures``: ``(out, "sum" | "avg", column, digits or None)``.

    Sums and means are exact and then rounded once: half up to ``digits``, or
    to the nearest double. Nulls are left out, a group without values is null.
    NaN, and infinities of both signs together, give NaN; otherwise infinity
    wins, as in a plain sum. Groups are reduced in each task before they are
    shuffled; a group has at most 65 partial sums a column.
    """
    by, measures = list(by), list(measures)
    columns = list(dict.fromkeys(m[2] for m in measures))
    value = F.col("_v").cast("double")
    plain = value.try_cast(SUM_TYPE)
    # A value the plain decimal holds comes back unchanged.
    fits = (F.abs(value) < SUM_MAX) & F.coalesce(plain.cast("double") == value, F.lit(False))
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    digits, power = _parts(value)
    span = F.when(finite & ~fits, F.floor(power / RANGE).cast("int"))
    shifted = digits * F.element_at(F.array(*[F.lit(10 ** i).cast("decimal(11,0)") for i in range(RANGE)]), (F.pmod(power, F.lit(RANGE)) + 1).cast("int"))
    long = df.select(*by, F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(columns)])).alias("_e"))
    long = long.select(*by, "_e.*").withColumn("_span", span)
    sums = long.groupBy(*by, "_c", "_span").agg(
        F.count("_v").alias("n"), F.sum(F.when(fits, plain)).alias("plain"), F.sum(F.when(F.col("_span").isNotNull(), shifted.cast(_DIGITS))).alias("digits"),
        F.sum(F.when(~finite, value)).alias("odd"))
    entry = F.struct(F.col("_span").alias("span"), "n", F.col("plain").cast("string").alias("plain"), F.col("digits").cast("string").alias("digits"), "odd")
    whole = sums.groupBy(*by).agg(*[F.collect_list(F.when(F.col("_c") == i, entry)).alias(f"_s{i}") for i in range(len(columns))])
    return whole.select(*by, *[_joined(F.col(f"_s{columns.index(c)}"), how, places).alias(out) for out, how, c, places in measures])


def total(entries: list[dict]) -> tuple[Fraction, int, float | None]:
    """(exact sum, values, sum of the values that are not finite) of a group's partial sums."""
    exact, n, odd = Fraction(0), 0, None
    for e in entries:
        n += e["n"]
        exact += Fraction(e["plain"] or 0)
        if e["digits"] is not None:
            exact += Fraction(e["digits"]) * Fraction(10) ** (RANGE * e["span"])
        if e["odd"] is not None:
            odd = e["odd"] if odd is None else odd + e["odd"]
    return exact, n, odd


def rounded(x: Fraction, places: int | None) -> float:
    """The nearest double of ``x``, or of ``x`` rounded half away from zero to ``places``."""
    if places is not None:
        scaled = abs(x) * 10 ** places
        whole = int(scaled) + (scaled - int(scaled) >= Fraction(1, 2))
        x = Fraction(whole if x >= 0 else -whole, 10 ** places)
    try:
        return float(x)
    except OverflowError:
        return float("inf") if x > 0 else float("-inf")


def _joined(parts: Column, how: str, places: int | None) -> Column:
    def join(column: pa.Array) -> pa.Array:
        out = []
        for entries in column.to_pylist():
            exact, n, odd = total(entries)
            out.append(None if n == 0 else odd if odd is not None else rounded(exact / n if how == "avg" else exact, places))
        return pa.array(out, pa.float64())
    return F.arrow_udf(join, "double")(parts)
