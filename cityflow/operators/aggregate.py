"""Grouped statistics, peak slots and top-k per group.

The daily fact is computed in two levels: rows -> (series, day, slot) partials
(map-side combined, so a hot series is reduced inside each input task before
the shuffle), then partials -> (series, day). The second level reads at most
#series x #days x #slots rows, so it is cheap at any input size, and the peak
slot comes out of the same aggregation instead of a rank + join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import exact_round_avg, exact_round_sum, merged_parts, rounded_parts, sum_parts


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def earliest_max(slot, score) -> Column:
    """The slot with the highest score, ties -> smallest slot; null scores skipped."""
    score, slot = _c(score), _c(slot)
    return F.min_by(slot, F.when(score.isNotNull(), F.struct((-score).alias("s"), slot.alias("t"))))


def slot_counts(df: DataFrame, by, day: str, slot: str, name: str = "count") -> DataFrame:
    """Rows per (series, day, slot)."""
    return df.groupBy(*by, day, slot).agg(F.count(F.lit(1)).alias(name))


def peak_slot(df: DataFrame, by, day: str, slot: str, score: str | None = None,
              out: str = "peak_slot", peak_value: str | None = None) -> DataFrame:
    """Peak slot per (series, day).

    ``score=None``: the slot with the most rows; otherwise the slot of the row
    with the highest ``score``. Ties go to the earliest slot. Two levels: a
    hash aggregation to (series, day, slot) with map-side combine, then the
    tie-break over that small table (the struct ordering it needs would force
    a sort-based aggregation if applied to raw rows).
    """
    by = list(by)
    if score is None:
        counts = slot_counts(df, by, day, slot, "_n")
        return counts.groupBy(*by, day).agg(earliest_max(slot, "_n").alias(out))
    slots = df.groupBy(*by, day, slot).agg(F.max(score).alias("_mx"))
    aggs = [earliest_max(slot, "_mx").alias(out)]
    if peak_value:
        aggs.append(F.max("_mx").alias(peak_value))
    return slots.groupBy(*by, day).agg(*aggs)


def top_per_group(df: DataFrame, by, order, n: int = 1, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group by ``order`` (row_number; Catalyst adds a
    per-task group limit before the shuffle)."""
    w = Window.partitionBy(*by).orderBy(*order)
    rn = rank_col or "_rank"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def daily_fact(df: DataFrame, by, day: str, slot: str, measures, count_name: str = "total_trips",
               peak_name: str | None = "peak_trip_hour") -> DataFrame:
    """Daily statistics per series with the busiest slot, single pass.

    ``measures``: list of ``(out, how, col, digits)`` with ``how`` in
    ``avg | sum``; ``digits=None`` leaves the value unrounded (half-up otherwise).
    Averages ignore nulls; the count is of rows. Rounded values are formed
    from decimal sums, so they do not depend on how rows are partitioned.
    """
    by = list(by)
    if not peak_name:
        exact = {"avg": (F.avg, exact_round_avg), "sum": (F.sum, exact_round_sum)}
        aggs = [F.count(F.lit(1)).alias(count_name)]
        for out, how, c, digits in measures:
            plain, rounded = exact[how]
            aggs.append((plain(c) if digits is None else rounded(c, digits)).alias(out))
        return df.groupBy(*by, day).agg(*aggs)
    cols = sorted({m[2] for m in measures})
    partial_aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        partial_aggs += sum_parts(c, c)
    partial = df.groupBy(*by, day, slot).agg(*partial_aggs)

    final_aggs = [F.sum("_n").alias(count_name)]
    for out, how, c, digits in measures:
        if how not in ("sum", "avg"):
            raise ValueError(f"unknown measure {how!r}")
        parts = merged_parts(c)
        if digits is None:
            v = parts[1] if how == "sum" else F.try_divide(parts[1], parts[3])
        else:
            v = rounded_parts(parts, digits, how == "avg")
        final_aggs.append(v.alias(out))
    if peak_name:
        final_aggs.append(earliest_max(slot, "_n").alias(peak_name))
    return partial.groupBy(*by, day).agg(*final_aggs)


def daily_stats(df: DataFrame, by, day: str, value: str, slot: str | None = None,
                mean: str = "avg_value", peak: str = "peak_value", peak_slot_name: str = "peak_value_hour",
                mean_digits: int | None = None, half_even: bool = True) -> DataFrame:
    """Mean (sum / count) and max of ``value`` per (series, day), pooled
    over all rows, plus the earliest slot that reaches the max.

    With ``slot`` this runs in two levels like :func:`daily_fact`: rows ->
    (series, day, slot) partials in a hash aggregation, then the day level
    over at most 24 rows per day. No join back to the rows.
    """
    by = list(by)
    if not slot:
        m = F.avg(value) if mean_digits is None else exact_round_avg(value, mean_digits, half_even)
        return df.groupBy(*by, day).agg(m.alias(mean), F.max(value).alias(peak))
    partial = df.groupBy(*by, day, slot).agg(
        *sum_parts(value, "v"), F.max(value).alias("_mx"))
    parts = merged_parts("v")
    m = F.try_divide(parts[1], parts[3]) if mean_digits is None else rounded_parts(parts, mean_digits, True, half_even)
    return partial.groupBy(*by, day).agg(
        m.alias(mean), F.max("_mx").alias(peak), earliest_max(slot, "_mx").alias(peak_slot_name))
