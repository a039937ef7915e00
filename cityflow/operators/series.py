"""Calendar-complete daily series: densify with ordered fills, day-on-day change.

Fills work on one row per (series, day) in blocks of days. A window never
holds more than a block of days of one series, however many rows a day has,
and values cross blocks in levels (see ``fill``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import as_date_lit
from .fill import fill_ordered

#: Days of a block: what one window holds of a series at most.
DAY_BLOCK = 1 << 12


def _fill_expr(c: str, by, order: str, directions):
    """Fill in ``directions`` order with one sort per series.

    The first direction is a growing frame (incremental) in its own order.
    The second direction can only fill the edge gap the first one leaves
    (the leading gap after a forward fill, the trailing gap after a backward
    fill), and there it equals the series' first (resp. last) non-null
    value: a whole-partition frame over the same ordering, evaluated once
    per partition, with no second sort.
    """
    asc = directions[0] == "forward"
    o = F.col(order).asc() if asc else F.col(order).desc()
    grow = Window.partitionBy(*by).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    primary = F.last(c, ignorenulls=True).over(grow)
    if len(directions) == 1:
        return primary
    whole = Window.partitionBy(*by).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(primary, F.first(c, ignorenulls=True).over(whole))


def _day_of(value) -> dt.date:
    return value if isinstance(value, dt.date) and not isinstance(value, dt.datetime) else dt.date.fromisoformat(str(value)[:10])


def densify(df: DataFrame, day: str, by, start, end, fill=("forward", "backward"), defaults: dict | None = None,
            values=None, keys: DataFrame | None = None, unique: bool = False, block: int = DAY_BLOCK) -> DataFrame:
    """Every day of [start, end] for every series, gaps filled in order.

    The calendar comes from the window: a series of ``df`` has every day even
    if none of its rows lies in the window, and without series (``by=[]``)
    the calendar is there even for an empty ``df``. Rows outside the window
    are dropped and cannot seed a fill; several rows of a day all stay. With
    ``keys`` (a DataFrame of series, e.g. a dimension) exactly its series get
    the calendar. A null series is a series. ``fill`` is applied per value
    column independently, ``defaults`` replaces what is still null.

    A day hands on one value to others: the greatest of its rows, which is
    also what a null on that day becomes. Days are reduced to that before the
    fill (partial aggregates; the rows themselves meet the filled days in a
    join on (series, day) whose hot days AQE splits). ``unique`` says that a
    series has one row a day at most (two make an error), so that the rows
    are the days and nothing is joined back.

    The calendar is made per (series, block of ``block`` days), where the days
    that have rows are gathered and the missing ones added; so no array and no
    window holds more than a block of days. If the calendar has several
    blocks, values are carried across them in levels.
    """
    by = list(by)
    values = list(values) if values is not None else [c for c in df.columns if c not in by + [day]]
    first, last = _day_of(start), _day_of(end)
    n_days = (last - first).days + 1
    n_blocks = max(1, -(-n_days // block))
    place, held = [f"_s{i}" for i in range(len(by))], [f"_v{i}" for i in range(len(values))]
    types = dict(df.dtypes)
    rows = df.select(*[F.col(b).alias(p) for b, p in zip(by, place)], F.datediff(F.col(day).cast("date"), as_date_lit(first)).alias("_at"),
                     *[F.col(v).alias(h) for v, h in zip(values, held)])
    # A struct of the series is equal to one with the same nulls, so plain equality joins.
    rows = rows.withColumn("_series", F.struct(*place) if by else F.lit(0)).drop(*place)
    inside = (F.col("_at") >= 0) & (F.col("_at") < n_days)
    # Rows outside the window only say that their series is there.
    states = rows.withColumn("_at", F.when(inside, F.col("_at"))).withColumns({h: F.when(inside, F.col(h)) for h in held})
    if unique:
        states = states.withColumn("_n", F.lit(1).cast("long"))
    else:
        states = states.groupBy("_series", "_at").agg(*[F.max(h).alias(h) for h in held], F.count("*").alias("_n"))
    group = ["_series"] + ["_block"] * (n_blocks > 1)
    entry = F.struct("_at", "_n", *held)
    kind = "array<struct<_at:int,_n:bigint" + "".join(f",{h}:{types[v]}" for h, v in zip(held, values)) + ">>"
    per = (states.withColumn("_block", F.floor(F.col("_at") / block).cast("int")).groupBy(*group)
           .agg(F.collect_list(F.when(F.col("_at").isNotNull(), entry)).cast(kind).alias("_rows")))
    listed = None
    if keys is not None and by:
        listed = keys.select(F.struct(*[F.col(b).alias(p) for b, p in zip(by, place)]).alias("_series")).distinct()
    elif not by:
        listed = df.sparkSession.range(1).select(F.lit(0).alias("_series"))
    elif n_blocks > 1:
        listed = rows.select("_series").distinct()
    if listed is not None:
        whole = listed.select("_series", *([F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_block")] if n_blocks > 1 else []))
        per = whole.join(per, group, "left")
    from_, to = (F.col("_block") * block, F.least(F.col("_block") * block + block, F.lit(n_days)) - 1) if n_blocks > 1 else (F.lit(0), F.lit(n_days - 1))
    every = F.sequence(from_, to) if n_days > 0 else F.array().cast("array<int>")
    found = F.coalesce(F.col("_rows"), F.array().cast(kind))
    if unique:
        found = F.when(F.size(F.array_distinct(F.transform(found, lambda r: r["_at"]))) < F.size(found),
                       F.raise_error(F.lit("densify: a series has several rows a day")).cast(kind)).otherwise(found)
    missing = F.array_except(every, F.transform(found, lambda r: r["_at"]))
    gaps = F.transform(missing, lambda d: F.struct(d.alias("_at"), F.lit(None).cast("bigint").alias("_n"),
                                                   *[F.lit(None).cast(types[v]).alias(h) for v, h in zip(values, held)])).cast(kind)
    days = per.select("_series", F.explode(F.concat(found, gaps)).alias("_r")).select("_series", "_r.*")
    if fill and n_blocks == 1:
        days = days.withColumns({h: _fill_expr(h, ["_series"], "_at", fill) for h in held})
    elif fill:
        days = fill_ordered(days, held, "_at", by=["_series"], directions=tuple(fill), block=block)
    if not unique:
        days = days.withColumnsRenamed({h: f"_f{h}" for h in held})
        met = rows.where(inside).join(days.where("_n is not null").drop("_n"), ["_series", "_at"]).select(
            "_series", "_at", *[(F.coalesce(h, f"_f{h}") if fill else F.col(h)).alias(h) for h in held])
        days = met.union(days.where("_n is null").select("_series", "_at", *[f"_f{h}" for h in held]))
    out = days.select(*[F.col("_series")[p].alias(b) for b, p in zip(by, place)], F.date_add(as_date_lit(first), F.col("_at")).alias(day),
                      *[F.col(h).alias(v) for h, v in zip(held, values)])
    return out.fillna(defaults) if defaults else out


def daily_change(df: DataFrame, col: str, order: str, by=(), first: float = 0.0, out: str | None = None) -> DataFrame:
    """``col - previous col`` in ``order`` per series; the first row (and any
    null difference) gets ``first``."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn(out or f"{col}_change", F.coalesce(F.col(col) - F.lag(col, 1).over(w), F.lit(first)))
