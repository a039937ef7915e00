"""Row cleaning: ranges, required columns, coercion, masking, sign repair.

All operators are narrow (no shuffle) except ``dropDuplicates``, which users
call directly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import as_date_lit
from ..functions.scalar import coerced_double, coerced_timestamp, repaired_sign

_CLOSED = {"both": (True, True), "left": (True, False), "right": (False, True), "none": (False, False)}


def range_condition(c, lo=None, hi=None, closed: str = "both"):
    """Predicate ``lo <(=) c <(=) hi``; a missing bound is not checked."""
    inc_lo, inc_hi = _CLOSED[closed]
    c = F.col(c) if isinstance(c, str) else c
    conds = []
    if lo is not None:
        conds.append(c >= F.lit(lo) if inc_lo else c > F.lit(lo))
    if hi is not None:
        conds.append(c <= F.lit(hi) if inc_hi else c < F.lit(hi))
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def keep_range(df: DataFrame, col: str, lo=None, hi=None, closed: str = "both") -> DataFrame:
    """Keep rows with ``col`` inside the bounds; ``closed`` in both|left|right|none.

    Plain comparisons against literals, so Catalyst pushes them to the scan.
    """
    return df.filter(range_condition(col, lo, hi, closed))


def keep_dates(df: DataFrame, col: str, start, end) -> DataFrame:
    """``start <= to_date(col) <= end``, both inclusive."""
    d = F.to_date(F.col(col))
    return df.filter((d >= as_date_lit(start)) & (d <= as_date_lit(end)))


def require(df: DataFrame, cols) -> DataFrame:
    """Drop rows with a null (or NaN, for float columns) in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def coerce(df: DataFrame, spec: dict, drop_invalid: bool = True, formats: dict | None = None) -> DataFrame:
    """Parse columns without raising: ``{col: "double" | "timestamp"}``.

    Unparsable values and NaN become null; with ``drop_invalid`` those rows
    are removed (as the reading cleaner does).
    """
    formats = formats or {}
    exprs = {}
    for name, kind in spec.items():
        if kind == "double":
            exprs[name] = coerced_double(name)
        elif kind == "timestamp":
            exprs[name] = coerced_timestamp(name, formats.get(name))
        else:
            exprs[name] = F.col(name).try_cast(kind)
    out = df.withColumns(exprs)
    return require(out, list(spec)) if drop_invalid else out


def mask_outside(df: DataFrame, ts_col: str, start, end, out: str | None = None) -> DataFrame:
    """Null out ``ts_col`` when its date is outside [start, end]; rows are kept."""
    d = F.to_date(F.col(ts_col))
    inside = (d >= as_date_lit(start)) & (d <= as_date_lit(end))
    return df.withColumn(out or ts_col, F.when(inside, F.col(ts_col)))


def repair_sign(df: DataFrame, col: str, floor: float = -10.0, out: str | None = None) -> DataFrame:
    """Below ``floor`` -> 0; negative above it -> absolute value."""
    return df.withColumn(out or col, repaired_sign(col, floor))


def union_conformed(dfs, coalesce: dict | None = None) -> DataFrame:
    """Union inputs with differing column sets by name (missing -> null),
    then build unified columns: ``{"pickup_datetime": ["tpep_...", "lpep_..."]}``.
    """
    dfs = list(dfs)
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    for target, sources in (coalesce or {}).items():
        present = [c for c in sources if c in out.columns]
        out = out.withColumn(target, F.coalesce(*[F.col(c) for c in present]))
    return out
