"""Long -> wide facts and row-wise totals.

``widen`` replaces a fold of full outer joins over per-series tables with one
aggregation: one scan and one shuffle of the (already aggregated) long table,
instead of one scan and two shuffles per series. ``fold_union`` does the same
for inputs that really are different tables; ``full_fold`` is the fold itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import normalise_name, row_greatest as _greatest, row_mean as _mean
from ..functions.scalar import rounded_ratio, safe_ratio
from ..functions.scalar import row_total as _total


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def widen(df: DataFrame, key, series: str, metrics, values, name=normalise_name, sep: str = "_",
          totals: dict | None = None, late: dict | None = None) -> DataFrame:
    """One row per key, one column ``<metric><sep><name(series)>`` per metric
    and series. ``df`` has at most one row per (key, series).

    ``values`` lists the series that get columns (from a dimension or the
    report's contract); nothing is read to find them. ``totals`` adds
    aggregates over all series of a key, listed or not, from the same pass.
    ``late`` maps a metric to a function of its column that is applied after
    the aggregation: a text that comes from a number is widened as the number
    (texts in an aggregate force a sort, numbers are hashed).
    """
    key = [key] if isinstance(key, str) else list(key)
    if values is None:
        raise ValueError("list the series that get columns in values")
    out = [(f"{m}{sep}{name(str(v))}", m, v) for m in metrics for v in values]
    names = [o for o, _, _ in out] + list(totals or {})
    if len(set(names)) < len(names):
        raise ValueError(f"two columns of the same name among {sorted(names)}")
    aggs = [F.first(F.when(_quoted(series) == F.lit(v), _quoted(m)), ignorenulls=True).alias(o) for o, m, v in out]
    wide = df.groupBy(*key).agg(*aggs, *[c.alias(o) for o, c in (totals or {}).items()])
    return wide.withColumns({o: late[m](_quoted(o)) for o, m, _ in out if m in late}) if late else wide


def full_fold(dfs, on) -> DataFrame:
    """Full outer join of N tables on ``on`` (key columns coalesced)."""
    on = [on] if isinstance(on, str) else list(on)
    return reduce(lambda a, b: a.join(b, on=on, how="full"), list(dfs))


def fold_union(dfs, on) -> DataFrame:
    """The rows of :func:`full_fold` from one shuffle: a tagged union of the tables and one aggregation on the key.

    For tables with one row a key each; a repeated key is an error (a join
    would multiply its rows). As in a full join, a null key meets no other:
    such rows stay rows of their own. Columns other than the key must differ
    in name between tables.
    """
    dfs, on = list(dfs), [on] if isinstance(on, str) else list(on)
    own = [[c for c in df.columns if c not in on] for df in dfs]
    names = [c for cols in own for c in cols]
    if len(set(names)) < len(names):
        raise ValueError(f"two columns of the same name among {sorted(names)}")
    types = [dict(df.dtypes) for df in dfs]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])

    def placed(i: int) -> DataFrame:
        return dfs[i].select(*on, F.lit(i).alias("_table"), *[_quoted(c) if j == i else F.lit(None).cast(types[j][c]).alias(c)
                                                              for j, cols in enumerate(own) for c in cols])
    rows = reduce(lambda a, b: a.union(b), [placed(i) for i in range(len(dfs))])
    # A key has one row of each table, so any value is the value and null stays null.
    aggs = [F.first(_quoted(c), ignorenulls=True).alias(c) for c in names]
    twice = F.greatest(*[F.count_if(F.col("_table") == i) for i in range(len(dfs))], F.lit(0).cast("long"))
    met = (rows.where(whole).groupBy(*on).agg(*aggs, twice.alias("_rows"))
           .where(F.when(F.col("_rows") > 1, F.raise_error(F.lit("fold_union: a key is repeated in a table")).cast("boolean")).otherwise(True)))
    return met.drop("_rows").union(rows.where(~whole).drop("_table"))


def row_total(df: DataFrame, cols, out: str, digits: int | None = None) -> DataFrame:
    v = _total([_quoted(c) for c in cols])
    return df.withColumn(out, F.round(v, digits) if digits is not None else v)


def row_mean(df: DataFrame, cols, out: str, digits: int | None = None, half_even: bool = False) -> DataFrame:
    v = _mean([_quoted(c) for c in cols])
    if digits is not None:
        v = F.bround(v, digits) if half_even else F.round(v, digits)
    return df.withColumn(out, v)


def row_greatest(df: DataFrame, cols, out: str) -> DataFrame:
    return df.withColumn(out, _greatest([_quoted(c) for c in cols]))


def ratio(df: DataFrame, num: str, den: str, out: str, digits: int | None = None) -> DataFrame:
    """num / den (null for a zero or null den); with ``digits`` the quotient
    is rounded half-up on the decimal form."""
    if digits is None:
        return df.withColumn(out, safe_ratio(num, den))
    return df.withColumn(out, rounded_ratio(num, den, digits))


def suffix_columns(df: DataFrame, suffix: str, keep, sep: str = "_") -> DataFrame:
    """Rename every column except ``keep`` to ``<col><sep><suffix>``."""
    keep = {keep} if isinstance(keep, str) else set(keep)
    return df.withColumnsRenamed({c: f"{c}{sep}{suffix}" for c in df.columns if c not in keep})

