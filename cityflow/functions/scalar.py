"""Column expressions (Column -> Column). All JVM-side built-ins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_text(ts, style: str = "HH") -> Column:
    """Hour of a timestamp as text: ``HH`` or ``HH:00:00``."""
    if style == "HH":
        return F.date_format(_col(ts), "HH")
    if style == "HH:00:00":
        return F.date_format(_col(ts), "HH:00:00")
    raise ValueError(f"unknown hour style {style!r}")


def hour_label(hour) -> Column:
    """``HH`` (or an unpadded hour number) to ``HH:00:00``."""
    return F.concat(F.lpad(_col(hour).cast("string"), 2, "0"), F.lit(":00:00"))


def fixed_text(c, digits: int = 2) -> Column:
    """Fixed-point text; null stays null (plain ``format_string`` gives 'nu')."""
    c = _col(c)
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f", c))


def repaired_sign(c, floor: float = -10.0) -> Column:
    """x < floor -> 0; floor <= x < 0 -> |x|; otherwise x (null stays null)."""
    c = _col(c)
    return F.when(c < F.lit(floor), F.lit(0.0)).when(c < F.lit(0.0), F.abs(c)).otherwise(c)


def midpoint(high, low) -> Column:
    return (_col(high) + _col(low)) / F.lit(2.0)


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def coerced_double(c) -> Column:
    """Text or number to double; unparsable text and NaN become null."""
    return nan_to_null(_col(c).cast("string").try_cast("double"))


def coerced_timestamp(c, fmt: str | None = None) -> Column:
    """Text to timestamp (session zone, UTC here); unparsable text becomes null."""
    c = _col(c).cast("string")
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def utc_timestamp(c, fmt: str | None = None) -> Column:
    """Text to the UTC wall-clock time whatever the session zone; text without an offset is UTC already."""
    text = _col(c).cast("string")
    moment = coerced_timestamp(text, fmt)
    return F.when(text.rlike(r"(Z|[+-]\d\d:?\d\d)$"), F.to_utc_timestamp(moment, F.current_timezone())).otherwise(moment)


# Sums of doubles depend on the order rows are added in, which changes with
# partitioning; a result rounded to cents can flip at a tie (411.345 summed as
# 411.34499...). Values that are rounded afterwards are therefore summed as
# decimals. A group with NaN, infinite or huge values is summed as doubles.
SUM_TYPE, SUM_MAX = "decimal(28,10)", 1e17


def _odd(c) -> Column:
    x = _col(c).cast("double")
    return F.isnan(x) | (F.abs(x) >= SUM_MAX)


def sum_parts(c, name: str) -> list[Column]:
    """Aggregates a rounded sum or mean is made of: decimal sum, double sum, odd values, values."""
    x = _col(c)
    return [F.sum(F.when(~_odd(c), x.cast(SUM_TYPE))).alias(f"_s_{name}"), F.sum(x.cast("double")).alias(f"_d_{name}"),
            F.count_if(_odd(c)).alias(f"_o_{name}"), F.count(x).alias(f"_k_{name}")]


def merged_parts(name: str) -> tuple[Column, Column, Column, Column]:
    """Sums of the partial aggregates of :func:`sum_parts`."""
    return tuple(F.sum(f"_{x}_{name}") for x in "sdok")


def rounded_parts(parts, digits: int, mean: bool, half_even: bool = False) -> Column:
    """Rounded sum or mean from (decimal sum, double sum, odd values, values); null without values."""
    exact, plain, odd, count = parts
    tidy = F.bround if half_even else F.round
    if mean:
        exact, plain = F.try_divide(exact, count.cast("decimal(20,0)")), F.try_divide(plain, count)
    return F.when(count > 0, F.when(odd > 0, tidy(plain, digits)).otherwise(tidy(F.coalesce(exact, F.lit(0)), digits).cast("double")))


def _parts(c):
    x = _col(c)
    return F.sum(F.when(~_odd(c), x.cast(SUM_TYPE))), F.sum(x.cast("double")), F.count_if(_odd(c)), F.count(x)


def exact_sum(c) -> Column:
    """Aggregate: sum that does not depend on the order of the rows (as a double)."""
    exact, plain, odd, count = _parts(c)
    return F.when(count > 0, F.when(odd > 0, plain).otherwise(exact.cast("double")))


def exact_round_sum(c, digits: int, half_even: bool = False) -> Column:
    """Aggregate: sum of ``c`` rounded to ``digits``."""
    return rounded_parts(_parts(c), digits, False, half_even)


def exact_round_avg(c, digits: int, half_even: bool = False) -> Column:
    """Aggregate: mean of ``c`` rounded to ``digits``."""
    return rounded_parts(_parts(c), digits, True, half_even)


def rounded_ratio(num, den, digits: int) -> Column:
    """num / den rounded half-up on the decimal form; null for a zero or null den."""
    num, den = _col(num), _col(den)
    exact = F.round(F.try_divide(num.cast(SUM_TYPE), den.cast("decimal(20,0)")), digits).cast("double")
    return F.when(_odd(num), F.round(F.try_divide(num, den), digits)).otherwise(exact)


def row_total(cols) -> Column:
    """Row-wise sum with null counted as 0 (an all-null row gives 0)."""
    return reduce(lambda a, b: a + b, [F.coalesce(_col(c), F.lit(0)) for c in cols])


def row_mean(cols) -> Column:
    """Row-wise mean over a fixed column count; any null gives null."""
    cols = list(cols)
    return reduce(lambda a, b: a + b, [_col(c) for c in cols]) / F.lit(float(len(cols)))


def row_greatest(cols) -> Column:
    """Row-wise greatest that skips nulls."""
    cols = list(cols)
    return F.greatest(*[_col(c) for c in cols]) if len(cols) > 1 else _col(cols[0])


def safe_ratio(num, den) -> Column:
    """num / den; null when den is 0 or null (ANSI division raises otherwise)."""
    return F.try_divide(_col(num), _col(den))


# The series-name normalisation strips slashes and drops
# underscores and spaces; header sanitising maps these characters.
SERIES_NAME_DROP = "_ "
HEADER_RULES = (("^", "Vol_"), (" ", "_"), (".", "_"))


def normalise_name(name: str) -> str:
    """Series name used as a column suffix: strip '/', drop '_' and ' '."""
    name = name.strip("/")
    for ch in SERIES_NAME_DROP:
        name = name.replace(ch, "")
    return name


def sanitise_name(name: str, rules=HEADER_RULES) -> str:
    for old, new in rules:
        name = name.replace(old, new)
    return name


def matching(columns, text: str) -> list[str]:
    """Columns whose name contains ``text`` (in column order)."""
    return [c for c in columns if text in c]
