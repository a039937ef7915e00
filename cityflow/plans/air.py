"""Air quality: nested sensor records -> silver readings -> dense daily per
borough -> city-wide fact (C7, C8). One keyed plan serves every borough."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import coerced_double, hour_label, hour_text, matching, repaired_sign, utc_timestamp
from ..operators.aggregate import daily_stats
from ..operators.clean import require
from ..operators.series import densify
from ..operators.widen import row_greatest, row_mean, widen

AIR_METRICS = ["avg_value_pm2_5", "peak_value_pm2_5", "peak_value_hour"]
# Hour used when a series has no reading at all; sign-repair floor.
NO_HOUR = "00:00:00"
SIGN_FLOOR = -10.0


def clean_readings(raw: DataFrame, keep=(), ts_format: str | None = None) -> DataFrame:
    """Silver readings (C7): nested access, coercing parse, sign repair,
    date and ``HH:00:00`` hour. Unparsable value or time drops the row."""
    parsed = raw.select(
        *keep,
        F.col("parameter.name").alias("name"),
        F.col("parameter.units").alias("units"),
        coerced_double("value").alias("pm_2_5_value"),
        utc_timestamp(F.col("period.datetimeFrom.utc"), ts_format).alias("datetime"),
    )
    ok = require(parsed, ["pm_2_5_value", "datetime"])
    return ok.select(
        *keep, "name",
        repaired_sign("pm_2_5_value", SIGN_FLOOR).alias("pm_2_5_value"),
        "units",
        F.to_date("datetime").alias("date"),
        hour_text("datetime", "HH:00:00").alias("time"),
    )


def air_daily(readings, start, end, series: str = "borough", keys: DataFrame | None = None) -> DataFrame:
    """Dense daily mean / peak / peak hour per series over [start, end] (C8 per borough).

    ``readings`` may be a list of sensor tables; they are pooled as rows.
    ``keys`` (a series dimension) gives every listed series the full calendar,
    readings or not (values null, hour ``00:00:00``).
    """
    if isinstance(readings, (list, tuple)):
        readings = reduce(lambda a, b: a.unionByName(b), readings)
    # The mean is rounded half-even to 1 digit; rounding before the fill
    # equals rounding after it, since the fill only copies values.
    stats = daily_stats(readings, [series], "date", "pm_2_5_value", slot="time",
                        mean="avg_value_pm2_5", peak="peak_value_pm2_5", peak_slot_name="peak_value_hour",
                        mean_digits=1, half_even=True)
    return densify(stats, "date", [series], start, end, fill=("forward", "backward"),
                   defaults={"peak_value_hour": NO_HOUR}, keys=keys, unique=True)


def air_fact(dense: DataFrame, series: str = "borough", values=None, city: str = "NYC") -> DataFrame:
    """Wide daily fact: per-series columns, city mean (null if any series is
    null, fixed divisor) and city peak (nulls skipped), ordered by date."""
    hours = dense.withColumn("peak_value_hour", F.left("peak_value_hour", F.lit(2)).cast("int"))
    wide = widen(hours, "date", series, AIR_METRICS, values=values, late={"peak_value_hour": hour_label})
    cols = wide.columns
    wide = row_mean(wide, matching(cols, "avg_value_pm2_5"), f"{city}_avg_value_pm2_5", 1)
    wide = row_greatest(wide, matching(cols, "peak_value_pm2_5"), f"{city}_peak_value_pm2_5")
    return wide.orderBy("date")
