"""Taxi trips: raw fleets -> silver trips per borough -> daily wide fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import exact_round_sum, hour_label, hour_text
from ..operators.aggregate import daily_fact
from ..operators.clean import keep_dates, keep_range, mask_outside, require
from ..operators.clean import union_conformed
from ..operators.fill import fill_ordered, tag_file_order, with_file_order_key
from ..sources.readers import scan_merged
from ..operators.widen import ratio, widen
from ..operators.zones import assign_zones

# The silver contract and the pickup columns of the two fleets.
SILVER_COLS = ["Date", "Time", "passenger_count", "trip_distance", "DOLocationID", "PULocationID",
               "total_amount", "tip_amount"]

# The silver cuts and the gold cut on the trip amount.
DISTANCE_CUT = (0.1, 36.0, "right")   # 0.1 < distance <= 36
AMOUNT_CUT = (2.5, 500.0, "none")     # 2.5 < amount < 500
GOLD_AMOUNT_CUT = (0.0, 200.0, "right")  # 0 < amount <= 200

# Output metric names, (out, how, column, digits); the count is total_trips.
TRIP_MEASURES = [
    ("average_trip_cost", "avg", "total_amount", 2),
    ("total_amount_earned", "sum", "total_amount", 2),
    ("total_tips_earned", "sum", "tip_amount", 2),
    ("average_trip_distance", "avg", "trip_distance", 2),
    ("average_passengers", "avg", "passenger_count", 1),
]
TRIP_METRICS = ["total_trips"] + [m[0] for m in TRIP_MEASURES] + ["peak_trip_hour"]


PICKUP_SOURCES = ["tpep_pickup_datetime", "lpep_pickup_datetime"]


def raw_trips(spark, paths, fmt: str = "parquet", order: str = "row_id", schema_map: dict | None = None) -> DataFrame:
    """Bronze trips of both fleets: one merged scan (missing columns null),
    a file-order key for the fill, and ``pickup_datetime`` unified. Families
    whose columns differ in type are cast by ``schema_map`` (see
    ``scan_merged``) before they are united."""
    df = with_file_order_key(scan_merged(spark, paths, schema_map, fmt=fmt, tag=tag_file_order), order)
    present = [c for c in PICKUP_SOURCES if c in df.columns]
    return union_conformed([df], {"pickup_datetime": present})


def clean_trips(raw: DataFrame, start, end, order: str, zones: DataFrame | None = None,
                ts: str = "pickup_datetime", directions=("backward", "forward"), series: str = "borough",
                ) -> DataFrame:
    """Silver trips.

    Pickup times outside [start, end] are masked and re-filled from the
    nearest trip in ``order`` (next first, then previous), then rows are
    cleaned, projected to hour resolution and de-duplicated. With ``zones``
    each trip is assigned to every distinct borough of its two endpoints.
    The range filters sit after the fill on purpose: a dropped row can still
    be the neighbour that supplies a pickup time.
    """
    df = mask_outside(raw, ts, start, end)
    df = fill_ordered(df, [ts], order, directions=directions)
    df = require(df, [ts, "trip_distance", "total_amount"])
    df = df.withColumns({"Date": F.to_date(ts), "Time": hour_text(ts, "HH")})
    df = keep_dates(df, "Date", start, end)
    df = keep_range(df, "trip_distance", *DISTANCE_CUT)
    df = keep_range(df, "total_amount", *AMOUNT_CUT)
    silver = df.select(*SILVER_COLS).dropDuplicates()
    if zones is None:
        return silver
    return assign_zones(silver, zones, ["PULocationID", "DOLocationID"], out=series, drop_endpoints=True)


def daily_trip_stats(silver: DataFrame, series: str = "borough") -> DataFrame:
    """Long daily fact: one row per (series, Date) with all trip metrics (C6 core)."""
    cleaned = keep_range(silver, "total_amount", *GOLD_AMOUNT_CUT)
    # Labels first: of "9" and "10" the padded "09:00:00" is the earlier hour.
    return daily_fact(cleaned.withColumn("Time", hour_label("Time")), [series], "Date", "Time", TRIP_MEASURES,
                      count_name="total_trips", peak_name="peak_trip_hour")


def wide_trip_fact(long: DataFrame, series: str = "borough", values=None, city: str = "New_York") -> DataFrame:
    """Daily wide fact with columns of the listed series and city totals over all series, ordered by Date."""
    zero = F.lit(0.0)
    hours = long.withColumn("peak_trip_hour", F.left("peak_trip_hour", F.lit(2)).cast("int"))
    wide = widen(hours, "Date", series, TRIP_METRICS, values, late={"peak_trip_hour": hour_label}, totals={
        f"total_trips_{city}": F.sum("total_trips"),
        f"total_amount_earned_{city}": F.coalesce(exact_round_sum("total_amount_earned", 2), zero),
        f"total_tips_earned_{city}": F.coalesce(exact_round_sum("total_tips_earned", 2), zero)})
    wide = ratio(wide, f"total_amount_earned_{city}", f"total_trips_{city}", f"average_trip_cost_{city}", 2)
    return wide.orderBy("Date")


def trip_fact(silver: DataFrame, series: str = "borough", values=None, city: str = "New_York") -> DataFrame:
    return wide_trip_fact(daily_trip_stats(silver, series), series, values, city)
