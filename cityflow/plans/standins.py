"""Reference-shaped inputs derived from the driver's tables.

The reference reads taxi files, sensor API records, quotes and a weather
document; the test data has TPC-H-like tables and an ``events`` stream. Each
function here maps a driver table onto one reference contract with plain
column expressions, so every query reads the whole given table and its work
grows with it. The oracle SQL uses the same mappings.

Mappings (all documented in README):
- trips: events — pickup = ts, borough = event_type, amount = value,
  tip = value * 0.15, distance = props.k / 10, passengers = user_id % 6,
  pickup zone = user_id, dropoff zone = props.k.
- fleets: orders (family A, tpep = o_orderdate) and lineitem (family B,
  lpep = l_shipdate).
- readings: events — sensor = user_id, borough = event_type, value.
- raw readings: events as nested API records; ``value`` text = props.k - 20,
  signup events carry no period (dropped as unparsable).
- quotes: last event value per (day, ticker); ticker = event_type with
  view -> ^VIX, purchase -> SPY, click -> XLI.
- weather: one document per (station = event_type, month) with daily arrays
  of max(value)/10, min(value)/10, sum(value)/100.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import exact_sum, hour_text

# The ticker names the market plan expects.
TICKERS = {"view": "^VIX", "purchase": "SPY", "click": "XLI"}
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def load(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def props_k(col: str = "props"):
    return F.get_json_object(F.col(col), "$.k").cast("double")


def trips_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("ts").alias("pickup_datetime"),
        F.col("event_type").alias("borough"),
        (F.col("user_id") % 6).cast("double").alias("passenger_count"),
        (props_k() / 10.0).alias("trip_distance"),
        F.col("value").alias("total_amount"),
        (F.col("value") * 0.15).alias("tip_amount"),
        F.col("user_id").cast("int").alias("PULocationID"),
        props_k().cast("int").alias("DOLocationID"),
    )


def fleet_a_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderdate").alias("tpep_pickup_datetime"),
                         F.col("o_totalprice").alias("total_amount"))


def fleet_b_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_shipdate").alias("lpep_pickup_datetime"),
                           F.col("l_quantity").alias("trip_distance"),
                           (F.col("l_extendedprice") / 100.0).alias("total_amount"))


def readings_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("sensor_id"),
        F.col("event_type").alias("borough"),
        F.col("value").alias("pm_2_5_value"),
        F.to_date("ts").alias("date"),
        hour_text("ts", "HH:00:00").alias("time"),
    )


def raw_readings_from_events(events: DataFrame) -> DataFrame:
    period = F.when(F.col("event_type") != "signup",
                    F.struct(F.struct(F.date_format("ts", ISO_UTC).alias("utc")).alias("datetimeFrom")))
    return events.select(
        "event_id",
        F.col("user_id").alias("sensor_id"),
        period.alias("period"),
        F.struct(F.lit("pm25").alias("name"), F.lit("µg/m³").alias("units")).alias("parameter"),
        (props_k().cast("int") - 20).cast("string").alias("value"),
    )


def quotes_from_events(events: DataFrame) -> DataFrame:
    """Long quotes: Date, ticker, Close (last value of the day)."""
    mapped = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in TICKERS.items() for x in kv]),
                                     F.col("event_type")), F.col("event_type"))
    return (events.groupBy(F.to_date("ts").alias("Date"), mapped.alias("ticker"))
            .agg(F.max_by("value", "ts").alias("Close")))


def weather_docs_from_events(events: DataFrame) -> DataFrame:
    """One row per (station, month): ``daily`` struct of parallel arrays."""
    daily = (events.groupBy(F.col("event_type").alias("station"), F.to_date("ts").alias("day"))
             .agg((F.max("value") / 10.0).alias("tmax"), (F.min("value") / 10.0).alias("tmin"),
                  (exact_sum("value") / 100.0).alias("precip")))
    docs = (daily.groupBy("station", F.trunc("day", "MM").alias("month"))
            .agg(F.array_sort(F.collect_list(F.struct("day", "tmax", "tmin", "precip"))).alias("d")))
    return docs.select("station", "month", F.struct(
        F.transform("d", lambda x: F.date_format(x["day"], "yyyy-MM-dd")).alias("time"),
        F.transform("d", lambda x: x["tmax"]).alias("temperature_2m_max"),
        F.transform("d", lambda x: x["tmin"]).alias("temperature_2m_min"),
        F.transform("d", lambda x: x["precip"]).alias("precipitation_sum"),
    ).alias("daily"))
