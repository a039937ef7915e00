"""End to end on reference-shaped inputs written as files (not the stand-ins)."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from cityflow.operators.zones import zone_table
from cityflow.plans.air import air_daily, air_fact, clean_readings
from cityflow.plans.finance import fx_daily, market_daily
from cityflow.plans.trips import clean_trips, raw_trips, trip_fact
from cityflow.sources.readers import scan_many

T = dt.datetime


def test_taxi_files_to_wide_fact(spark, scratch):
    a = [(T(2024, 2, 3, 8, 5), 1.0, 2.0, 1, 2, 20.0, 3.0),      # Bronx -> Queens: both boroughs
         (T(2024, 2, 3, 8, 30), 2.0, 1.0, 1, 1, 12.0, 1.0),     # Bronx only
         (T(2023, 12, 31, 9, 0), 1.0, 3.0, 2, 2, 30.0, 0.0)]    # outside window: last in file order, so
    # it takes the previous trip's time (files are numbered by path: green before yellow)
    b = [(T(2024, 2, 4, 17, 0), 1.0, 4.0, 2, 9, 40.0, 5.0),     # Queens + unmapped
         (None, 1.0, 4.0, 1, 2, 600.0, 0.0)]                   # amount above the silver cut
    cols = "passenger_count double, trip_distance double, PULocationID int, DOLocationID int, " \
           "total_amount double, tip_amount double"
    spark.createDataFrame(a, "tpep_pickup_datetime timestamp, " + cols).coalesce(1) \
        .write.parquet(os.path.join(scratch, "raw", "yellow"))
    spark.createDataFrame(b, "lpep_pickup_datetime timestamp, " + cols).coalesce(1) \
        .write.parquet(os.path.join(scratch, "raw", "green"))
    raw = raw_trips(spark, [os.path.join(scratch, "raw", "yellow"), os.path.join(scratch, "raw", "green")])
    zones = zone_table(spark, {"Bronx": [1], "Queens": [2]})
    silver = clean_trips(raw, dt.date(2024, 2, 1), dt.date(2024, 5, 31), order="row_id", zones=zones)
    per = {(r.borough, str(r.Date)) : r["count"] for r in silver.groupBy("borough", "Date").count().collect()}
    assert per == {("Bronx", "2024-02-03"): 2, ("Queens", "2024-02-03"): 2, ("Queens", "2024-02-04"): 1}
    fact = trip_fact(silver, values=["Bronx", "Queens"]).collect()
    assert [str(r.Date) for r in fact] == ["2024-02-03", "2024-02-04"]
    d1 = fact[0]
    assert (d1.total_trips_Bronx, d1.total_trips_Queens, d1.total_trips_New_York) == (2, 2, 4)
    assert d1.peak_trip_hour_Bronx == "08:00:00" and d1.total_amount_earned_Bronx == 32.0
    assert d1.total_amount_earned_Queens == 50.0 and d1.average_trip_cost_New_York == 20.5
    assert fact[1].total_trips_Bronx is None and fact[1].total_trips_New_York == 1


def _records(sensor_values):
    out = []
    for ts, v in sensor_values:
        out.append({"period": {"datetimeFrom": {"utc": ts}}, "parameter": {"name": "pm25", "units": "ug/m3"},
                    "value": v})
    return out


def test_sensor_folders_to_air_fact(spark, scratch):
    folders = {
        "OpenAQ_Bronx_1": [("2024-02-01T03:00:00Z", "5.0"), ("2024-02-01T09:00:00Z", "-3.0"),
                           ("bad time", "7.0")],
        "OpenAQ_Bronx_2": [("2024-02-01T04:00:00Z", "9.0"), ("2024-02-03T01:00:00Z", "abc")],
        "OpenAQ_Queens_1": [("2024-02-02T05:00:00Z", "-20.0")],
    }
    for name, vals in folders.items():
        os.makedirs(os.path.join(scratch, "bronze", name))
        with open(os.path.join(scratch, "bronze", name, "part.json"), "w") as f:
            f.write("\n".join(json.dumps(r) for r in _records(vals)))
    schema = ("period struct<datetimeFrom: struct<utc: string>>, parameter struct<name: string, units: string>, "
              "value string")
    bronze = scan_many(spark, os.path.join(scratch, "bronze"), fmt="json", origin_col="sensor", schema=schema)
    bronze = bronze.withColumn("borough", F.regexp_extract("sensor", "OpenAQ_([A-Za-z]+)_", 1))
    silver = clean_readings(bronze, keep=["borough"])
    assert silver.count() == 4  # bad time and bad value dropped
    dense = air_daily(silver, dt.date(2024, 2, 1), dt.date(2024, 2, 3))
    fact = air_fact(dense, values=["Bronx", "Queens"]).collect()
    assert len(fact) == 3
    d1 = fact[0]
    # Bronx pooled: 5.0, |-3.0| = 3.0, 9.0 -> mean 5.7 (half-even), peak 9.0 at 04:00:00
    assert (d1.avg_value_pm2_5_Bronx, d1.peak_value_pm2_5_Bronx, d1.peak_value_hour_Bronx) == (5.7, 9.0, "04:00:00")
    # Queens: -20 -> 0.0, back-filled to day 1; city mean over both series
    assert d1.avg_value_pm2_5_Queens == 0.0 and d1.NYC_avg_value_pm2_5 == 2.9 and d1.NYC_peak_value_pm2_5 == 9.0


def test_fx_and_market_series(spark):
    bronze = spark.createDataFrame([(T(2024, 2, 2), 1.10, 1.08), (T(2024, 2, 5), 1.12, 1.10)],
                                   "Date timestamp, High double, Low double")
    fx = fx_daily(bronze, dt.date(2024, 2, 1), dt.date(2024, 2, 6)).collect()
    assert [round(r.Exchange_Rate, 4) for r in fx] == [1.09, 1.09, 1.09, 1.09, 1.11, 1.11]
    quotes = spark.createDataFrame(
        [(dt.date(2024, 2, 2), t, v) for t, v in (("^VIX", 14.0), ("SPY", 500.0), ("XLI", 120.0))] +
        [(dt.date(2024, 2, 5), t, v) for t, v in (("^VIX", 15.0), ("SPY", 505.0), ("XLI", 119.0))],
        "Date date, ticker string, Close double")
    m = market_daily(quotes, dt.date(2024, 2, 1), dt.date(2024, 2, 5)).collect()
    assert [r.spy_daily_change for r in m] == [0.0, 0.0, 0.0, 0.0, 5.0]
    assert [r.vol_vix for r in m] == [14.0, 14.0, 14.0, 14.0, 15.0]
