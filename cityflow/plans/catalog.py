"""Registered queries: each one runs a library operator or plan over whole
driver tables, next to the DuckDB SQL that computes the same result.

Every entry reads the given tables (or what Spark derives from them), so its
work grows with the scale factor. Parameters below are the features being
exercised (reporting windows, series lists), not row caps.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import report_window, window_end, window_start
from ..functions.scalar import exact_round_sum, hour_label, hour_text, normalise_name
from ..operators.aggregate import daily_fact, daily_stats, peak_slot, slot_counts, top_per_group
from ..operators.calendar import numbered_days, spine_between, with_date_key, with_dim
from ..operators.clean import coerce, keep_dates, keep_range, mask_outside, repair_sign, require, union_conformed
from ..operators.fill import fill_ordered, with_file_order_key
from ..operators.nested import parse_json, rows_as_json
from ..operators.quality import alert_rows, between, not_null, report_text, run_suite, summarise
from ..operators.series import daily_change
from ..operators.widen import fold_union, row_total, suffix_columns, widen
from ..operators.zones import assign_zones
from ..session import pin
from . import standins as S
from .air import air_daily, air_fact, clean_readings
from .finance import fx_daily, market_daily, quote_table
from .star import dim_for_span
from .trips import (AMOUNT_CUT, DISTANCE_CUT, GOLD_AMOUNT_CUT, TRIP_MEASURES, TRIP_METRICS, clean_trips,
                    daily_trip_stats, trip_fact)
from .weather import WEATHER_RULES, weather_alerts, weather_silver

# The series of the stand-in tables and the windows used.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
TICKER_NAMES = ["SPY", "Vol_VIX", "XLI", "error", "signup"]
TRIP_START, TRIP_END = dt.date(2024, 1, 5), dt.date(2024, 1, 25)
AIR_START, AIR_END = report_window(dt.date(2024, 6, 15))        # 2024-01-01 .. 2024-04-30
MARKET_START, MARKET_END = report_window(dt.date(2024, 3, 15))  # 2023-10-01 .. 2024-01-31
FLEET_START, FLEET_END = report_window(dt.date(1998, 8, 15))    # 1998-03-01 .. 1998-06-30
DQ_TITLE = "events weather"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def _t(spark, d, name):
    return S.load(spark, d, name)


# ---------------------------------------------------------------- SQL helpers
def r_up(x: str, d: int) -> str:
    """Spark ``round`` (half-up on the decimal form) in DuckDB."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,12)), {d}) AS DOUBLE)"


def r_even(x: str, d: int) -> str:
    """Spark ``bround`` (half-even on the decimal form) in DuckDB."""
    return f"CAST(round_even(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,12)), {d}) AS DOUBLE)"


def fixed2(x: str) -> str:
    """Spark ``format_string('%.2f')`` (half-up) in DuckDB; null stays null."""
    return (f"CASE WHEN ({x}) IS NULL THEN NULL ELSE CAST(CAST(round(CAST(CAST(CAST(({x}) AS DOUBLE) AS VARCHAR) "
            f"AS DECIMAL(38,12)), 2) AS DECIMAL(38,2)) AS VARCHAR) END")


def xsum(x: str) -> str:
    """Sum in decimals."""
    return f"CAST(sum(CAST(({x}) AS DECIMAL(28,10))) AS DOUBLE)"


def xround(x: str, digits: int) -> str:
    """Rounded sum in decimals."""
    return f"CAST(round(sum(CAST(({x}) AS DECIMAL(28,10))), {digits}) AS DOUBLE)"


def xmean(x: str, digits: int, even: bool = False) -> str:
    """Rounded mean of the decimal sum."""
    return f"CAST(round{'_even' * even}(CAST({xsum(x)} / count({x}) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
TRIPS_SQL = f"""trips AS (
  SELECT event_id, ts AS pickup_datetime, event_type AS borough,
         CAST(user_id % 6 AS DOUBLE) AS passenger_count, {K} / 10.0 AS trip_distance,
         value AS total_amount, value * 0.15 AS tip_amount,
         CAST(user_id AS INTEGER) AS PULocationID, CAST({K} AS INTEGER) AS DOLocationID
  FROM events),
silver AS (SELECT *, CAST(pickup_datetime AS DATE) AS "Date", strftime(pickup_datetime, '%H') AS "Time" FROM trips)"""
GOLD_SQL = "WITH " + TRIPS_SQL + """,
gold AS (SELECT *, "Time" || ':00:00' AS formatted_time FROM silver WHERE total_amount > 0 AND total_amount <= 200)"""
READINGS_SQL = """readings AS (
  SELECT user_id AS sensor_id, event_type AS borough, value AS pm_2_5_value, CAST(ts AS DATE) AS date,
         strftime(ts, '%H') || ':00:00' AS time FROM events)"""


def trips_silver(spark, sf):
    t = S.trips_from_events(_t(spark, sf, "events"))
    return t.withColumns({"Date": F.to_date("pickup_datetime"), "Time": hour_text("pickup_datetime", "HH")})


def trips_gold(spark, sf):
    return keep_range(trips_silver(spark, sf), "total_amount", *GOLD_AMOUNT_CUT) \
        .withColumn("formatted_time", hour_label("Time"))


# ---------------------------------------------------------------- trips
@query("trip_hourly_counts", GOLD_SQL + """
SELECT borough, "Date", formatted_time, count(*) AS count FROM gold GROUP BY ALL""")
def trip_hourly_counts(spark, sf):
    return slot_counts(trips_gold(spark, sf), ["borough"], "Date", "formatted_time", "count")


_STATS_SQL = ", ".join([
    "count(*) AS total_trips",
    f"{xmean('total_amount', 2)} AS average_trip_cost",
    f"{xround('total_amount', 2)} AS total_amount_earned",
    f"{xround('tip_amount', 2)} AS total_tips_earned",
    f"{xmean('trip_distance', 2)} AS average_trip_distance",
    f"{xmean('passenger_count', 1)} AS average_passengers",
])


@query("trip_daily_stats", GOLD_SQL + f"""
SELECT borough, "Date", {_STATS_SQL} FROM gold GROUP BY ALL""")
def trip_daily_stats(spark, sf):
    return daily_fact(trips_gold(spark, sf), ["borough"], "Date", "formatted_time", TRIP_MEASURES,
                      count_name="total_trips", peak_name=None)


_PEAK_SQL = """hourly AS (SELECT borough, "Date", formatted_time, count(*) AS n FROM gold GROUP BY ALL),
peak AS (SELECT borough, "Date", formatted_time AS peak_trip_hour FROM (
  SELECT *, row_number() OVER (PARTITION BY borough, "Date" ORDER BY n DESC, formatted_time ASC) AS rk FROM hourly)
  WHERE rk = 1)"""


@query("trip_peak_hour", GOLD_SQL + ",\n" + _PEAK_SQL + "\nSELECT * FROM peak")
def trip_peak_hour(spark, sf):
    counts = slot_counts(trips_gold(spark, sf), ["borough"], "Date", "formatted_time", "n")
    top = top_per_group(counts, ["borough", "Date"], [F.col("n").desc(), F.col("formatted_time").asc()], 1)
    return top.select("borough", "Date", F.col("formatted_time").alias("peak_trip_hour"))


_DAILY_FACT_SQL = GOLD_SQL + ",\n" + _PEAK_SQL + f""",
stats AS (SELECT borough, "Date", {_STATS_SQL} FROM gold GROUP BY ALL),
fact AS (SELECT s.*, p.peak_trip_hour FROM stats s LEFT JOIN peak p USING (borough, "Date"))"""


@query("trip_daily_fact", _DAILY_FACT_SQL + "\nSELECT * FROM fact")
def trip_daily_fact(spark, sf):
    return daily_trip_stats(trips_silver(spark, sf), "borough")


def _wide_sql(select_extra: str) -> str:
    cols = []
    for m in TRIP_METRICS:
        for v in EVENT_TYPES:
            cols.append(f"max(CASE WHEN borough = '{v}' THEN {m} END) AS {m}_{normalise_name(v)}")
    return _DAILY_FACT_SQL + f""",
wide AS (SELECT "Date", {', '.join(cols)} FROM fact GROUP BY "Date")
SELECT * {select_extra} FROM wide"""


def _city_sql() -> str:
    def tot(m):
        return " + ".join(f"coalesce({m}_{v}, 0)" for v in EVENT_TYPES)
    trips = f"CAST({tot('total_trips')} AS BIGINT)"
    amount = r_up(tot("total_amount_earned"), 2)
    return (f", {trips} AS total_trips_New_York, {amount} AS total_amount_earned_New_York, "
            f"{r_up(tot('total_tips_earned'), 2)} AS total_tips_earned_New_York, "
            f"CAST(round(CAST(({amount}) / ({trips}) AS DECIMAL(38,10)), 2) AS DOUBLE) AS average_trip_cost_New_York")


@query("trip_wide_fact", _wide_sql(_city_sql()))
def trip_wide_fact(spark, sf):
    return trip_fact(trips_silver(spark, sf), "borough", values=EVENT_TYPES)


@query("wide_full_join", _wide_sql(""))
def wide_full_join(spark, sf):
    # The fold is for separate tables; the long fact is written once, not computed per series.
    long = pin(daily_trip_stats(trips_silver(spark, sf), "borough"))
    parts = [suffix_columns(long.filter(F.col("borough") == v).drop("borough"), normalise_name(v), "Date")
             for v in EVENT_TYPES]
    return fold_union(parts, "Date")


@query("fleet_union", """
SELECT *, coalesce(tpep_pickup_datetime, lpep_pickup_datetime) AS pickup_datetime FROM (
  SELECT o_orderdate AS tpep_pickup_datetime, o_totalprice AS total_amount FROM orders
  UNION ALL BY NAME
  SELECT l_shipdate AS lpep_pickup_datetime, l_quantity AS trip_distance, l_extendedprice / 100.0 AS total_amount
  FROM lineitem)""")
def fleet_union(spark, sf):
    a = S.fleet_a_from_orders(_t(spark, sf, "orders"))
    b = S.fleet_b_from_lineitem(_t(spark, sf, "lineitem"))
    return union_conformed([a, b], {"pickup_datetime": ["tpep_pickup_datetime", "lpep_pickup_datetime"]})


@query("trip_window_filter", f"""
SELECT lpep_pickup_datetime, trip_distance, total_amount FROM (
  SELECT l_shipdate AS lpep_pickup_datetime, l_quantity AS trip_distance, l_extendedprice / 100.0 AS total_amount
  FROM lineitem)
WHERE lpep_pickup_datetime IS NOT NULL AND trip_distance IS NOT NULL AND total_amount IS NOT NULL
  AND CAST(lpep_pickup_datetime AS DATE) BETWEEN {d(FLEET_START)} AND {d(FLEET_END)}
  AND trip_distance > {DISTANCE_CUT[0]} AND trip_distance <= {DISTANCE_CUT[1]}
  AND total_amount > {AMOUNT_CUT[0]} AND total_amount < {AMOUNT_CUT[1]}""")
def trip_window_filter(spark, sf):
    b = S.fleet_b_from_lineitem(_t(spark, sf, "lineitem"))
    b = require(b, ["lpep_pickup_datetime", "trip_distance", "total_amount"])
    b = keep_dates(b, "lpep_pickup_datetime", FLEET_START, FLEET_END)
    b = keep_range(b, "trip_distance", *DISTANCE_CUT)
    return keep_range(b, "total_amount", *AMOUNT_CUT)


_MASK_FILL_SQL = f"""masked AS (
  SELECT event_id, CASE WHEN CAST(ts AS DATE) BETWEEN {d(TRIP_START)} AND {d(TRIP_END)} THEN ts END AS p FROM events),
filled AS (
  SELECT event_id, coalesce(
    first_value(p IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    last_value(p IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    AS pickup_datetime FROM masked)"""


@query("trip_mask_fill", "WITH " + _MASK_FILL_SQL + "\nSELECT * FROM filled")
def trip_mask_fill(spark, sf):
    t = S.trips_from_events(_t(spark, sf, "events")).select("event_id", "pickup_datetime")
    t = mask_outside(t, "pickup_datetime", TRIP_START, TRIP_END)
    return fill_ordered(t, ["pickup_datetime"], "event_id", directions=("backward", "forward"))


_SPARSE_SQL = _MASK_FILL_SQL


@query("fill_sparse_keys", "WITH " + _SPARSE_SQL + "\nSELECT event_id * 4194304 + 7 AS row_key, pickup_datetime FROM filled")
def fill_sparse_keys(spark, sf):
    """Keys 2^22 apart: every block holds one row, the carry works in levels."""
    t = _t(spark, sf, "events").select((F.col("event_id") * F.lit(4194304) + 7).alias("row_key"), F.col("ts").alias("pickup_datetime"))
    return fill_ordered(mask_outside(t, "pickup_datetime", TRIP_START, TRIP_END), ["pickup_datetime"], "row_key")


@query("fill_file_order", "WITH " + _MASK_FILL_SQL + "\nSELECT * FROM filled")
def fill_file_order(spark, sf):
    """The order is that of the file (the driver's file is in event order)."""
    raw = with_file_order_key(spark.read.parquet(f"{sf}/events.parquet"), "row_id")
    t = mask_outside(raw.select("row_id", "event_id", F.col("ts").alias("pickup_datetime")), "pickup_datetime", TRIP_START, TRIP_END)
    return fill_ordered(t, ["pickup_datetime"], "row_id").drop("row_id")


@query("trip_dedup", "WITH " + TRIPS_SQL + """
SELECT DISTINCT "Date", "Time", passenger_count, trip_distance, total_amount, tip_amount FROM silver""")
def trip_dedup(spark, sf):
    return (trips_silver(spark, sf).drop("PULocationID", "DOLocationID")
            .select("Date", "Time", "passenger_count", "trip_distance", "total_amount", "tip_amount")
            .dropDuplicates())


_ZONES_SQL = """zones AS (SELECT n.n_nationkey AS zone_id, r.r_name AS borough
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@query("zone_membership", "WITH " + _ZONES_SQL + """,
li AS (SELECT row_number() OVER () AS rid, l.l_orderkey, l.l_linenumber, c.c_nationkey AS pu, s.s_nationkey AS do_
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey)
SELECT l_orderkey, l_linenumber, borough FROM (
  SELECT DISTINCT li.rid, li.l_orderkey, li.l_linenumber, z.borough
  FROM li JOIN zones z ON z.zone_id = li.pu OR z.zone_id = li.do_)""")
def zone_membership(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    cust = _t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("pu"))
    supp = _t(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("do_"))
    # Resolve the pickup zone per order first (orders-sized join), so the
    # lineitem-sized stream is shuffled only by order key and by supplier key.
    order_pu = orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "pu")
    trips = (li.join(order_pu, li.l_orderkey == order_pu.o_orderkey)
             .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
             .select("l_orderkey", "l_linenumber", "pu", "do_"))
    zones = region_zones(spark, sf)
    return assign_zones(trips, zones, ["pu", "do_"], out="borough", drop_endpoints=True)


def region_zones(spark, sf):
    nation, region = _t(spark, sf, "nation"), _t(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey) \
        .select(F.col("n_nationkey").alias("zone_id"), F.col("r_name").alias("borough"))


# ---------------------------------------------------------------- readings
@query("reading_sign_repair", """
SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < -10 THEN 0.0 WHEN c_acctbal < 0 THEN abs(c_acctbal)
  ELSE c_acctbal END AS pm_2_5_value FROM customer""")
def reading_sign_repair(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return repair_sign(c.withColumn("pm_2_5_value", F.col("c_acctbal")), "pm_2_5_value")


@query("reading_coerce", """
SELECT event_id, pm_2_5_value, datetime FROM (
  SELECT event_id,
    CASE WHEN isnan(try_cast(v AS DOUBLE)) THEN NULL ELSE try_cast(v AS DOUBLE) END AS pm_2_5_value,
    try_cast(t AS TIMESTAMP) AS datetime
  FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS v,
               CASE WHEN event_type = 'signup' THEN 'not a time' ELSE CAST(ts AS VARCHAR) END AS t FROM events))
WHERE pm_2_5_value IS NOT NULL AND datetime IS NOT NULL""")
def reading_coerce(spark, sf):
    e = _t(spark, sf, "events")
    raw = e.select("event_id",
                   F.when(F.col("event_type") == "error", F.lit("n/a"))
                   .otherwise(F.col("value").cast("string")).alias("pm_2_5_value"),
                   F.when(F.col("event_type") == "signup", F.lit("not a time"))
                   .otherwise(F.col("ts").cast("string")).alias("datetime"))
    return coerce(raw, {"pm_2_5_value": "double", "datetime": "timestamp"})


@query("reading_daily", "WITH " + READINGS_SQL + f"""
SELECT borough, date, {xmean('pm_2_5_value', 1, True)} AS avg_value_pm2_5, max(pm_2_5_value) AS peak_value_pm2_5
FROM readings GROUP BY ALL""")
def reading_daily(spark, sf):
    r = S.readings_from_events(_t(spark, sf, "events"))
    return daily_stats(r, ["borough"], "date", "pm_2_5_value", mean="avg_value_pm2_5", peak="peak_value_pm2_5",
                       mean_digits=1, half_even=True)


@query("reading_peak_rows", "WITH " + READINGS_SQL + """,
mx AS (SELECT borough, date, max(pm_2_5_value) AS peak_value_pm2_5 FROM readings GROUP BY ALL)
SELECT r.borough, r.date, m.peak_value_pm2_5, min(r.time) AS peak_value_hour
FROM readings r JOIN mx m ON r.borough = m.borough AND r.date = m.date AND r.pm_2_5_value = m.peak_value_pm2_5
GROUP BY ALL""")
def reading_peak_rows(spark, sf):
    r = S.readings_from_events(_t(spark, sf, "events"))
    return peak_slot(r, ["borough"], "date", "time", score="pm_2_5_value", out="peak_value_hour",
                     peak_value="peak_value_pm2_5")


def _dense_sql(series: str, start=AIR_START, end=AIR_END) -> str:
    return "WITH " + READINGS_SQL + f""",
stats AS (SELECT {series}, date, {xmean('pm_2_5_value', 1, True)} AS a, max(pm_2_5_value) AS p FROM readings
          WHERE date BETWEEN {d(start)} AND {d(end)} GROUP BY ALL),
peak AS (SELECT r.{series}, r.date, min(r.time) AS h FROM readings r JOIN stats s
         ON r.{series} = s.{series} AND r.date = s.date AND r.pm_2_5_value = s.p GROUP BY ALL),
grid AS (SELECT k.{series}, CAST(g.day AS DATE) AS date FROM (SELECT DISTINCT {series} FROM readings) k,
         generate_series(TIMESTAMP '{start} 00:00:00', TIMESTAMP '{end} 00:00:00', INTERVAL 1 DAY) g(day)),
j AS (SELECT g.{series}, g.date, s.a, s.p, pk.h FROM grid g LEFT JOIN stats s USING ({series}, date)
      LEFT JOIN peak pk USING ({series}, date)),
f AS (SELECT {series}, date,
  coalesce(last_value(a IGNORE NULLS) OVER w1, first_value(a IGNORE NULLS) OVER w2) AS a,
  coalesce(last_value(p IGNORE NULLS) OVER w1, first_value(p IGNORE NULLS) OVER w2) AS p,
  coalesce(last_value(h IGNORE NULLS) OVER w1, first_value(h IGNORE NULLS) OVER w2) AS h
  FROM j WINDOW w1 AS (PARTITION BY {series} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                w2 AS (PARTITION BY {series} ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
"""


def _dense_select(series: str) -> str:
    return (f"SELECT {series}, date, a AS avg_value_pm2_5, p AS peak_value_pm2_5, "
            f"coalesce(h, '00:00:00') AS peak_value_hour FROM f")


@query("reading_dense", _dense_sql("sensor_id") + _dense_select("sensor_id"))
def reading_dense(spark, sf):
    return air_daily(S.readings_from_events(_t(spark, sf, "events")), AIR_START, AIR_END, series="sensor_id")


@query("reading_union", _dense_sql("borough") + _dense_select("borough"))
def reading_union(spark, sf):
    """Two sensor tables pooled as rows."""
    r = S.readings_from_events(_t(spark, sf, "events"))
    return air_daily([r.where("sensor_id % 2 = 0"), r.where("sensor_id % 2 <> 0")], AIR_START, AIR_END, series="borough")


LATE_START, LATE_END = dt.date(2024, 1, 28), dt.date(2024, 2, 20)


@query("reading_dense_late", _dense_sql("sensor_id", LATE_START, LATE_END) + _dense_select("sensor_id"))
def reading_dense_late(spark, sf):
    """A window that many sensors have no reading in: they get the calendar with null values."""
    return air_daily(S.readings_from_events(_t(spark, sf, "events")), LATE_START, LATE_END, series="sensor_id")


def _dense_keyed_sql() -> str:
    sql = _dense_sql("sensor_id").replace(
        "(SELECT DISTINCT sensor_id FROM readings) k", "(SELECT c_custkey AS sensor_id FROM customer) k")
    return sql + _dense_select("sensor_id")


@query("reading_dense_keyed", _dense_keyed_sql())
def reading_dense_keyed(spark, sf):
    """Every registered sensor (customer keys as the sensor dimension) gets
    the whole calendar; sensors without readings keep null values and the
    default hour."""
    r = keep_dates(S.readings_from_events(_t(spark, sf, "events")), "date", AIR_START, AIR_END)
    sensors = _t(spark, sf, "customer").select(F.col("c_custkey").alias("sensor_id"))
    return air_daily(r, AIR_START, AIR_END, series="sensor_id", keys=sensors)


def _air_combine_sql() -> str:
    cols, avgs, peaks = [], [], []
    for m in ["avg_value_pm2_5", "peak_value_pm2_5", "peak_value_hour"]:
        for v in EVENT_TYPES:
            cols.append(f"max(CASE WHEN borough = '{v}' THEN {m} END) AS {m}_{v}")
    avgs = " + ".join(f"avg_value_pm2_5_{v}" for v in EVENT_TYPES)
    peaks = ", ".join(f"peak_value_pm2_5_{v}" for v in EVENT_TYPES)
    return (_dense_sql("borough") + ", dense AS (" + _dense_select("borough") + ")" +
            f", wide AS (SELECT date, {', '.join(cols)} FROM dense GROUP BY date)\n"
            f"SELECT *, {r_up(f'({avgs}) / {float(len(EVENT_TYPES))}', 1)} AS NYC_avg_value_pm2_5, "
            f"greatest({peaks}) AS NYC_peak_value_pm2_5 FROM wide")


@query("air_combine", _air_combine_sql())
def air_combine(spark, sf):
    r = S.readings_from_events(_t(spark, sf, "events"))
    return air_fact(air_daily(r, AIR_START, AIR_END, series="borough"), "borough", values=EVENT_TYPES)


@query("reading_clean", f"""
SELECT event_id, sensor_id, 'pm25' AS name,
  CASE WHEN v < -10 THEN 0.0 WHEN v < 0 THEN abs(v) ELSE v END AS pm_2_5_value, 'µg/m³' AS units,
  CAST(t AS DATE) AS date, strftime(t, '%H') || ':00:00' AS time
FROM (SELECT event_id, user_id AS sensor_id, CAST(CAST({K} AS INTEGER) - 20 AS DOUBLE) AS v,
             CASE WHEN event_type <> 'signup' THEN date_trunc('second', ts) END AS t FROM events)
WHERE v IS NOT NULL AND t IS NOT NULL""")
def reading_clean(spark, sf):
    raw = S.raw_readings_from_events(_t(spark, sf, "events"))
    return clean_readings(raw, keep=["event_id", "sensor_id"])


# ---------------------------------------------------------------- finance
@query("fx_midpoint", f"""
WITH rates AS (SELECT CAST(ts AS DATE) AS "Date", (max(value) + min(value)) / 2.0 AS r FROM events GROUP BY 1),
grid AS (SELECT CAST(g.day AS DATE) AS "Date"
         FROM generate_series(TIMESTAMP '{AIR_START} 00:00:00', TIMESTAMP '{AIR_END} 00:00:00', INTERVAL 1 DAY) g(day)),
j AS (SELECT g."Date", r.r FROM grid g LEFT JOIN rates r USING ("Date"))
SELECT "Date", coalesce(last_value(r IGNORE NULLS) OVER (ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(r IGNORE NULLS) OVER (ORDER BY "Date" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS Exchange_Rate
FROM j""")
def fx_midpoint(spark, sf):
    e = _t(spark, sf, "events")
    bronze = e.groupBy(F.to_date("ts").alias("Date")).agg(F.max("value").alias("High"), F.min("value").alias("Low"))
    return fx_daily(bronze, AIR_START, AIR_END)


@query("fx_empty_window", """
SELECT CAST(g.day AS DATE) AS "Date", CAST(NULL AS DOUBLE) AS Exchange_Rate
FROM generate_series(TIMESTAMP '2031-01-01 00:00:00', TIMESTAMP '2031-03-31 00:00:00', INTERVAL 1 DAY) g(day)
WHERE NOT EXISTS (SELECT 1 FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2031-01-01' AND DATE '2031-03-31')""")
def fx_empty_window(spark, sf):
    e = _t(spark, sf, "events").select(F.col("ts").alias("Date"), F.col("value").alias("High"), F.col("value").alias("Low"))
    return fx_daily(e, dt.date(2031, 1, 1), dt.date(2031, 3, 31))


# The driver's events end in January 2024: the window holds days with many raw rows, days without any, and a null rate.
RAW_START, RAW_END = dt.date(2024, 1, 20), dt.date(2024, 2, 20)


@query("fx_raw_window", f"""
WITH rates AS (SELECT CAST(ts AS DATE) AS "Date", CASE WHEN event_type <> 'signup' THEN (value + value / 2.0) / 2.0 END AS r FROM events
               WHERE CAST(ts AS DATE) BETWEEN {d(RAW_START)} AND {d(RAW_END)}),
grid AS (SELECT CAST(g.day AS DATE) AS "Date"
         FROM generate_series(TIMESTAMP '{RAW_START} 00:00:00', TIMESTAMP '{RAW_END} 00:00:00', INTERVAL 1 DAY) g(day)),
days AS (SELECT g."Date", max(r) AS r, count(x."Date") AS n FROM grid g LEFT JOIN rates x ON g."Date" = x."Date" GROUP BY 1),
f AS (SELECT "Date", n, coalesce(last_value(r IGNORE NULLS) OVER (ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(r IGNORE NULLS) OVER (ORDER BY "Date" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS r FROM days)
SELECT rates."Date", coalesce(rates.r, f.r) AS Exchange_Rate FROM rates JOIN f USING ("Date")
UNION ALL SELECT "Date", r FROM f WHERE n = 0""")
def fx_raw_window(spark, sf):
    """Raw rows, many a day, in a window that they cover in part."""
    e = _t(spark, sf, "events").select(F.col("ts").alias("Date"), F.when(F.col("event_type") != "signup", F.col("value")).alias("High"),
                                       (F.col("value") / 2.0).alias("Low"))
    return fx_daily(e, RAW_START, RAW_END)


_QUOTES_SQL = """quotes AS (
  SELECT CAST(ts AS DATE) AS "Date",
         CASE event_type WHEN 'view' THEN 'Vol_VIX' WHEN 'purchase' THEN 'SPY' WHEN 'click' THEN 'XLI'
              ELSE event_type END AS ticker,
         arg_max(value, ts) AS "Close"
  FROM events GROUP BY ALL)"""


@query("quote_pivot", "WITH " + _QUOTES_SQL + "\nSELECT \"Date\", " + ", ".join(
    f"max(CASE WHEN ticker = '{t}' THEN \"Close\" END) AS {t}" for t in TICKER_NAMES) + " FROM quotes GROUP BY 1")
def quote_pivot(spark, sf):
    return quote_table(S.quotes_from_events(_t(spark, sf, "events")), values=TICKER_NAMES)


@query("market_daily", "WITH " + _QUOTES_SQL + f""",
grid AS (SELECT k.ticker, CAST(g.day AS DATE) AS "Date" FROM (SELECT DISTINCT ticker FROM quotes) k,
         generate_series(TIMESTAMP '{MARKET_START} 00:00:00', TIMESTAMP '{MARKET_END} 00:00:00', INTERVAL 1 DAY) g(day)),
j AS (SELECT g.ticker, g."Date", q."Close" FROM grid g LEFT JOIN quotes q USING (ticker, "Date")),
f AS (SELECT ticker, "Date", coalesce(
    last_value("Close" IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value("Close" IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY "Date" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    AS c FROM j),
ch AS (SELECT *, coalesce(c - lag(c) OVER (PARTITION BY ticker ORDER BY "Date"), 0.0) AS change FROM f)
SELECT "Date", max(CASE WHEN ticker = 'Vol_VIX' THEN c END) AS vol_vix,
  max(CASE WHEN ticker = 'SPY' THEN change END) AS spy_daily_change,
  max(CASE WHEN ticker = 'XLI' THEN change END) AS xli_daily_change
FROM ch GROUP BY 1""")
def market(spark, sf):
    return market_daily(S.quotes_from_events(_t(spark, sf, "events")), MARKET_START, MARKET_END)


@query("daily_change", f"""
WITH daily AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS "Date", {xround('o_totalprice', 2)} AS close
               FROM orders GROUP BY ALL)
SELECT *, coalesce(close - lag(close) OVER (PARTITION BY o_orderstatus ORDER BY "Date"), 0.0) AS change FROM daily""")
def daily_change_q(spark, sf):
    o = _t(spark, sf, "orders")
    daily = o.groupBy("o_orderstatus", F.to_date("o_orderdate").alias("Date")) \
        .agg(exact_round_sum("o_totalprice", 2).alias("close"))
    return daily_change(daily, "close", "Date", by=["o_orderstatus"], out="change")


# ---------------------------------------------------------------- nested + quality
_WEATHER_SQL = """wdaily AS (SELECT event_type AS station, CAST(ts AS DATE) AS day, max(value) / 10.0 AS tmax,
  min(value) / 10.0 AS tmin, """ + xsum("value") + """ / 100.0 AS precip FROM events GROUP BY ALL),
wsilver AS (SELECT station, strftime(day, '%Y-%m-%d') AS time, CAST(tmax AS FLOAT) AS temperature_2m_max,
  CAST(tmin AS FLOAT) AS temperature_2m_min, CAST(precip AS FLOAT) AS precipitation_sum FROM wdaily)"""


def weather_rows(spark, sf):
    return weather_silver(S.weather_docs_from_events(_t(spark, sf, "events")), keep=["station"])


@query("doc_arrays_to_rows", "WITH " + _WEATHER_SQL + "\nSELECT * FROM wsilver")
def doc_arrays_to_rows(spark, sf):
    return weather_rows(spark, sf)


@query("doc_json_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def doc_json_fields(spark, sf):
    e = parse_json(_t(spark, sf, "events"), "props", "k INT", out="doc")
    return e.select("event_id", F.col("doc.k").alias("k"))


@query("row_json", """
SELECT CAST(to_json(struct_pack(c_custkey := c_custkey, c_name := c_name, c_acctbal := c_acctbal)) AS VARCHAR) AS json
FROM customer""")
def row_json(spark, sf):
    return rows_as_json(_t(spark, sf, "customer"), ["c_custkey", "c_name", "c_acctbal"])


EVENT_RULES = [not_null("ts"), between("value", 0, 300), not_null("props"), between("user_id", 0, 1000)]


def _rules_sql(rules, table: str) -> str:
    parts = []
    for i, r in enumerate(rules):
        if r.lo is None and r.hi is None:
            bad = f"{r.column} IS NULL"
        else:
            conds = ([f"{r.column} < {r.lo}"] if r.lo is not None else []) + \
                    ([f"{r.column} > {r.hi}"] if r.hi is not None else [])
            bad = f"{r.column} IS NOT NULL AND ({' OR '.join(conds)})"
        parts.append(f"SELECT {i} AS rule_index, '{r.name}' AS rule, '{r.column}' AS \"column\", count(*) AS element_count, "
                     f"count(*) FILTER (WHERE {bad}) AS unexpected_count FROM {table}")
    return "(" + " UNION ALL ".join(parts) + ")"


@query("dq_rules", "SELECT *, unexpected_count = 0 AS success FROM " + _rules_sql(EVENT_RULES, "events"))
def dq_rules(spark, sf):
    return run_suite(_t(spark, sf, "events"), EVENT_RULES)


@query("dq_summary", "WITH " + _WEATHER_SQL + f""",
res AS (SELECT *, unexpected_count = 0 AS success FROM {_rules_sql(WEATHER_RULES, 'wsilver')}),
s AS (SELECT count_if(NOT success) = 0 AS success, 100.0 * (count(*) - count_if(NOT success)) / count(*) AS success_percent,
  CAST(count(*) AS INTEGER) AS evaluated_expectations, CAST(count_if(NOT success) AS INTEGER) AS unsuccessful_expectations FROM res)
SELECT *, '**Data Quality report for {DQ_TITLE}**' || chr(10) || '**Status:** ' || CASE WHEN success THEN 'PASSED' ELSE 'FAILED' END
  || chr(10) || '**Success Rate:** ' || printf('%.1f', success_percent) || '%' || chr(10) || '**Checks Run:** '
  || evaluated_expectations || chr(10) || '**Failures:** ' || unsuccessful_expectations AS report FROM s""")
def dq_summary(spark, sf):
    return report_text(summarise(run_suite(weather_rows(spark, sf), WEATHER_RULES)), DQ_TITLE)


@query("alert_latest", f"""
WITH daily AS (SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS time, max(value) AS temperature_2m_max,
  min(value) AS temperature_2m_min, {xround('value', 2)} AS precipitation_sum FROM events GROUP BY 1)
SELECT time, {fixed2('temperature_2m_max')} AS temperature_2m_max, {fixed2('temperature_2m_min')} AS temperature_2m_min,
  {fixed2('precipitation_sum')} AS precipitation_sum FROM daily ORDER BY time DESC LIMIT 2""")
def alert_latest(spark, sf):
    e = _t(spark, sf, "events")
    daily = e.groupBy(F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("time")).agg(
        F.max("value").alias("temperature_2m_max"), F.min("value").alias("temperature_2m_min"),
        exact_round_sum("value", 2).alias("precipitation_sum"))
    return alert_rows(daily, "time", ["temperature_2m_max", "temperature_2m_min", "precipitation_sum"], k=2)


@query("weather_alert", "WITH " + _WEATHER_SQL + f"""
SELECT station, time, {fixed2('temperature_2m_max')} AS temperature_2m_max, {fixed2('temperature_2m_min')} AS temperature_2m_min,
  {fixed2('precipitation_sum')} AS precipitation_sum FROM (
  SELECT *, row_number() OVER (PARTITION BY station ORDER BY time DESC) AS rk FROM wsilver) WHERE rk <= 2""")
def weather_alert(spark, sf):
    return weather_alerts(weather_rows(spark, sf), by=["station"])


# ---------------------------------------------------------------- calendar + star
_SPAN_SQL = """span AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e FROM orders),
days AS (SELECT CAST(g.day AS DATE) AS date FROM span, generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY) g(day))"""
_DIM_SQL = _SPAN_SQL + """,
dim AS (SELECT date AS DateKey, CAST(year(date) AS INTEGER) AS "Year", CAST(month(date) AS INTEGER) AS "Month",
  monthname(date) AS MonthName, dayname(date) AS DayOfWeek FROM days)"""


def _order_span(spark, sf):
    o = _t(spark, sf, "orders")
    return o.agg(F.min(F.to_date("o_orderdate")).alias("s"), F.max(F.to_date("o_orderdate")).alias("e"))


@query("date_spine", "WITH " + _SPAN_SQL + """
SELECT date, strftime(date, '%Y-%m-%d') AS date_text, 'orders' AS source FROM days""")
def date_spine_q(spark, sf):
    days = spine_between(_order_span(spark, sf), "s", "e", "date")
    return days.select("date", F.date_format("date", "yyyy-MM-dd").alias("date_text"), F.lit("orders").alias("source"))


@query("report_window", """
SELECT o_orderkey, date_trunc('month', CAST(o_orderdate AS DATE) - INTERVAL 5 MONTH)::DATE AS window_start,
  last_day(CAST(o_orderdate AS DATE) - INTERVAL 2 MONTH)::DATE AS window_end FROM orders""")
def report_window_q(spark, sf):
    o = _t(spark, sf, "orders")
    as_of = F.to_date("o_orderdate")
    return o.select("o_orderkey", window_start(as_of).alias("window_start"), window_end(as_of).alias("window_end"))


@query("dim_date", "WITH " + _DIM_SQL + "\nSELECT * FROM dim")
def dim_date_q(spark, sf):
    return dim_for_span(_t(spark, sf, "orders"), "o_orderdate")


@query("fact_with_key", "SELECT CAST(o_orderdate AS DATE) AS DateKey, * FROM orders")
def fact_with_key(spark, sf):
    return with_date_key(_t(spark, sf, "orders"), "o_orderdate")


@query("star_join", "WITH " + _DIM_SQL + f""",
fact AS (SELECT CAST(o_orderdate AS DATE) AS DateKey, count(*) AS order_count,
  {xround('o_totalprice', 2)} AS total_price FROM orders GROUP BY 1)
SELECT f.DateKey, f.order_count, f.total_price, dim."Year", dim."Month", dim.MonthName, dim.DayOfWeek
FROM fact f LEFT JOIN dim ON f.DateKey = dim.DateKey""")
def star_join(spark, sf):
    o = _t(spark, sf, "orders")
    fact = o.groupBy(F.to_date("o_orderdate").alias("DateKey")).agg(
        F.count(F.lit(1)).alias("order_count"), exact_round_sum("o_totalprice", 2).alias("total_price"))
    return with_dim(fact, dim_for_span(o, "o_orderdate"), on="DateKey", how="left")


@query("sequence_numbers", "WITH " + _SPAN_SQL + """
SELECT CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS n, date FROM days""")
def sequence_numbers(spark, sf):
    return numbered_days(_order_span(spark, sf), "s", "e", n="n", col="date")


# ---------------------------------------------------------------- composites
_ZONES_CUST_SQL = """czones AS (SELECT CAST(c.c_custkey AS INTEGER) AS zone_id, r.r_name AS borough
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@query("trip_clean", "WITH " + TRIPS_SQL + f""",
masked AS (SELECT *, CASE WHEN CAST(pickup_datetime AS DATE) BETWEEN {d(TRIP_START)} AND {d(TRIP_END)}
                     THEN pickup_datetime END AS p FROM trips),
filled AS (SELECT *, coalesce(
    first_value(p IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    last_value(p IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS pf
  FROM masked),
cleaned AS (SELECT DISTINCT CAST(pf AS DATE) AS "Date", strftime(pf, '%H') AS "Time", passenger_count, trip_distance,
    DOLocationID, PULocationID, total_amount, tip_amount FROM filled
  WHERE pf IS NOT NULL AND trip_distance IS NOT NULL AND total_amount IS NOT NULL
    AND CAST(pf AS DATE) BETWEEN {d(TRIP_START)} AND {d(TRIP_END)}
    AND trip_distance > {DISTANCE_CUT[0]} AND trip_distance <= {DISTANCE_CUT[1]}
    AND total_amount > {AMOUNT_CUT[0]} AND total_amount < {AMOUNT_CUT[1]}),
""" + _ZONES_CUST_SQL + """
SELECT "Date", "Time", passenger_count, trip_distance, total_amount, tip_amount, borough FROM (
  SELECT DISTINCT s.*, z.borough FROM cleaned s JOIN czones z ON z.zone_id = s.PULocationID OR z.zone_id = s.DOLocationID)""")
def trip_clean(spark, sf):
    raw = S.trips_from_events(_t(spark, sf, "events"))
    return clean_trips(raw, TRIP_START, TRIP_END, order="event_id", zones=customer_zones(spark, sf))


def customer_zones(spark, sf):
    """Zone id -> borough for the trip stand-in: customer key -> region name."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return c.join(region_zones(spark, sf), c.c_nationkey == F.col("zone_id")) \
        .select(F.col("c_custkey").cast("int").alias("zone_id"), "borough")


# The region names of the driver's region table, the series of the report.
REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _sanitized_sql() -> str:
    cols = ", ".join(f"max(CASE WHEN borough = '{r}' THEN acctbal END) AS acctbal_{normalise_name(r)}"
                     for r in REGION_NAMES)
    total = " + ".join(f"coalesce(acctbal_{normalise_name(r)}, 0)" for r in REGION_NAMES)
    return "WITH " + _ZONES_SQL + f""",
per AS (SELECT c_mktsegment, z.borough, {xround('c_acctbal', 2)} AS acctbal
        FROM customer c JOIN zones z ON c.c_nationkey = z.zone_id GROUP BY ALL),
wide AS (SELECT c_mktsegment, {cols} FROM per GROUP BY 1)
SELECT *, {r_up(total, 2)} AS acctbal_total FROM wide"""


@query("sanitized_names", _sanitized_sql())
def sanitized_names(spark, sf):
    c = _t(spark, sf, "customer")
    z = region_zones(spark, sf)
    per = (c.join(z, c.c_nationkey == z.zone_id)
           .groupBy("c_mktsegment", "borough").agg(exact_round_sum("c_acctbal", 2).alias("acctbal")))
    wide = widen(per, "c_mktsegment", "borough", ["acctbal"], REGION_NAMES)
    return row_total(wide, [x for x in wide.columns if x.startswith("acctbal_")], "acctbal_total", 2)
