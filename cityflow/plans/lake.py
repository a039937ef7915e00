"""Registered queries of sources, sinks, checks and exact totals: most write given tables below the shared folder, go through a reader or writer of the
library, and return what is there afterwards, next to the DuckDB SQL of the
same rows.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import exact_round_sum, hour_text
from ..operators.clean import keep_dates
from ..operators.exact import exact_totals
from ..operators.fill import with_file_order_key
from ..operators.numbering import with_dense_number
from ..operators.quality import checked_write, failed_names, rule_mask
from ..operators.series import densify
from ..session import ensure_checkpoint_dir
from ..sources.landing import DIGEST, append_distinct, land_new_files
from ..sources.readers import scan_documents, scan_many, scan_merged, scan_table
from ..sources.rescue import REASON, RECORD, scan_records, split_records
from ..sources.writers import export_json, fan_out, overwrite, replace_window
from . import standins as S
from .catalog import EVENT_RULES, FLEET_END, FLEET_START, TRIPS_SQL, _rules_sql, d, trips_silver, xround
from .star import refresh_star
from .weather import weather_gold, weather_silver

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    def register(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn
    return register


def _fresh(spark: SparkSession, name: str) -> str:
    """A fresh folder every node can see."""
    return f"{ensure_checkpoint_dir(spark)}/lake/{name}-{uuid.uuid4().hex}"


def _events(spark, sf) -> DataFrame:
    return S.load(spark, sf, "events")


# ------------------------------------------------------------ replace
@query("folder_replace", """
SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus <> 'F'""")
def folder_replace(spark, sf):
    """A folder replaced twice by queries that read it, then by an empty input that is skipped."""
    path = _fresh(spark, "folder") + "/orders"
    overwrite(S.load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    overwrite(scan_table(spark, path).where("o_orderstatus <> 'F'"), path)
    overwrite(scan_table(spark, path).withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    overwrite(scan_table(spark, path).where("o_orderkey is null"), path, skip_if_empty=True)
    return scan_table(spark, path)


@query("table_replace", """
SELECT c_custkey, c_name, CAST(c_acctbal >= 0 AS INTEGER) AS solvent FROM customer""")
def table_replace(spark, sf):
    """A catalog table replaced by itself, first with the same columns (its location is switched), then with others (K2)."""
    name, location = f"customer_{uuid.uuid4().hex}", _fresh(spark, "table")
    overwrite(S.load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), name, location=location)
    overwrite(spark.table(name).withColumn("c_name", F.concat(F.lit("x"), "c_name")), name, location=location)
    overwrite(spark.table(name).select("c_custkey", F.substring("c_name", 2, 1 << 20).alias("c_name"), (F.col("c_acctbal") >= 0).cast("int").alias("solvent")),
              name, location=location)
    return scan_table(spark, name)


@query("star_refresh", f"""
WITH dim AS (SELECT CAST(g.day AS DATE) AS DateKey, CAST(month(g.day) AS INTEGER) AS "Month", dayname(g.day) AS DayOfWeek
             FROM generate_series(TIMESTAMP '{FLEET_START} 00:00:00', TIMESTAMP '{FLEET_END} 00:00:00', INTERVAL 1 DAY) g(day)),
o AS (SELECT CAST(o_orderdate AS DATE) AS k, count(*) AS orders, {xround('o_totalprice', 2)} AS total FROM orders GROUP BY 1),
l AS (SELECT CAST(l_shipdate AS DATE) AS k, count(*) AS lines FROM lineitem GROUP BY 1)
SELECT DateKey, "Month", DayOfWeek, orders, total, lines FROM dim LEFT JOIN o ON DateKey = o.k LEFT JOIN l ON DateKey = l.k""")
def star_refresh(spark, sf):
    """Dimension and two facts refreshed as one unit, twice, then read back as a star."""
    location, tag = _fresh(spark, "star"), uuid.uuid4().hex
    dim, one, two = f"dim_{tag}", f"orders_{tag}", f"lines_{tag}"
    orders = keep_dates(S.load(spark, sf, "orders"), "o_orderdate", FLEET_START, FLEET_END)
    lines = keep_dates(S.load(spark, sf, "lineitem"), "l_shipdate", FLEET_START, FLEET_END)
    facts = {one: (orders.groupBy(F.to_date("o_orderdate").alias("Date")).agg(F.count("*").alias("orders"), exact_round_sum("o_totalprice", 2).alias("total")), "Date"),
             two: (lines.groupBy(F.to_date("l_shipdate").alias("Date")).agg(F.count("*").alias("lines")), "Date")}
    for _ in range(2):
        refresh_star(spark, facts, start=FLEET_START, end=FLEET_END, dim=dim, location=location)
    star = spark.table(dim).join(spark.table(one).drop("Date"), "DateKey", "left").join(spark.table(two).drop("Date"), "DateKey", "left")
    return star.select("DateKey", "Month", "DayOfWeek", "orders", "total", "lines")


@query("window_replace", f"""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day,
  CASE WHEN CAST(l_shipdate AS DATE) BETWEEN {d(FLEET_START)} AND {d(FLEET_END)} THEN l_quantity * 2 ELSE l_quantity END AS quantity FROM lineitem""")
def window_replace_q(spark, sf):
    """A reporting window of a table of one folder a month is rewritten, the other months stay."""
    path = _fresh(spark, "window")
    rows = S.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), F.col("l_quantity").alias("quantity"),
                                                F.trunc("l_shipdate", "MM").alias("month"))
    replace_window(rows, path, "month", ["day"])
    replace_window(keep_dates(rows, "day", FLEET_START, FLEET_END).withColumn("quantity", F.col("quantity") * 2), path, "month", ["day"])
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "day", "quantity")


@query("fan_out_read", "WITH " + TRIPS_SQL + """
SELECT event_id, borough, total_amount FROM silver WHERE borough IN ('click', 'view')""")
def fan_out_read(spark, sf):
    """Trips written once, a folder a borough; two boroughs are read back (K3)."""
    path = _fresh(spark, "fan")
    fan_out(trips_silver(spark, sf).select("event_id", "total_amount", "borough"), "borough", path)
    return spark.read.parquet(path).where(F.col("borough").isin("click", "view")).select("event_id", F.col("borough").cast("string"), "total_amount")


# ------------------------------------------------------------ sources
@query("merged_scan", """
SELECT o_orderkey AS trip_id, CAST(o_custkey % 6 AS DOUBLE) AS passenger_count, o_totalprice AS total_amount,
  o_orderdate AS tpep_pickup_datetime, CAST(NULL AS TIMESTAMP) AS lpep_pickup_datetime FROM orders
UNION ALL
SELECT l_orderkey, CAST(l_quantity AS DOUBLE), l_extendedprice, NULL, l_shipdate FROM lineitem""")
def merged_scan(spark, sf):
    """Two fleets, one with whole and one with fractional passengers, read without a list of types."""
    path = _fresh(spark, "fleets")
    orders, lines = S.load(spark, sf, "orders"), S.load(spark, sf, "lineitem")
    orders.select(F.col("o_orderkey").alias("trip_id"), (F.col("o_custkey") % 6).cast("long").alias("passenger_count"), F.col("o_totalprice").alias("total_amount"),
                  F.col("o_orderdate").alias("tpep_pickup_datetime")).write.parquet(f"{path}/yellow")
    lines.select(F.col("l_orderkey").alias("trip_id"), F.col("l_quantity").cast("double").alias("Passenger_Count"), F.col("l_extendedprice").alias("total_amount"),
                 F.col("l_shipdate").alias("lpep_pickup_datetime")).write.parquet(f"{path}/green")
    return scan_merged(spark, [f"{path}/yellow", f"{path}/green"]).select(
        "trip_id", "passenger_count", "total_amount", "tpep_pickup_datetime", "lpep_pickup_datetime")


@query("many_folders", """
SELECT 'sensor_' || (user_id % 9) AS sensor, event_id, value FROM events""")
def many_folders(spark, sf):
    """Nine sensor folders read in one scan, the folder as the sensor's name (S3)."""
    path = _fresh(spark, "sensors")
    events = _events(spark, sf).select("event_id", "value", F.concat(F.lit("sensor_"), F.col("user_id") % 9).alias("sensor"))
    fan_out(events, "sensor", path)
    return scan_many(spark, path, origin_col="folder").select(F.substring_index("folder", "=", -1).alias("sensor"), "event_id", "value")


_DOC = ("station string, month date, daily struct<time: array<string>, temperature_2m_max: array<double>, "
        "temperature_2m_min: array<double>, precipitation_sum: array<double>>")
_WEATHER = """SELECT event_type AS station, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS time, CAST(max(value) / 10.0 AS FLOAT) AS temperature_2m_max,
  CAST(min(value) / 10.0 AS FLOAT) AS temperature_2m_min,
  CAST(CAST(sum(CAST(value AS DECIMAL(28,10))) AS DOUBLE) / 100.0 AS FLOAT) AS precipitation_sum FROM events GROUP BY event_type, CAST(ts AS DATE)"""


@query("documents_read", _WEATHER)
def documents_read(spark, sf):
    """Column-oriented weather documents landed as JSON, read with a declared schema, one row a day."""
    path = _fresh(spark, "weather")
    export_json(S.weather_docs_from_events(_events(spark, sf)), path)
    return weather_silver(scan_documents(spark, path, _DOC, multiline=False), keep=["station"])


_RECORD = "event_id long, value double, period struct<utc: string>"
_LINE = """CASE event_id % 50
  WHEN 7 THEN '{"event_id":' || event_id || ',"value":"abc"}'
  WHEN 17 THEN '{"event_id":' || event_id || ',"value":1.5,"period":"today"}'
  WHEN 27 THEN '{"event_id":' || event_id || ',"value"'
  WHEN 37 THEN '{"event_id":' || event_id || '}'
  ELSE '{"event_id":' || event_id || ',"value":' || (user_id % 100) || '.5,"period":{"utc":"' || event_type || '"}}' END"""


@query("rescued_records", f"""
WITH r AS (SELECT event_id, user_id, event_type, {_LINE} AS record FROM events)
SELECT CASE WHEN event_id % 50 NOT IN (7, 17, 27) THEN event_id END AS event_id,
  CASE WHEN event_id % 50 NOT IN (7, 17, 27, 37) THEN (user_id % 100) + 0.5::DOUBLE END AS value,
  CASE WHEN event_id % 50 NOT IN (7, 17, 27, 37) THEN event_type END AS utc,
  CASE WHEN event_id % 50 IN (7, 17, 27) THEN record END AS record,
  CASE event_id % 50 WHEN 7 THEN 'value is not double' WHEN 17 THEN 'period is not struct<utc:string>' WHEN 27 THEN 'not a JSON object' END AS reason
FROM r""")
def rescued_records(spark, sf):
    """API records, some of them malformed or mistyped, split into good rows and quarantine in one write."""
    path = _fresh(spark, "records")
    _events(spark, sf).select(F.expr(_LINE).alias("value")).write.text(f"{path}/in")
    good, bad = split_records(scan_records(spark, f"{path}/in", _RECORD), f"{path}/out")
    good = good.select("event_id", "value", F.col("period.utc").alias("utc"), F.lit(None).cast("string").alias("record"), F.lit(None).cast("string").alias("reason"))
    return good.unionByName(bad.select(F.col(RECORD).alias("record"), F.col(REASON).alias("reason")), allowMissingColumns=True)


@query("incremental_landing", "SELECT event_id, event_type, value FROM events")
def incremental_landing(spark, sf):
    """Records landed in three deliveries; each run reads the new files only, the last one none."""
    path = _fresh(spark, "landing")
    events = _events(spark, sf).select("event_id", "event_type", "value")
    for at in range(4):
        if at < 3:
            events.where(F.col("event_id") % 3 == at).write.json(f"{path}/in/delivery={at}")
        land_new_files(spark, f"{path}/in", "event_id long, event_type string, value double", f"{path}/out", f"{path}/notes")
    return spark.read.parquet(f"{path}/out").select("event_id", "event_type", "value")


@query("distinct_append", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS date, strftime(ts, '%H') AS hour FROM events")
def distinct_append(spark, sf):
    """Silver rows kept distinct over three appends; stored rows are not shuffled again."""
    table, path = f"silver_{uuid.uuid4().hex}", _fresh(spark, "silver")
    rows = _events(spark, sf).select("event_id", "user_id", "event_type", F.to_date("ts").alias("date"), hour_text("ts", "HH").alias("hour"))
    for part in ("event_id % 2 = 0", "event_id % 3 = 0", "true"):
        append_distinct(rows.where(part).drop("event_id"), table, buckets=8, path=path)
    return spark.table(table).drop(DIGEST)


@query("dense_numbers", """
SELECT row_number() OVER (ORDER BY event_id) - 1 AS n, event_id, value FROM events WHERE user_id % 3 <> 0""")
def dense_numbers(spark, sf):
    """Rows numbered without gaps in the order of the file (the driver's file is in event order) after a filter."""
    keyed = with_file_order_key(_events(spark, sf), "at").where("user_id % 3 <> 0")
    return with_dense_number(keyed, "at", block=1 << 12).select("n", "event_id", "value")


# ------------------------------------------------------------ quality
@query("dq_in_write", "SELECT *, unexpected_count = 0 AS success FROM " + _rules_sql(EVENT_RULES, "events"))
def dq_in_write(spark, sf):
    """The suite counted while the table is written (A9, DQ1, DQ2)."""
    path = _fresh(spark, "checked")
    return checked_write(_events(spark, sf), EVENT_RULES, lambda df: overwrite(df, path))


@query("weather_gold_read", _WEATHER)
def weather_gold_read(spark, sf):
    """Gold weather written and checked in one pass, read back (C11)."""
    path = _fresh(spark, "gold")
    weather_gold(weather_silver(S.weather_docs_from_events(_events(spark, sf)), keep=["station"]), path)
    return scan_table(spark, path)


@query("rule_masks", """
SELECT event_id, CAST((ts IS NULL)::INT + 2 * (value IS NOT NULL AND (value < 0 OR value > 300))::INT + 4 * (props IS NULL)::INT
  + 8 * (user_id IS NOT NULL AND (user_id < 0 OR user_id > 1000))::INT AS BIGINT) AS failed_rules,
  (ts IS NULL)::INT + (value IS NOT NULL AND (value < 0 OR value > 300))::INT + (props IS NULL)::INT
  + (user_id IS NOT NULL AND (user_id < 0 OR user_id > 1000))::INT AS n_failed FROM events""")
def rule_masks(spark, sf):
    """The rules each row fails, for a quarantine (DQ1, DQ2)."""
    masked = rule_mask(_events(spark, sf), EVENT_RULES)
    return masked.select("event_id", "failed_rules", F.size(failed_names(EVENT_RULES)).alias("n_failed"))


@query("long_calendar", """
WITH r AS (SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL),
grid AS (SELECT k, CAST(g.day AS DATE) AS day FROM (SELECT DISTINCT k FROM r),
         generate_series(TIMESTAMP '1990-01-01 00:00:00', TIMESTAMP '2004-12-31 00:00:00', INTERVAL 1 DAY) g(day)),
j AS (SELECT k, grid.day, v FROM grid LEFT JOIN r USING (k, day))
SELECT k, day, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY k ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER (PARTITION BY k ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM j""")
def long_calendar(spark, sf):
    """A calendar of 15 years, filled in blocks of 1,024 days with values carried across them."""
    daily = (S.load(spark, sf, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_orderpriority").alias("k"), F.to_date("o_orderdate").alias("day"))
             .agg(F.max("o_totalprice").alias("v")))
    return densify(daily, "day", ["k"], dt.date(1990, 1, 1), dt.date(2004, 12, 31), unique=True, block=1024)


# Units of 10^-12: amounts of 10^18 of both signs beside amounts of 10^-12.
_UNITS = """(CASE event_id % 5 WHEN 0 THEN (user_id % 7 + 1) * 1000000000000000000000000000000::HUGEINT
  WHEN 1 THEN -(user_id % 6 + 1) * 1000000000000000000000000000000::HUGEINT WHEN 2 THEN (user_id % 9)::HUGEINT
  WHEN 3 THEN (user_id % 100) * 500000000000::HUGEINT END)"""


@query("exact_sums", f"""
SELECT event_type, CAST(sum({_UNITS})::VARCHAR || 'e-12' AS DOUBLE) AS total, count({_UNITS}) AS n,
  CAST(sum(CASE event_id % 5 WHEN 2 THEN {_UNITS} END)::VARCHAR || 'e-12' AS DOUBLE) AS small FROM events GROUP BY event_type""")
def exact_sums(spark, sf):
    """Sums over amounts of 10^18 and of 10^-12 in one group, the same for every order of the rows."""
    k = F.col("event_id") % 5
    text = (F.when(k == 0, F.concat(F.col("user_id") % 7 + 1, F.lit("e18"))).when(k == 1, F.concat(F.lit("-"), F.col("user_id") % 6 + 1, F.lit("e18")))
            .when(k == 2, F.concat(F.col("user_id") % 9, F.lit("e-12"))).when(k == 3, ((F.col("user_id") % 100) / 2).cast("string")))
    events = _events(spark, sf).select("event_type", text.cast("double").alias("amount"), F.when(k == 2, text.cast("double")).alias("tiny"))
    counts = events.groupBy("event_type").agg(F.count("amount").alias("n"))
    totals = exact_totals(events, ["event_type"], [("total", "sum", "amount", None), ("small", "sum", "tiny", None)])
    return totals.join(counts, "event_type").select("event_type", "total", "n", "small")
