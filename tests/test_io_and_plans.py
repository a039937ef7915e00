"""Sources and sinks by write / read-back; plan shapes that matter at scale."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from cityflow.operators.quality import run_suite
from cityflow.plans import catalog as C
from cityflow.plans.star import refresh_star, star_tables
from cityflow.sources.readers import scan_documents, scan_many, scan_merged, scan_table
from cityflow.sources.writers import export_json, fan_out, overwrite

from .conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_overwrite_and_skip_if_empty(spark, scratch):
    path = os.path.join(scratch, "t")
    df = spark.range(5)
    assert overwrite(df, path)
    assert not overwrite(df.filter("id < 0"), path, skip_if_empty=True)
    assert scan_table(spark, path).count() == 5


def test_fan_out_partitioned_write(spark, scratch):
    path = os.path.join(scratch, "fan")
    df = spark.createDataFrame([(1, "Bronx"), (2, "Queens"), (3, "Bronx")], "x int, borough string")
    fan_out(df, "borough", path)
    assert sorted(d for d in os.listdir(path) if d.startswith("borough=")) == ["borough=Bronx", "borough=Queens"]
    back = spark.read.parquet(path).filter(F.col("borough") == "Bronx")
    assert back.count() == 2
    assert "PartitionFilters: [isnotnull(borough" in _plan(back)


def test_scan_merged_unions_columns(spark, scratch):
    a, b = os.path.join(scratch, "fleet/a"), os.path.join(scratch, "fleet/b")
    spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0)], "tpep_pickup_datetime timestamp, total_amount double") \
        .write.parquet(a)
    spark.createDataFrame([(dt.datetime(2024, 1, 2), 2)], "lpep_pickup_datetime timestamp, total_amount int") \
        .write.parquet(b)
    merged = scan_merged(spark, [a, b], schema_map={b: {"total_amount": "double"}})
    assert set(merged.columns) == {"tpep_pickup_datetime", "lpep_pickup_datetime", "total_amount"}
    assert merged.count() == 2


def test_scan_many_keeps_folder_origin(spark, scratch):
    for name in ("OpenAQ_Bronx_1", "OpenAQ_Bronx_2"):
        spark.createDataFrame([(1.0,)], "value double").write.parquet(os.path.join(scratch, "aq", name))
    df = scan_many(spark, os.path.join(scratch, "aq"), origin_col="sensor")
    assert sorted(r.sensor for r in df.collect()) == ["OpenAQ_Bronx_1", "OpenAQ_Bronx_2"]


def test_scan_documents_and_export_json(spark, scratch):
    doc = {"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [1.5, 2.5],
                     "temperature_2m_min": [0.5, None], "precipitation_sum": [0.0, 3.0]}}
    p = os.path.join(scratch, "doc.json")
    with open(p, "w") as f:
        json.dump(doc, f)
    schema = ("daily struct<time: array<string>, temperature_2m_max: array<double>, "
              "temperature_2m_min: array<double>, precipitation_sum: array<double>>")
    from cityflow.plans.weather import weather_alerts, weather_silver
    silver = weather_silver(scan_documents(spark, p, schema))
    assert silver.count() == 2
    assert dict(silver.dtypes)["temperature_2m_max"] == "float"
    alerts = weather_alerts(silver)
    out = os.path.join(scratch, "alert")
    export_json(alerts, out)
    back = spark.read.json(out).orderBy(F.col("time").desc()).collect()
    assert back[0].time == "2024-01-02" and back[0].temperature_2m_max == "2.50"
    assert back[1].temperature_2m_min == "0.50"


def test_star_refresh_tables(spark, scratch):
    fact = spark.createDataFrame([(dt.date(2024, 1, 2), 1.5)], "Date date, Exchange_Rate double")
    tabs = star_tables(spark, {"FactCurrency": (fact, "Date")}, as_of=dt.date(2024, 6, 15))
    assert tabs["DimDate"].count() == 121
    assert tabs["FactCurrency"].columns == ["DateKey", "Date", "Exchange_Rate"]
    done = refresh_star(spark, {"fx_fact_currency": (fact, "Date")}, as_of=dt.date(2024, 6, 15),
                        fmt="parquet")
    assert done == ["DimDate", "fx_fact_currency"]
    assert spark.table("fx_fact_currency").count() == 1


def test_dq_suite_is_one_scan(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    plan = _plan(run_suite(ev, C.EVENT_RULES))
    assert plan.count("FileScan") == 1


def test_filters_reach_the_scan(spark):
    plan = _plan(C.trip_window_filter(spark, SF001))
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_quantity)" in plan
    assert "GreaterThanOrEqual(l_shipdate" in plan


def test_trip_fact_scans_events_once(spark):
    plan = _plan(C.trip_wide_fact(spark, SF001))
    assert plan.count("FileScan") == 1


def test_air_plan_scans_once_and_hash_aggregates_rows(spark):
    plan = _plan(C.air_combine(spark, SF001))
    assert plan.count("FileScan") == 1
    # the raw rows go through a hash aggregation (map-side combine), not a sort
    scan_side = plan[plan.rindex("HashAggregate"):]
    assert "FileScan" in scan_side


def test_no_single_partition_exchange_over_rows(spark):
    """The only single-partition exchange allowed is the fill's carry step,
    which reads one summary row per block of the order key, or per folder."""
    for name in ("trip_clean", "trip_mask_fill", "fill_file_order", "fill_sparse_keys", "reading_dense", "zone_membership", "air_combine"):
        lines = _plan(C.QUERIES[name](spark, SF001)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = " ".join(lines[i + 1:i + 4])
                assert "HashAggregate(keys=[_fill_blk_1" in below or "SortAggregate(key=[_fill_folder" in below, (name, line)


def test_fill_moves_the_rows_once(spark):
    """Rows are exchanged for their window only; the join with the carry keeps that partitioning."""
    from cityflow.operators.fill import fill_ordered
    df = spark.range(1000).selectExpr("id", "if(id % 7 = 0, id, null) v", "if(id % 2 = 0, 'a', null) s")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for by in ([], ["s"]):
            plan = _plan(fill_ordered(df, ["v"], "id", by=by))
            top = plan[plan.index("SortMergeJoin"):plan.index("Window")]
            assert "Exchange" not in top and "Project [id" in top
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_zone_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(C.zone_membership(spark, SF001))
