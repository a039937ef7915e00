"""Golden cases on tiny inline frames (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from cityflow.functions.calendar import report_window, rolling_window
from cityflow.functions.scalar import fixed_text, normalise_name, sanitise_name
from cityflow.operators.aggregate import peak_slot
from cityflow.operators.calendar import dim_date_range
from cityflow.operators.clean import coerce, keep_range, repair_sign, union_conformed
from cityflow.operators.fill import fill_ordered
from cityflow.operators.nested import zip_to_rows
from cityflow.operators.quality import between, not_null, report_text, run_suite, summarise
from cityflow.operators.series import daily_change, densify
from cityflow.operators.widen import row_greatest, row_mean, row_total
from cityflow.operators.zones import assign_zones

SEQ = [None, 10, None, None, 20, None, 30, None, None]


def _seq(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(SEQ)], "id long, v int")


def _col(df, c, order="id"):
    return [r[c] for r in df.orderBy(order).collect()]


def test_fill_backward_then_forward(spark):
    out = fill_ordered(_seq(spark), ["v"], "id", directions=("backward", "forward"), block=4)
    assert _col(out, "v") == [10, 10, 20, 20, 20, 30, 30, 30, 30]


def test_fill_backward_only_reproduces_literal_result(spark):
    out = fill_ordered(_seq(spark), ["v"], "id", directions=("backward",), block=4)
    assert _col(out, "v") == [10, 10, 20, 20, 20, 30, 30, None, None]


def _days(*pairs):
    return [(dt.date(2024, 1, d), v) for d, v in pairs]


def test_densify_forward_then_backward(spark):
    df = spark.createDataFrame(_days((2, 7.0), (4, 9.0)), "day date, v double")
    out = densify(df, "day", [], dt.date(2024, 1, 1), dt.date(2024, 1, 5))
    assert _col(out, "v", "day") == [7.0, 7.0, 7.0, 9.0, 9.0]


def test_densify_value_before_window_is_ignored(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31), 5.0), (dt.date(2024, 1, 3), 8.0)], "day date, v double")
    out = densify(df, "day", [], dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    assert _col(out, "v", "day") == [8.0, 8.0, 8.0, 8.0]


def test_densify_default_hour_when_no_data(spark):
    df = spark.createDataFrame(_days((2, None)), "day date, h string")
    out = densify(df, "day", [], dt.date(2024, 1, 1), dt.date(2024, 1, 3), defaults={"h": "00:00:00"})
    assert _col(out, "h", "day") == ["00:00:00"] * 3


def test_densify_with_keys_gives_every_key_every_day(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 2), 1.0)], "k string, day date, v double")
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    out = densify(df, "day", ["k"], dt.date(2024, 1, 1), dt.date(2024, 1, 3), keys=keys)
    rows = sorted((r.k, r.day.day, r.v) for r in out.collect())
    assert rows == [("a", 1, 1.0), ("a", 2, 1.0), ("a", 3, 1.0), ("b", 1, None), ("b", 2, None), ("b", 3, None)]


def test_repair_sign(spark):
    df = spark.createDataFrame([(float(x),) for x in (-12, -10, -3, 0, 4)], "x double")
    assert [r.x for r in repair_sign(df, "x").collect()] == [0.0, 10.0, 3.0, 0.0, 4.0]


def test_coerce_drops_bad_text_nan_and_null(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("nan",), (None,)], "v string")
    assert [r.v for r in coerce(df, {"v": "double"}).collect()] == [1.5]


def test_keep_range_open_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.1, 0.2, 36.0, 36.1)], "x double")
    assert [r.x for r in keep_range(df, "x", 0.1, 36.0, "right").collect()] == [0.2, 36.0]


def test_peak_slot_by_count_tie_goes_to_earliest(spark):
    rows = [("03",)] * 2 + [("09",)] * 2 + [("11",)]
    df = spark.createDataFrame([(1, h) for (h,) in rows], "d int, h string")
    assert peak_slot(df, [], "d", "h", out="p").collect()[0].p == "03"


def test_peak_slot_by_value_tie_goes_to_earliest(spark):
    df = spark.createDataFrame([(1, "01", 5.0), (1, "09", 7.0), (1, "03", 7.0)], "d int, h string, v double")
    r = peak_slot(df, [], "d", "h", score="v", out="p", peak_value="m").collect()[0]
    assert (r.p, r.m) == ("03", 7.0)


def test_row_total_mean_greatest(spark):
    df = spark.createDataFrame([(None, 2.0), (3.0, None)], "a double, b double")
    assert [r.t for r in row_total(df, ["a", "b"], "t").collect()] == [2.0, 3.0]
    assert [r.m for r in row_mean(df, ["a", "b"], "m").collect()] == [None, None]
    assert [r.g for r in row_greatest(df, ["a", "b"], "g").collect()] == [2.0, 3.0]


def test_round_half_up_and_half_even(spark):
    df = spark.createDataFrame([(0.25,), (12.45,), (-0.25,)], "x double")
    rows = df.select(F.round("x", 1).alias("u"), F.bround("x", 1).alias("e")).collect()
    assert [r.u for r in rows] == [0.3, 12.5, -0.3]
    assert [r.e for r in rows] == [0.2, 12.4, -0.2]


def test_daily_change(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([10, 12, 12, 9])], "d int, x double")
    assert _col(daily_change(df, "x", "d", out="c"), "c", "d") == [0.0, 2.0, 0.0, -3.0]


def test_assign_zones_either_endpoint(spark):
    lookup = spark.createDataFrame([(1, "B1"), (2, "B2")], "zone_id int, borough string")
    trips = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 1, 9), (4, 9, 9)], "t int, pu int, do int")
    out = assign_zones(trips, lookup, ["pu", "do"])
    counts = {r.t: r["count"] for r in out.groupBy("t").count().collect()}
    assert counts == {1: 1, 2: 2, 3: 1}


def test_report_window():
    assert report_window(dt.date(2024, 7, 31)) == (dt.date(2024, 2, 1), dt.date(2024, 5, 31))
    assert report_window(dt.date(2024, 3, 31)) == (dt.date(2023, 10, 1), dt.date(2024, 1, 31))
    assert report_window(dt.date(2024, 1, 15)) == (dt.date(2023, 8, 1), dt.date(2023, 11, 30))
    assert rolling_window(dt.date(2024, 1, 30), 30) == (dt.date(2024, 1, 1), dt.date(2024, 1, 30))


def test_dim_date(spark):
    r = dim_date_range(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 1)).collect()[0]
    assert (r.Year, r.Month, r.MonthName, r.DayOfWeek) == (2024, 1, "January", "Monday")


def test_dim_date_has_no_length_cap(spark):
    assert dim_date_range(spark, dt.date(2020, 1, 1), dt.date(2021, 12, 31)).count() == 731


def test_fixed_text(spark):
    df = spark.createDataFrame([(1.239,), (None,)], "x double")
    assert [r.t for r in df.select(fixed_text("x", 2).alias("t")).collect()] == ["1.24", None]


def test_zip_to_rows(spark):
    df = spark.createDataFrame([(["a", "b"], [5.5, None])], "time array<string>, mx array<double>")
    df = df.select(F.struct("time", "mx").alias("daily"))
    rows = [tuple(r) for r in zip_to_rows(df, "daily", ["time", "mx"]).collect()]
    assert rows == [("a", 5.5), ("b", None)]


def test_run_suite_between_ignores_nulls(spark):
    df = spark.createDataFrame([(0.0,), (300.0,), (301.0,), (None,)], "x double")
    r = run_suite(df, [between("x", 0, 300)]).collect()[0]
    assert (r.element_count, r.unexpected_count, r.success) == (4, 1, False)


def test_summarise_and_report(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    rules = [not_null("a"), between("a", 0, 2), between("a", 0, 5), not_null("b")]
    s = summarise(run_suite(df, rules))
    r = report_text(s, "t").collect()[0]
    assert (r.success, r.success_percent, r.evaluated_expectations, r.unsuccessful_expectations) == (False, 75.0, 4, 1)
    assert "**Status:** FAILED" in r.report and "**Success Rate:** 75.0%" in r.report


def test_union_conformed(spark):
    a = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1),)], "tpep_pickup_datetime timestamp")
    b = spark.createDataFrame([(dt.datetime(2024, 1, 2, 2),)], "lpep_pickup_datetime timestamp")
    out = union_conformed([a, b], {"pickup": ["tpep_pickup_datetime", "lpep_pickup_datetime"]})
    assert sorted(r.pickup.day for r in out.collect()) == [1, 2]


def test_name_rules():
    assert normalise_name("Staten_Island/") == "StatenIsland"
    assert normalise_name("MIDDLE EAST") == "MIDDLEEAST"
    assert sanitise_name("^VIX") == "Vol_VIX"
    assert sanitise_name("Adj Close.x") == "Adj_Close_x"


def test_with_order_key_is_pinned_and_unique(spark):
    from cityflow.operators.fill import with_order_key
    df = with_order_key(spark.range(0, 50, 1, 4).withColumnRenamed("id", "x"), "rid")
    ids = [r.rid for r in df.collect()]
    assert len(set(ids)) == 50
    assert ids == [r.rid for r in df.collect()]  # same ids on re-evaluation (read from the checkpoint)
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString() or \
        "LogicalRDD" in df._jdf.queryExecution().optimizedPlan().toString()


def test_air_daily_pools_sensor_tables_as_rows(spark):
    """U1 + Q11: two sensor tables of one borough are pooled per reading, not per sensor."""
    from cityflow.plans.air import air_daily
    d = dt.date(2024, 1, 1)
    s1 = spark.createDataFrame([("Bronx", d, "01:00:00", 1.0), ("Bronx", d, "02:00:00", 2.0)],
                               "borough string, date date, time string, pm_2_5_value double")
    s2 = spark.createDataFrame([("Bronx", d, "03:00:00", 6.0)],
                               "borough string, date date, time string, pm_2_5_value double")
    r = air_daily([s1, s2], d, d).collect()[0]
    assert (r.avg_value_pm2_5, r.peak_value_pm2_5, r.peak_value_hour) == (3.0, 6.0, "03:00:00")
