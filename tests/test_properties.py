"""Properties: distributed forms equal their single-task / literal forms."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cityflow.operators.exact import exact_totals
from cityflow.operators.fill import fill_ordered
from cityflow.operators.series import densify
from cityflow.operators.widen import fold_union, full_fold, suffix_columns, widen
from cityflow.plans import catalog as C
from cityflow.plans.trips import TRIP_METRICS, daily_trip_stats

from .conftest import SF001



def fill_rows(rows, directions=("backward", "forward")):
    """{(key, filled value)} of (key, value) rows, by walking them in plain Python."""
    rows = sorted(rows)

    def walk(order):
        seen, last = {}, None
        for k, v in order:
            last = v if v is not None else last
            seen[k] = last
        return seen
    found = [walk(rows if d == "forward" else rows[::-1]) for d in directions]
    return {(k, next((f[k] for f in found if f[k] is not None), None)) for k, _ in rows}


SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(vals=st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=1, max_size=40),
       block=st.integers(1, 9), gaps=st.integers(1, 5),
       directions=st.sampled_from([("backward", "forward"), ("forward", "backward"), ("backward",), ("forward",)]))
def test_distributed_fill_equals_plain_fill(spark, vals, block, gaps, directions):
    # Sparse keys (gaps) and tiny blocks exercise the carry across many blocks.
    df = spark.createDataFrame([(i * gaps, v) for i, v in enumerate(vals)], "id long, v int").repartition(3)
    got = {tuple(r) for r in fill_ordered(df, ["v"], "id", directions=directions, block=block).collect()}
    assert got == fill_rows([(i * gaps, v) for i, v in enumerate(vals)], directions)


@SLOW
@given(vals=st.lists(st.one_of(st.none(), st.integers(0, 9)), min_size=1, max_size=30), block=st.integers(1, 5))
def test_fill_by_series_stays_in_series(spark, vals, block):
    rows = [(i, "ab"[i % 2], v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id long, s string, v int")
    got = {(r.id, r.v) for r in fill_ordered(df, ["v"], "id", by=["s"], block=block).collect()}
    want = set()
    for s in "ab":
        want |= fill_rows([(i, v) for i, t, v in rows if t == s])
    assert got == want


def test_fill_on_events_matches_global(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    masked = ev.select("event_id", F.when(F.col("user_id") % 3 == 0, F.col("value")).alias("v"))
    a = {tuple(r) for r in fill_ordered(masked, ["v"], "event_id", block=97).collect()}
    assert a == fill_rows([tuple(r) for r in masked.collect()])


@SLOW
@given(days=st.lists(st.integers(0, 20), min_size=1, max_size=10, unique=True),
       keys=st.integers(1, 4), span=st.integers(1, 25))
def test_densify_row_count(spark, days, keys, span):
    start = dt.date(2024, 1, 1)
    rows = [(k, start + dt.timedelta(days=d), float(d)) for k in range(keys) for d in days]
    df = spark.createDataFrame(rows, "k int, day date, v double")
    end = start + dt.timedelta(days=span - 1)
    with_data = len({k for k, d, _ in rows if d <= end})
    out = densify(df, "day", ["k"], start, end)
    assert out.count() == keys * span
    assert out.filter(F.col("v").isNull()).count() == (0 if with_data else keys * span)
    keyed = densify(df, "day", ["k"], start, end, keys=df.select("k").distinct())
    assert keyed.count() == keys * span


def test_pivot_equals_full_join_fold(spark):
    long = daily_trip_stats(C.trips_silver(spark, SF001), "borough")
    wide = widen(long, "Date", "borough", TRIP_METRICS, values=C.EVENT_TYPES)
    parts = [suffix_columns(long.filter(F.col("borough") == v).drop("borough"), v, "Date") for v in C.EVENT_TYPES]
    fold = full_fold(parts, "Date").select(*wide.columns)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, fold.collect()))


def test_membership_one_row_per_distinct_borough(spark):
    out = C.zone_membership(spark, SF001)
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    per_row = out.groupBy("l_orderkey", "l_linenumber", "borough").count()
    # every input row yields 1 or 2 boroughs, never the same borough twice
    assert out.count() >= li.count()
    assert out.count() <= 2 * li.count()
    assert per_row.agg(F.max("count")).collect()[0][0] <= li.groupBy("l_orderkey", "l_linenumber").count() \
        .agg(F.max("count")).collect()[0][0]


def test_file_order_key_is_deterministic_and_in_file_order(spark, scratch):
    from cityflow.operators.fill import with_file_order_key
    import os
    # two files: keys unique, increasing within a file, file blocks in path order
    for i in range(2):
        spark.range(i * 100, i * 100 + 100, 1, 1).write.parquet(os.path.join(scratch, f"part={i}"))
    df = spark.read.parquet(os.path.join(scratch, "part=0"), os.path.join(scratch, "part=1"))
    keyed = with_file_order_key(df, "k")
    a = sorted((r.k, r.id) for r in keyed.collect())
    b = sorted((r.k, r.id) for r in keyed.collect())
    assert a == b and len({k for k, _ in a}) == 200
    assert [i for _, i in a] == list(range(200))


def test_fill_by_file_order_equals_fill_by_event_id(spark):
    from cityflow.operators.fill import with_file_order_key
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    keyed = with_file_order_key(ev, "k").select("k", "event_id",
                                                F.when(F.col("user_id") % 3 == 0, F.col("value")).alias("v"))
    by_file = {(r.event_id, r.v) for r in fill_ordered(keyed, ["v"], "k", block=64).collect()}
    by_id = fill_rows([(r.event_id, r.v) for r in keyed.collect()])
    # the driver's events file is stored in event_id order
    assert by_file == by_id


def test_fill_by_file_order_carries_across_files_heads_and_folders(spark, scratch):
    """Files without a valid value between others, several blocks a file, several name heads and folders, per series."""
    from cityflow.operators.fill import tag_file_order, with_file_order_key
    import os
    import pyarrow as pa
    import pyarrow.parquet as pq
    rows, paths = [], []
    for folder in ("a", "b-x", "b"):  # in text order with the closing slash
        os.makedirs(f"{scratch}/{folder}")
        for file in ("part-00000", "part-00001", "part-10000"):
            path = f"{scratch}/{folder}/{file}.parquet"
            first = len(rows)
            rows += [(i, "s" if i % 3 else None, i if i % 17 == 0 and file != "part-00001" and folder != "b-x" else None)
                     for i in range(first, first + 20)]
            pq.write_table(pa.table(dict(zip(("id", "s", "v"), zip(*rows[first:]))), schema=pa.schema([("id", pa.int64()), ("s", pa.string()), ("v", pa.int32())])), path)
            paths.append(path)
    keyed = with_file_order_key(tag_file_order(spark.read.parquet(*paths)), "k")
    assert [r.id for r in keyed.orderBy("k").collect()] == list(range(len(rows)))
    for by, groups in (([], [rows]), (["s"], [[r for r in rows if r[1]], [r for r in rows if not r[1]]])):
        filled = fill_ordered(keyed, ["v"], "k", by=by, block=4)
        assert filled.columns == keyed.columns and filled.schema["k"].dataType == keyed.schema["k"].dataType
        assert {(r.id, r.v) for r in filled.collect()} == set().union(*[fill_rows([(i, v) for i, _, v in g]) for g in groups])


def test_fill_with_very_sparse_keys_and_null_series(spark):
    rows = [(-(1 << 62) + i * (1 << 40), "a" if i % 2 else None, i if i % 5 == 0 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, s string, v int")
    got = {(r.id, r.v) for r in fill_ordered(df, ["v"], "id", by=["s"]).collect()}
    assert got == fill_rows([(k, v) for k, s, v in rows if s]) | fill_rows([(k, v) for k, s, v in rows if not s])


def test_densify_keeps_repeated_days_and_empty_windows(spark):
    day = dt.date(2024, 1, 2)
    df = spark.createDataFrame([(day, 1.0), (day, 3.0)], "day date, v double")
    two = sorted((r.day.day, r.v) for r in densify(df, "day", [], dt.date(2024, 1, 1), dt.date(2024, 1, 2)).collect())
    assert [d for d, _ in two] == [1, 2, 2] and two[1:] == [(2, 1.0), (2, 3.0)]
    late = densify(df, "day", [], dt.date(2025, 1, 1), dt.date(2025, 1, 3)).collect()
    assert len(late) == 3 and all(r.v is None for r in late)
    keyed = densify(df.withColumn("k", F.lit("x")), "day", ["k"], dt.date(2025, 1, 1), dt.date(2025, 1, 3), defaults={"v": 0.5}).collect()
    assert [r.v for r in keyed] == [0.5] * 3


def test_sums_keep_small_values_and_survive_nan(spark):
    from cityflow.operators.aggregate import daily_fact
    day = dt.date(2024, 1, 1)
    rows = [("a", day, "01", 1e-7), ("a", day, "02", 5e-7), ("b", day, "01", float("nan")), ("c", day, "01", 1e300), ("d", day, "01", None)]
    df = spark.createDataFrame(rows, "s string, day date, h string, x double")
    for peak in ("peak", None):
        out = {r.s: r for r in daily_fact(df, ["s"], "day", "h", [("total", "sum", "x", None), ("cents", "sum", "x", 2), ("mean", "avg", "x", 7)],
                                          count_name="n", peak_name=peak).collect()}
        assert abs(out["a"].total - 6e-7) < 1e-15 and out["a"].cents == 0.0 and out["a"].mean == 3e-7
        assert out["b"].cents != out["b"].cents and out["c"].total == 1e300 and out["d"].cents is None


def test_unlisted_series_stay_in_city_totals(spark):
    from cityflow.plans.trips import trip_fact
    row = (dt.date(2024, 1, 1), "09", 1.0, 2.0, 1, 1, 10.0, 1.0)
    cols = "Date date, Time string, passenger_count double, trip_distance double, DOLocationID int, PULocationID int, total_amount double, tip_amount double, borough string"
    silver = spark.createDataFrame([(*row, "St. George"), (*row, "Newark"), (*row[:1], "9", *row[2:], "St. George"), (*row[:1], "10", *row[2:], "St. George"),
                                    (*row[:1], "10", *row[2:], "St. George")], cols)
    got = trip_fact(silver, values=["St. George"]).first().asDict()
    assert got["total_trips_New_York"] == 5 and got["total_amount_earned_New_York"] == 50.0 and got["total_trips_St.George"] == 4
    assert got["peak_trip_hour_St.George"] == "09:00:00"
    with pytest.raises(ValueError):
        widen(silver, "Date", "borough", ["tip_amount"], ["Staten Island", "Staten_Island"])
    with pytest.raises(ValueError):
        trip_fact(silver)


def test_readings_do_not_depend_on_the_session_zone(spark):
    from cityflow.plans.air import clean_readings
    raw = spark.createDataFrame([("2024-02-01T03:00:00Z",), ("2024-02-01 03:00:00",), ("2024-01-31T22:00:00-05:00",)], "t string").select(
        F.struct(F.lit("pm25").alias("name"), F.lit("u").alias("units")).alias("parameter"), F.lit("1.0").alias("value"),
        F.struct(F.struct(F.col("t").alias("utc")).alias("datetimeFrom")).alias("period"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert {(str(r.date), r.time) for r in clean_readings(raw).collect()} == {("2024-02-01", "03:00:00")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_zones_with_two_labels_and_absent_ticker(spark):
    from cityflow.operators.zones import assign_zones
    from cityflow.plans.finance import market_daily
    zones = spark.createDataFrame([(1, "A"), (1, "B"), (2, "B")], "zone_id int, borough string")
    trips = spark.createDataFrame([(7, 1, 2), (8, 3, None)], "id int, pu int, do_ int")
    assert sorted((r.id, r.borough) for r in assign_zones(trips, zones, ["pu", "do_"]).collect()) == [(7, "A"), (7, "B")]
    quotes = spark.createDataFrame([(dt.date(2024, 1, 1), "SPY", 5.0)], "Date date, ticker string, Close double")
    rows = market_daily(quotes, dt.date(2024, 1, 1), dt.date(2024, 1, 2)).collect()
    assert len(rows) == 2 and rows[0].vol_vix is None and rows[1].spy_daily_change == 0.0


def test_mixed_type_families_fan_out_and_reports(spark, scratch):
    import glob
    import json
    from cityflow.operators.quality import between, fail_on, run_suite
    from cityflow.plans.trips import raw_trips
    from cityflow.sources.readers import scan_many
    from cityflow.sources.writers import export_json, fan_out
    spark.sql("select timestamp'2024-01-01 01:00:00' tpep_pickup_datetime, 2L passenger_count").write.parquet(f"{scratch}/a")
    spark.sql("select timestamp'2024-01-01 02:00:00' lpep_pickup_datetime, 1.5D passenger_count").write.parquet(f"{scratch}/b")
    raw = raw_trips(spark, [f"{scratch}/a", f"{scratch}/b"], schema_map={f"{scratch}/a": {"passenger_count": "double"}})
    rows = raw.orderBy("row_id").collect()
    assert [r.passenger_count for r in rows] == [2.0, 1.5] and all(r.pickup_datetime for r in rows)
    df = spark.range(400, numPartitions=8).select("id", (F.col("id") % 5).cast("string").alias("borough"))
    fan_out(df, "borough", f"{scratch}/root/trips")
    assert len(glob.glob(f"{scratch}/root/trips/*/*.parquet")) <= 10
    back = scan_many(spark, f"{scratch}/root", partitions=["borough"])
    assert {(r.origin, r.borough) for r in back.collect()} == {("trips", str(i)) for i in range(5)} and back.count() == 400
    export_json(df.limit(2), f"{scratch}/alerts", as_array=True)
    assert len(json.loads(open(glob.glob(f"{scratch}/alerts/part*")[0]).read())) == 2
    with pytest.raises(ValueError):
        fail_on(run_suite(df, [between("id", 0, 5)]))


def brute_densify(rows, start, days, fill):
    """Rows and missing days of each series in plain Python: a day hands on its greatest value."""
    out = []
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key and 0 <= (r[1] - start).days < days]
        best = [max((r[2] for r in own if (r[1] - start).days == i and r[2] is not None), default=None) for i in range(days)]
        full = list(best)
        for step in fill:
            order = range(days) if step == "forward" else range(days - 1, -1, -1)
            seen = None
            for i in order:
                seen = full[i] if full[i] is not None else seen
                full[i] = seen
        for i in range(days):
            here = [r[2] for r in own if (r[1] - start).days == i]
            out += [(key, start + dt.timedelta(i), v if v is not None else full[i]) for v in here or [full[i]]]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [3, 8, 1 << 12])
@pytest.mark.parametrize("fill", [("forward", "backward"), ("backward",), ("backward", "forward")])
def test_densify_in_blocks_of_days_equals_plain_python(spark, block, fill):
    rng = random.Random(block)
    start = dt.date(2024, 2, 25)
    rows = [(k, start + dt.timedelta(rng.randrange(-3, 33)), rng.choice([None, float(rng.randrange(9))])) for k in ("a", "b", None) for _ in range(14)]
    rows += [("late", start + dt.timedelta(100), 5.0), ("null", start + dt.timedelta(4), None)]
    df = spark.createDataFrame(rows, "k string, day date, v double").repartition(3)
    got = densify(df, "day", ["k"], start, start + dt.timedelta(29), fill=fill, block=block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_densify(rows, start, 30, fill)
    one = {(r[0], r[1]): r for r in rows}.values()
    single = spark.createDataFrame(list(one), "k string, day date, v double")
    got = densify(single, "day", ["k"], start, start + dt.timedelta(29), fill=fill, block=block, unique=True)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_densify(list(one), start, 30, fill)


def test_densify_without_series_holds_no_rows_in_one_task(spark):
    """Raw rows, many a day: the window and the arrays hold days, and the rows meet them in a join."""
    start = dt.date(2024, 1, 1)
    df = spark.range(20_000).select(F.date_add(F.lit(start), (F.col("id") % 20).cast("int")).alias("day"), (F.col("id") % 97).cast("double").alias("v"))
    got = densify(df, "day", [], start, dt.date(2024, 1, 30))
    assert got.count() == 20_010 and got.where("day = '2024-01-30'").first().v == 96.0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in plan and plan.index("max(") > plan.index("collect_list")
    with pytest.raises(Exception, match="several rows a day"):
        densify(df, "day", [], start, dt.date(2024, 1, 30), unique=True).collect()


def test_fold_union_is_the_fold_in_one_shuffle(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (None, "n", 3.0)], "k int, a string, v double")
    b = spark.createDataFrame([(2, 7), (3, None), (None, 9), (None, 9)], "k int, b int")
    c = spark.createDataFrame([(1, [1, 2]), (4, None)], "k int, c array<int>")
    as_rows = lambda df: sorted((str(tuple(r)) for r in df.select("k", "a", "v", "b", "c").collect()))
    assert as_rows(fold_union([a, b, c], "k")) == as_rows(full_fold([a, b, c], "k"))
    assert fold_union([a, b, c], "k").columns == ["k", "a", "v", "b", "c"]
    plan = fold_union([a, b, c], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    with pytest.raises(Exception, match="repeated"):
        fold_union([a.union(a), b], "k").collect()
    with pytest.raises(ValueError, match="same name"):
        fold_union([a, a], "k")


def test_exact_totals_of_any_double_in_any_order(spark):
    from fractions import Fraction
    rng = random.Random(3)
    data = [("mix", rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randrange(-30, 40)) for _ in range(400)]
    data += [("cancel", v) for v in (1e18, 1e-12, -1e18, 1e-12, 5e-324, -5e-324, 1.7e308, -1.7e308)] + [("half", 0.125), ("half", 0.0), ("half", None)]
    data += [("nan", float("nan")), ("nan", 1.0), ("both", float("inf")), ("both", float("-inf")), ("inf", float("inf")), ("inf", 2.0), ("none", None), (None, 2.5), ("big", 1.7e308), ("big", 1.7e308)]
    measures = [("s", "sum", "v", None), ("m", "avg", "v", None), ("r", "sum", "v", 2), ("t", "avg", "v", 2)]
    found = []
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, v double").repartition(1 + 2 * seed)
        found.append({r.k: tuple(r)[1:] for r in exact_totals(df, ["k"], measures).collect()})
    assert str(found[0]) == str({k: found[1][k] for k in found[0]}) == str({k: found[2][k] for k in found[0]})
    got, exact = found[0], sum(Fraction(repr(v)) for k, v in data if k == "mix")
    assert got["mix"][:2] == (float(exact), float(exact / 400))
    assert got["cancel"][:2] == (2e-12, 2.5e-13) and got["half"] == (0.125, 0.0625, 0.13, 0.06)
    assert got["none"] == (None,) * 4 and got[None] == (2.5,) * 4 and got["inf"][0] == got["big"][0] == float("inf")
    assert str(got["nan"][0]) == str(got["both"][0]) == "nan"
    whole = exact_totals(df.where("k = 'cancel'"), [], measures).collect()
    assert len(whole) == 1 and whole[0].s == 2e-12
