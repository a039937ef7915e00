"""Reading files of differing schemas, bad records, new files and new rows only; dense numbers; checks in the write."""

import datetime as dt
import json
import os
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.operators.fill import with_file_order_key
from cityflow.operators.numbering import with_dense_number
from cityflow.operators.quality import between, checked_write, failed_names, not_null, rule_mask, run_suite
from cityflow.plans.weather import weather_gold
from cityflow.sources import append_distinct, land_new_files, overwrite, scan_merged, scan_records, split_records
from cityflow.sources.landing import DIGEST, new_rows, row_digest
from cityflow.sources.merging import common_type, survey


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------ merged scan
def test_merged_scan_settles_types_itself(spark, scratch):
    """Long and double passengers, old and new spellings of a column, files of one folder that change over time."""
    def put(name, df):
        df.coalesce(1).write.parquet(os.path.join(scratch, "raw", name))
    put("2024-01", spark.createDataFrame([(1, 2, 1.5)], "id long, passenger_count long, Airport_fee double"))
    put("2024-02", spark.createDataFrame([(2, 2.5, 1)], "id long, passenger_count double, airport_fee int"))
    put("2024-03", spark.createDataFrame([(3, 4, dt.datetime(2024, 3, 1))], "id int, passenger_count long, lpep timestamp"))
    put("2024-04", spark.createDataFrame([(4, "x")], "id long, note string"))
    df = scan_merged(spark, [os.path.join(scratch, "raw")])
    assert dict(df.dtypes) == {"id": "bigint", "passenger_count": "double", "Airport_fee": "double", "lpep": "timestamp", "note": "string"}
    got = {r.id: (r.passenger_count, r.Airport_fee, r.note) for r in df.collect()}
    assert got == {1: (2.0, 1.5, None), 2: (2.5, 1.0, None), 3: (4.0, None, None), 4: (None, None, "x")}
    plan = df.where("passenger_count > 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(passenger_count), GreaterThan(passenger_count,3.0)" in plan and "note" not in plan


def test_survey_groups_files_by_types(spark, scratch):
    for i in range(12):
        kind = "long" if i % 3 else "double"
        spark.createDataFrame([(1,)], "v long").select(F.col("v").cast(kind)).coalesce(1).write.parquet(os.path.join(scratch, f"p{i:02d}"))
    groups = survey(spark, scratch)
    assert sorted(len(g.files) for g in groups) == [4, 8]
    assert scan_merged(spark, scratch).agg(F.sum("v")).first()[0] == 12.0
    with pytest.raises(ValueError, match="no parquet files"):
        os.mkdir(os.path.join(scratch, "none"))
        survey(spark, os.path.join(scratch, "none"))


def test_common_types():
    d, t = T.DecimalType, T.TimestampType()
    for a, b, want in [(T.ByteType(), T.LongType(), T.LongType()), (T.LongType(), T.DoubleType(), T.DoubleType()), (T.FloatType(), T.IntegerType(), T.DoubleType()),
                       (d(10, 2), T.IntegerType(), d(12, 2)), (d(38, 0), d(38, 20), T.DoubleType()), (T.DateType(), t, t), (T.BooleanType(), T.LongType(), T.StringType()),
                       (T.NullType(), t, t), (T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), T.ArrayType(T.LongType()))]:
        assert common_type(a, b) == common_type(b, a) == want
    with pytest.raises(TypeError):
        common_type(T.ArrayType(t), t)


# --------------------------------------------------------- bad records
SCHEMA = "id long, value double, period struct<utc: string, parts: struct<n: int>>, tags array<string>"
GOOD = ['{"id": 1, "value": 2.5, "period": {"utc": "2024", "parts": {"n": 3}}, "tags": ["a"]}', '{"id": 2}', '{"id": 3, "value": null, "extra": {"x": 1}}', "{}"]
BAD = {'{"id": 4, "value": "abc"}': "value is not double", '{"id": 5, "period": "today", "value": 1.5}': "period is not struct<utc:string,parts:struct<n:int>>",
       '{"id": 6, "value": 1': "not a JSON object", "[1, 2]": "not a JSON object", "plain": "not a JSON object",
       '{"id": "x", "value": "y"}': "id is not bigint; value is not double", '{"id": 7, "period": {"utc": "z", "parts": {"n": "q"}}}': "period.parts.n is not int"}


def test_records_that_do_not_fit_are_kept_apart(spark, scratch):
    os.makedirs(os.path.join(scratch, "in", "deep"))
    lines = GOOD + list(BAD)
    for name, part in (("a.json", lines[::2]), ("deep/b.json", lines[1::2] + ["", "  "])):
        with open(os.path.join(scratch, "in", name), "w") as f:
            f.write("\n".join(part) + "\n")
    records = scan_records(spark, os.path.join(scratch, "in"), SCHEMA)
    good, bad = split_records(records, os.path.join(scratch, "out"))
    assert good.count() + bad.count() == len(lines)
    assert {r._record: r._reason for r in bad.collect()} == BAD
    assert all(r._source.endswith(("a.json", "b.json")) for r in bad.collect())
    assert sorted((r.id or 0, r.value) for r in good.collect()) == [(0, None), (1, 2.5), (2, None), (3, None)]
    kept = records.where("_record like '%today%'").first()
    assert (kept.id, kept.value, kept.period) == (5, 1.5, None)  # what fits is there


def test_whole_documents_and_no_records(spark, scratch):
    with open(os.path.join(scratch, "doc.json"), "w") as f:
        json.dump({"id": 1, "value": 2.0, "tags": ["x", "y"]}, f, indent=2)
    got = scan_records(spark, scratch, SCHEMA, whole_files=True).collect()
    assert len(got) == 1 and got[0].tags == ["x", "y"] and got[0]._reason is None
    os.makedirs(os.path.join(scratch, "e"))
    open(os.path.join(scratch, "e", "x.json"), "w").close()
    assert scan_records(spark, os.path.join(scratch, "e"), SCHEMA).collect() == []


# ------------------------------------------------- new files, new rows
def test_landing_reads_new_files_only(spark, scratch):
    source, target, notes = (os.path.join(scratch, d) for d in ("in", "out", "notes"))
    os.makedirs(source)

    def land(name, ids):
        with open(os.path.join(source, name), "w") as f:
            f.writelines(json.dumps({"id": i, "v": i / 2}) + "\n" for i in ids)
    run = lambda: land_new_files(spark, source, "id long, v double", target, notes, transform=lambda df: df.withColumn("w", F.col("v") * 2))
    land("one.json", range(5))
    land("two.json", range(5, 7))
    assert run() == 7 and run() == 0
    land("three.json", range(7, 20))
    assert run() == 13 and run() == 0
    full = spark.read.schema("id long, v double").json(source).withColumn("w", F.col("v") * 2)
    assert rows(spark.read.parquet(target)) == rows(full)


def test_append_distinct_moves_new_rows_only(spark, scratch):
    table = f"d_{uuid.uuid4().hex[:8]}"
    data = [(i % 40, None if i % 7 == 0 else "x" * (i % 3), float(i % 2)) for i in range(300)]
    df = spark.createDataFrame(data, "a int, b string, c double")
    parts = [df.where(f"a % 3 = {i}") for i in range(3)] + [df]
    added = [append_distinct(p, table, buckets=4, path=os.path.join(scratch, "t")) for p in parts]
    assert added[3] == 0 and sum(added) == df.distinct().count()
    assert rows(spark.table(table).drop(DIGEST)) == rows(df.dropDuplicates())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = new_rows(df.withColumn(DIGEST, row_digest(df)), spark.table(table))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    stored = plan[plan.index("Exchange") + 8:]
    assert plan.count("Exchange") == 1 and "Bucketed: true" in stored
    spark.sql(f"DROP TABLE {table}")


def test_row_digest_tells_apart_what_drop_duplicates_does(spark):
    moment = dt.datetime(2024, 1, 1, 1, 2, 3)
    data = [(moment, 0.0, "", None), (moment.replace(microsecond=1), 0.0, "", None), (moment, -0.0, "", None), (moment, 0.0, None, ""), (moment, 0.0, "", None),
            (None, float("nan"), "null", "x"), (None, float("nan"), "null", "x"), (None, None, "null", "x")]
    df = spark.createDataFrame(data, "t timestamp, d double, a string, b string").withColumn("n", F.col("t").cast("timestamp_ntz")).withColumn("s", F.struct("t", "a"))
    assert df.withColumn(DIGEST, row_digest(df)).select(DIGEST).distinct().count() == df.dropDuplicates().count() == 5


# --------------------------------------------------------- dense numbers
def test_dense_numbers_follow_files_and_integers(spark, scratch):
    for i in range(7):
        spark.range(i * 100, i * 100 + 5 + i).coalesce(1).write.parquet(os.path.join(scratch, f"day{i}"))
    scan = spark.read.option("recursiveFileLookup", "true").parquet(scratch)
    keyed = with_file_order_key(scan, "at").where("id % 3 <> 0")
    got = sorted((r.n, r.id) for r in with_dense_number(keyed, "at", block=4).collect())
    assert got == list(enumerate(sorted(i for _, i in got))) and len(got) > 30
    assert got == sorted((r.n, r.id) for r in with_dense_number(keyed.repartition(5), "at", block=64).collect())
    rng = random.Random(1)
    ids = rng.sample(range(-10**12, 10**12), 300) + [-2**63, 2**63 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "k long").repartition(6)
    assert sorted((r.n, r.k) for r in with_dense_number(df, "k", start=10).collect()) == [(i + 10, k) for i, k in enumerate(sorted(ids))]
    assert with_dense_number(df.limit(0), "k").collect() == []
    with pytest.raises(Exception, match="no order key"):
        with_dense_number(df.union(spark.createDataFrame([(None,)], "k long")), "k").collect()
    with pytest.raises(TypeError):
        with_dense_number(df.withColumn("t", F.lit("x")), "t")


# --------------------------------------------------- checks in the write
def test_checks_are_counted_in_the_write(spark, scratch):
    rules = [not_null("v"), between("v", 0, 50), between("id", None, 90)]
    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, F.col("id") * 1.0).alias("v"))
    seen = spark.sparkContext.accumulator(0)
    counted = df.where(F.udf(lambda i: seen.add(1) or True, "boolean")("id"))
    got = checked_write(counted, rules, lambda d: overwrite(d, os.path.join(scratch, "gold")))
    assert rows(got) == rows(run_suite(df, rules)) and got.schema.names == run_suite(df, rules).schema.names
    assert seen.value == 100  # one pass for check and write
    masked = rule_mask(df, rules).withColumn("names", failed_names(rules))
    assert {r.id: r.failed_rules for r in masked.where("failed_rules > 0 and (id < 20 or id > 90)").collect()} == {0: 1, 10: 1} | {i: 6 for i in range(91, 100)}
    assert masked.where("id = 95").first().names == ["expect_column_values_to_be_between(v)", "expect_column_values_to_be_between(id)"]
    for i in range(3):
        assert masked.where(F.col("failed_rules").bitwiseAND(F.lit(1 << i)) > 0).count() == run_suite(df, rules).collect()[i].unexpected_count


def test_weather_gold_is_written_and_checked_at_once(spark, scratch):
    silver = spark.createDataFrame([("2024-01-01", 10.0, 60.0, Decimal(1)), (None, 99.0, None, Decimal(-1))],
                                   "time string, temperature_2m_max float, temperature_2m_min float, precipitation_sum decimal(5,1)")
    results = weather_gold(silver, os.path.join(scratch, "gold")).collect()
    assert [(r.element_count, r.unexpected_count) for r in results] == [(2, 1)] * 4
    assert spark.read.parquet(os.path.join(scratch, "gold")).count() == 2
