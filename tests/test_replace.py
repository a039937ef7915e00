"""Replacing folders, tables and stars: the old rows stay until the new ones are complete."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from cityflow.plans.star import refresh_star, unknown_dates
from cityflow.sources import storage
from cityflow.sources.readers import scan_table
from cityflow.sources.writers import overwrite, refresh_tables, replace_window, restore_folder


def failing(df):
    return df.withColumn("id", F.when(F.col("id") < 0, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("long")))


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.fixture()
def name(spark, scratch):
    table = f"t_{uuid.uuid4().hex[:8]}"
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_folder_is_replaced_by_a_query_that_reads_it(spark, scratch):
    path = os.path.join(scratch, "t")
    overwrite(spark.range(10), path)
    overwrite(scan_table(spark, path).where("id % 2 = 0"), path)
    overwrite(scan_table(spark, path).withColumn("id", F.col("id") + 100), path)
    assert ids(scan_table(spark, path)) == [100, 102, 104, 106, 108]
    with pytest.raises(Exception, match="no"):
        overwrite(failing(scan_table(spark, path)), path)
    assert ids(scan_table(spark, path)) == [100, 102, 104, 106, 108] and os.listdir(scratch) == ["t"]


def test_folder_of_a_replace_that_was_cut_off_is_restored(spark, scratch):
    path = os.path.join(scratch, "t")
    overwrite(spark.range(3), path)
    storage.move(spark, path, storage.sibling(path, "old"))
    assert restore_folder(spark, path) and not restore_folder(spark, path)
    assert ids(scan_table(spark, path)) == [0, 1, 2]
    storage.move(spark, path, storage.sibling(path, "old"))
    with pytest.raises(Exception, match="no"):
        overwrite(failing(spark.range(1)), path)
    assert ids(scan_table(spark, path)) == [0, 1, 2]


def test_table_is_switched_and_keeps_one_old_version(spark, scratch, name):
    overwrite(spark.range(6), name, location=scratch)
    for _ in range(3):
        before = spark.table(name)
        overwrite(spark.table(name).withColumn("id", F.col("id") + 1), name, location=scratch)
    assert ids(spark.table(name)) == [3, 4, 5, 6, 7, 8] and ids(before) == [2, 3, 4, 5, 6, 7]
    assert len(os.listdir(os.path.join(scratch, f"{name}.versions"))) == 2
    with pytest.raises(Exception, match="no"):
        overwrite(failing(spark.table(name)), name, location=scratch)
    assert ids(spark.table(name)) == [3, 4, 5, 6, 7, 8]
    assert not overwrite(spark.range(0), name, skip_if_empty=True, location=scratch) and spark.table(name).count() == 6
    overwrite(spark.range(0), name, location=scratch)
    assert spark.table(name).count() == 0


def test_table_may_change_columns_and_partitions_and_replace_a_managed_one(spark, scratch, name):
    spark.range(4).write.saveAsTable(name)
    overwrite(spark.table(name).withColumn("part", F.col("id") % 2), name, partition_by="part", location=scratch)
    assert spark.table(name).columns == ["id", "part"] and spark.table(name).where("part = 1").count() == 2
    overwrite(spark.table(name).where("id > 0"), name, partition_by=["part"], location=scratch)
    assert ids(spark.table(name)) == [1, 2, 3]
    overwrite(spark.table(name).select(F.lit("x").alias("other")), name, location=scratch)
    assert [tuple(r) for r in spark.table(name).distinct().collect()] == [("x",)]
    assert [t.name for t in spark.catalog.listTables() if "_old_" in t.name] == []


def test_refresh_switches_all_tables_or_none(spark, scratch):
    one, two = (f"r{i}_{uuid.uuid4().hex[:6]}" for i in range(2))
    assert refresh_tables(spark, {one: spark.range(3), two: spark.range(4)}, location=scratch) == [one, two]
    with pytest.raises(Exception, match="no"):
        refresh_tables(spark, {one: spark.range(9), two: failing(spark.range(2))}, location=scratch)
    with pytest.raises(ValueError, match="checked"):
        def check(written):
            assert {n: df.count() for n, df in written.items()} == {one: 9, two: 1}
            raise ValueError("checked")
        refresh_tables(spark, {one: spark.range(9), two: spark.range(1)}, location=scratch, check=check)
    assert (spark.table(one).count(), spark.table(two).count()) == (3, 4)
    # The second switch fails in the catalog: the first one is taken back, also one that changed its columns.
    with pytest.raises(Exception):
        refresh_tables(spark, {one: spark.range(5).withColumn("more", F.lit(1)), "no such/name": spark.range(2)}, location=scratch)
    assert spark.table(one).columns == ["id"] and spark.table(one).count() == 3
    for table in (one, two):
        assert len(os.listdir(os.path.join(scratch, f"{table}.versions"))) == 1
        spark.sql(f"DROP TABLE {table}")


def test_star_with_a_date_outside_its_dimension_is_not_switched(spark, scratch):
    dim, fact = f"dim_{uuid.uuid4().hex[:6]}", f"fact_{uuid.uuid4().hex[:6]}"
    rows = lambda *days: spark.createDataFrame([(d, 1.5) for d in days], "Date date, rate double")
    span = dict(start=dt.date(2024, 1, 1), end=dt.date(2024, 1, 31), dim=dim, location=scratch)
    refresh_star(spark, {fact: (rows(dt.date(2024, 1, 2)), "Date")}, **span)
    with pytest.raises(ValueError, match=f"{fact}.*2"):
        refresh_star(spark, {fact: (rows(dt.date(2024, 1, 3), dt.date(2023, 1, 3), None), "Date")}, **span)
    assert [r.DateKey for r in spark.table(fact).collect()] == [dt.date(2024, 1, 2)] and spark.table(dim).count() == 31
    assert unknown_dates(spark.table(dim), {fact: spark.table(fact)}) == {}
    for table in (dim, fact):
        spark.sql(f"DROP TABLE {table}")


def test_window_replace_leaves_other_days(spark, scratch):
    path = os.path.join(scratch, "days")
    first = spark.range(60).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 6).cast("int")).alias("day"))
    replace_window(first, path, "day", ["id"])
    stamp = lambda day: {f: os.stat(os.path.join(path, f"day={day}", f)).st_mtime_ns for f in os.listdir(os.path.join(path, f"day={day}"))}
    before = stamp("2024-01-02")
    for _ in range(2):
        replace_window(first.where("day = '2024-01-03'").withColumn("id", F.col("id") + 1000), path, "day", ["id"])
    assert stamp("2024-01-02") == before
    got = spark.read.parquet(path)
    assert got.count() == 60 and got.where("id >= 1000").select("day").distinct().count() == 1
    plan = got.where("day = date'2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and len(got.where("day = date'2024-01-03'").inputFiles()) >= 1
