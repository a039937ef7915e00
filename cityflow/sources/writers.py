"""Sinks: replace a folder or table, refresh a set of tables as one, partitioned
fan-out, window replace, JSON export.

A replace never touches the old rows before the new ones are complete: they
are written to a place of their own first, so a table may be replaced by a
query that reads it, and a write that fails leaves the old rows.
"""

from __future__ import annotations

import uuid
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

#: Formats whose own overwrite replaces a table at once.
ATOMIC_FORMATS = {"delta", "iceberg", "hudi"}
#: Folders of versions a table keeps: the one in use, and the one before for queries that still read it.
KEPT_VERSIONS = 2


def overwrite(df: DataFrame, target: str, fmt: str = "parquet", skip_if_empty: bool = False,
              partition_by=None, location: str | None = None) -> bool:
    """Replace ``target`` (folder path, or table name without '/').

    A folder is written beside the old one and takes its place by renaming.
    Object stores have no rename at once; use a table there: its rows go to a
    fresh folder below ``location`` (default: beside the database's tables),
    and the catalog is switched to it. With ``skip_if_empty`` an empty input
    keeps the old content (``isEmpty`` reads at most one row). Returns whether
    anything was written.
    """
    if skip_if_empty and df.isEmpty():
        return False
    by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if "/" in target:
        _replace_folder(df, target, fmt, by)
    else:
        _replace_tables(df.sparkSession, {target: df}, fmt, {target: by}, location)
    return True


def _written(df: DataFrame, path: str, fmt: str, by) -> None:
    writer = df.write.format(fmt)
    try:
        (writer.partitionBy(*by) if by else writer).save(path)
    except BaseException:
        storage.remove(df.sparkSession, path)
        raise


def _replace_folder(df: DataFrame, target: str, fmt: str, by) -> None:
    spark, target = df.sparkSession, target.rstrip("/")
    if fmt in ATOMIC_FORMATS:
        writer = df.write.mode("overwrite").format(fmt)
        (writer.partitionBy(*by) if by else writer).save(target)
        return
    restore_folder(spark, target)
    fresh, old = storage.sibling(target, "new"), storage.sibling(target, "old")
    _written(df, fresh, fmt, by)
    had = storage.exists(spark, target)
    if had:
        storage.move(spark, target, old)
    try:
        storage.move(spark, fresh, target)
    except BaseException:
        if had:
            storage.move(spark, old, target)
        storage.remove(spark, fresh)
        raise
    if had:
        storage.remove(spark, old)


def restore_folder(spark: SparkSession, target: str) -> bool:
    """Put back the old folder if a replace was cut off between its two renames."""
    parent, name = target.rstrip("/").rsplit("/", 1)
    if storage.exists(spark, target):
        return False
    kept = [c for c in storage.children(spark, parent) if c.startswith(f"_old-{name}-")]
    if kept:
        storage.move(spark, f"{parent}/{kept[0]}", target)
    return bool(kept)


class _Switch:
    """A catalog table that is to read a folder already written."""

    def __init__(self, spark: SparkSession, name: str, df: DataFrame, fmt: str, by, base: str):
        self._spark, self._name, self._fmt, self._by, self._base = spark, name, fmt, by, base
        self.path = f"{base}/v-{uuid.uuid4().hex}"
        self._schema, self._undo, self._before, self._aside = df._jdf.schema(), [], None, None
        _written(df, self.path, fmt, by)

    def read(self) -> DataFrame:
        return self._spark.read.format(self._fmt).load(self.path)

    def _sql(self, text: str) -> None:
        self._spark.sql(text)

    def apply(self) -> None:
        """One change of the catalog where the columns stay, else the old table steps aside until the new one is there."""
        name = _quoted(self._name)
        if self._spark.catalog.tableExists(self._name):
            info = {r.col_name: r.data_type for r in self._spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
            self._before = info["Location"]
            if (info["Type"] == "EXTERNAL" and info["Provider"].lower() == self._fmt and not self._by and "# Partition Information" not in info
                    and self._spark.table(self._name)._jdf.schema().asNullable().json() == self._schema.asNullable().json()):
                self._sql(f"ALTER TABLE {name} SET LOCATION '{self.path}'")
                self._undo.append(f"ALTER TABLE {name} SET LOCATION '{self._before}'")
                self._spark.catalog.refreshTable(self._name)
                return
            self._aside = f"{self._name}_old_{uuid.uuid4().hex[:8]}"
            self._sql(f"ALTER TABLE {name} RENAME TO {_quoted(self._aside)}")
            self._undo.append(f"ALTER TABLE {_quoted(self._aside)} RENAME TO {name}")
        split = f"PARTITIONED BY ({', '.join(_quoted(b) for b in self._by)})" if self._by else ""
        self._sql(f"CREATE TABLE {name} ({self._schema.toDDL()}) USING {self._fmt} {split} LOCATION '{self.path}'")
        self._undo.append(f"DROP TABLE {name}")
        if self._by:
            self._sql(f"MSCK REPAIR TABLE {name}")

    def undo(self) -> None:
        for text in reversed(self._undo):
            self._sql(text)
        if self._before:
            self._spark.catalog.refreshTable(self._name)
        storage.remove(self._spark, self.path)

    def finish(self) -> None:
        """Drop the old definition and the versions before the last one."""
        if self._aside:
            self._sql(f"DROP TABLE {_quoted(self._aside)}")
        here = [v for v in storage.children(self._spark, self._base) if v.startswith("v-")]
        last = (self._before or "").rstrip("/").rsplit("/", 1)[-1]
        keep = {self.path.rsplit("/", 1)[-1], last} if KEPT_VERSIONS > 1 else {self.path.rsplit("/", 1)[-1]}
        for version in set(here) - keep:
            storage.remove(self._spark, f"{self._base}/{version}")


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _replace_tables(spark: SparkSession, tables: dict, fmt: str, partition_by: dict, location: str | None, check=None) -> None:
    """Write every table to a folder of its own, then switch all of them or none."""
    if fmt in ATOMIC_FORMATS and check is None:
        for name, df in tables.items():
            writer = df.write.mode("overwrite").format(fmt)
            (writer.partitionBy(*partition_by[name]) if partition_by.get(name) else writer).saveAsTable(name)
        return
    staged: list[_Switch] = []
    # If anything fails, every undo runs, the last one first.
    with ExitStack() as undo:
        for name, df in tables.items():
            database = name.split(".")[0] if "." in name else spark.catalog.currentDatabase()
            if "." in name:
                spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
            root = location or spark.catalog.getDatabase(database).locationUri
            base = f"{root.rstrip('/')}/{name.split('.')[-1].lower()}.versions"
            staged.append(_Switch(spark, name, df, fmt, partition_by.get(name) or [], base))
            undo.callback(staged[-1].undo)
        if check is not None:
            check({name: s.read() for name, s in zip(tables, staged)})
        for s in staged:
            s.apply()
        undo.pop_all()
    for s in staged:
        s.finish()


def refresh_tables(spark: SparkSession, tables: dict, fmt: str = "parquet", location: str | None = None, check=None) -> list[str]:
    """Replace each ``{name: df}`` as one unit (the CTAS refresh of a star schema).

    All tables are written first, ``check`` (a function of ``{name: written
    table}`` that raises) looks at them, and only then is the catalog
    switched. A failure anywhere leaves every old table as it was.
    """
    _replace_tables(spark, tables, fmt, {}, location, check)
    return list(tables)


def fan_out(df: DataFrame, by: str, path: str, fmt: str = "parquet") -> None:
    """One write, one folder per value of ``by`` (``by=value`` sub-folders).

    Replaces one filtered write per value: the input is computed once, and
    readers of one value get partition pruning. Rows are gathered by value
    first, so the number of files follows the data and not tasks x values;
    AQE splits a value that is too large for one file.
    """
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).format(fmt).save(path)


def replace_window(df: DataFrame, path: str, day: str, cluster_by=(), fmt: str = "parquet") -> None:
    """Replace the days (or months) that ``df`` has in a table of one folder each; others are not touched.

    Rerunning a window gives the same table. A folder's rows are sorted by
    ``cluster_by`` within their files, so that a filter on these columns
    skips row groups, and a filter on ``day`` skips folders. AQE splits a
    large day over several files.
    """
    rows = df.hint("rebalance", day).sortWithinPartitions(day, *cluster_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).format(fmt).save(path)


def export_json(df: DataFrame, path: str, as_array: bool = False) -> None:
    """Rows as JSON lines in a folder (null fields omitted).

    ``as_array`` writes one JSON array instead; meant for reports of a few
    rows (such as ``alert_rows``), which become one value.
    """
    if as_array:
        rows = df.agg(F.collect_list(F.struct("*")).alias("rows"))
        rows.select(F.to_json("rows").alias("value")).coalesce(1).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").json(path)
