"""Folders of any file system Spark can write to, through Hadoop's file system interface."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; an error if the file system refuses or ``target`` is there."""
    fs, p = _path(spark, source)
    goal = _path(spark, target)[1]
    if fs.exists(goal) or not fs.rename(p, goal):
        raise OSError(f"could not move {source} to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder (none if it is not there)."""
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def sibling(path: str, kind: str) -> str:
    """A fresh hidden folder beside ``path``, which scans of the parent leave out."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_{kind}-{name}-{uuid.uuid4().hex}"
