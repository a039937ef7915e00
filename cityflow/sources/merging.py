"""Files of differing schemas as one table: survey, groups of one type per column, one cast per group."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole-number types from narrow to wide, then floats.
_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


@dataclass(frozen=True)
class FileGroup:
    """Files whose columns agree in type, and the union of these columns."""
    files: tuple[str, ...]
    schema: T.StructType


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type both can be cast to.

    Whole numbers widen; with a float the result is double (whole numbers
    beyond 2^53 lose their last digits), with a decimal a decimal that holds
    both; date and timestamp give timestamp; structs, arrays and maps are
    joined part by part; anything else meets as text. Nested values against
    plain ones have no common type.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    kinds = (type(a), type(b))
    if any(k in (T.StructType, T.ArrayType, T.MapType, T.BinaryType) for k in kinds):
        raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    if all(k in _WHOLE for k in kinds):
        return max((a, b), key=lambda t: _WHOLE.index(type(t)))
    if all(k in (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType) for k in kinds):
        if T.FloatType in kinds or T.DoubleType in kinds:
            return T.DoubleType()
        digits, scale = zip(*((t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE_DIGITS[type(t)], 0) for t in (a, b)))
        return T.DecimalType(min(38, max(digits) + max(scale)), max(scale)) if max(digits) + max(scale) <= 38 else T.DoubleType()
    if all(k in (T.DateType, T.TimestampType, T.TimestampNTZType) for k in kinds):
        return T.TimestampType() if T.TimestampType in kinds else T.TimestampNTZType()
    return T.StringType()


def common_schema(schemas) -> T.StructType:
    """All columns of ``schemas`` in order of first sight, each with a type all of them can be cast to.

    Names that differ in case only are one column, as in Spark.
    """
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            held = fields.get(f.name.lower())
            fields[f.name.lower()] = T.StructField(f.name, f.dataType) if held is None else T.StructField(held.name, common_type(held.dataType, f.dataType))
    return T.StructType(list(fields.values()))


def _agree(a: T.StructType, b: T.StructType) -> bool:
    """No column that both have differs in type."""
    mine = {f.name.lower(): f.dataType for f in a.fields}
    return all(mine.get(f.name.lower(), f.dataType) == f.dataType for f in b.fields)


def _is_conflict(error: Exception) -> bool:
    # The job's failure reaches Python as the plain Java error.
    return "CANNOT_MERGE_SCHEMAS" in str(error)


def _survey(spark: SparkSession, files: list[str], fmt: str) -> list[FileGroup]:
    """Groups of neighbouring files that merge.

    Spark reads the footers of all files of a probe in a job of its own; only
    where they conflict is the list halved. Schemas change with the family
    and over time, so files in order of family and name need few probes: two
    times the logarithm of the files for each change.
    """
    try:
        return [FileGroup(tuple(files), spark.read.option("mergeSchema", "true").format(fmt).load(files).schema)]
    except (PySparkException, Py4JJavaError) as error:
        if len(files) == 1 or not _is_conflict(error):
            raise
    half = len(files) // 2
    return _survey(spark, files[:half], fmt) + _survey(spark, files[half:], fmt)


def survey(spark: SparkSession, paths, fmt: str = "parquet") -> list[FileGroup]:
    """The files under ``paths`` in as few groups as there are conflicting sets of types."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}").load(paths)
    # Names only: the driver lists the files of every scan in any case.
    files = sorted((r.path for r in listed.select("path").collect()), key=_family)
    if not files:
        raise ValueError(f"no {fmt} files under {', '.join(paths)}")
    groups: list[FileGroup] = []
    for found in _survey(spark, files, fmt):
        same = next((i for i, g in enumerate(groups) if _agree(g.schema, found.schema)), None)
        if same is None:
            groups.append(found)
        else:
            groups[same] = FileGroup(groups[same].files + found.files, common_schema([groups[same].schema, found.schema]))
    return groups


def _family(path: str) -> tuple[str, str, str]:
    """Order in which files of one family and neighbouring periods stand together."""
    folder, name = path.rsplit("/", 1)
    return folder, re.sub(r"[0-9]+", "", re.sub(r"[0-9a-f]{8}-[0-9a-f-]{27}", "", name)), name


def merged(spark: SparkSession, paths, fmt: str = "parquet", tag=None) -> DataFrame:
    """All rows under ``paths`` with all columns: each group is read with its own schema, cast once, and united by name.

    Filters and column selections reach the scan of every group.
    """
    groups = survey(spark, paths, fmt)
    target = common_schema([g.schema for g in groups])
    kinds = {f.name.lower(): f for f in target.fields}

    def part(group: FileGroup) -> DataFrame:
        df = spark.read.schema(group.schema).format(fmt).load(list(group.files))
        df = tag(df) if tag else df
        own = {f.name.lower() for f in group.schema.fields}
        casts = [F.col(f"`{f.name}`").cast(kinds[f.name.lower()].dataType).alias(kinds[f.name.lower()].name) for f in group.schema.fields]
        return df.select(*casts, *[c for c in df.columns if c.lower() not in own])
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [part(g) for g in groups])
    extra = [c for c in united.columns if c.lower() not in kinds]
    return united.select(*[F.col(f"`{f.name}`") for f in target.fields], *extra)
