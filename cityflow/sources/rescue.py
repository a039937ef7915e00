"""Records that do not fit their schema, kept apart with a reason and their source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns added to parsed records.
RECORD, REASON, SOURCE = "_record", "_reason", "_source"
_CORRUPT = "_corrupt_record"
NOT_JSON = "not a JSON object"


def _schema(schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _misfits(parsed: Column, raw: Column, schema: T.StructType, path: str = "$", name: str = "") -> list[Column]:
    """For each field: its path and type if the record has a value there that the parse lost, else null.

    A lost struct is named itself, not each of its fields.
    """
    out = []
    for f in schema.fields:
        at, label = f"{path}['{f.name}']", f"{name}{f.name}"
        value, there = parsed[f.name], F.try_variant_get(raw, at, "string").isNotNull()
        lost = there & value.isNull()
        out.append(F.when(lost, F.lit(f"{label} is not {f.dataType.simpleString()}")))
        if isinstance(f.dataType, T.StructType):
            out += [F.when(value.isNotNull(), m) for m in _misfits(value, raw, f.dataType, at, f"{label}.")]
    return out


def parse_records(df: DataFrame, col: str, schema, out: str = "doc") -> DataFrame:
    """JSON text in ``col`` as a struct ``out``, with ``_reason`` why a record does not fit (null: it does).

    What fits is kept field by field; a value of the wrong type is null in
    ``out`` and named in the reason, so that a mistyped value is told from a
    missing one. Text that is no JSON object has no fields at all. Null text
    has the reason of text that is no object. ``col`` stays as it is.
    """
    schema = _schema(schema)
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    text = F.col(col)
    parsed = df.withColumn(out, F.from_json(text, wide, {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"}))
    misfit = F.col(out)[_CORRUPT].isNotNull()
    raw = F.try_parse_json(text)
    whole = raw.isNotNull() & F.schema_of_variant(raw).startswith("OBJECT")
    reasons = F.concat_ws("; ", *_misfits(F.col(out), raw, schema))
    reason = (F.when(text.isNull() | F.col(out).isNull(), F.lit(NOT_JSON))
              .when(misfit, F.when(~F.coalesce(whole, F.lit(False)), F.lit(NOT_JSON))
                    .when(reasons == "", F.lit("does not fit the schema")).otherwise(reasons)))
    return parsed.withColumn(REASON, reason).withColumn(out, F.struct(*[F.col(out)[f.name].alias(f.name) for f in schema.fields]))


def scan_records(spark: SparkSession, path: str, schema, whole_files: bool = False) -> DataFrame:
    """JSON records under ``path`` with ``_record`` (their text), ``_reason`` and ``_source`` (their file).

    One record a line, or one a file (``whole_files``). A null ``_reason``
    marks a record that fits; see :func:`parse_records`. Lines of white space
    are no records.
    """
    schema = _schema(schema)
    lines = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=whole_files)
    lines = lines.select(F.col("value").alias(RECORD), F.col("_metadata.file_path").alias(SOURCE)).where(F.trim(RECORD) != "")
    parsed = parse_records(lines, RECORD, schema, "_doc")
    return parsed.select(*[F.col("_doc")[f.name].alias(f.name) for f in schema.fields], RECORD, REASON, SOURCE)


def split_records(records: DataFrame, path: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Write scanned records once, good rows and quarantine in folders of their own; return both.

    The good rows have the schema's columns and their source; the quarantine
    has the record's text, the reason and the source.
    """
    records.withColumn("_state", F.when(F.col(REASON).isNull(), "good").otherwise("quarantine")).write.partitionBy("_state").format(fmt).save(path)
    back = records.sparkSession.read.format(fmt).load(path)
    good = back.where("_state = 'good'").drop("_state", RECORD, REASON)
    return good, back.where("_state = 'quarantine'").select(RECORD, REASON, SOURCE)
