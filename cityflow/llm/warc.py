"""WARC archives as a chunked record table."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.common import materialise, reshuffled, shared_path

#: Payload bytes of one WARC record; a longer payload goes on in continuation records.
SEGMENT_BYTES = 1 << 20
#: Payload bytes of one row of the chunk table.
CHUNK_BYTES = 1 << 16
#: Equal payloads shorter than this are stored again rather than revisited.
MIN_REVISIT_BYTES = 100

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"

CHUNKS = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("chunk_no", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("size", T.LongType()),
    T.StructField("running_sha256", T.StringType()), T.StructField("is_last", T.BooleanType()),
    T.StructField("header_sha256", T.StringType()), T.StructField("chunk", T.BinaryType())])


def with_revisits(records: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds ``digest``, ``bytes`` and ``refers_to`` to ``(id, uri, payload)``.

    Of records with equal payloads of at least ``min_bytes`` the smallest id
    is the response and ``refers_to`` of the others names it. Rows that
    repeat the smallest id are all responses; a null id is never referred to
    and a group of null ids has responses only.
    """
    keyed = records.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})
    first = (keyed.where(F.col("bytes") >= min_bytes).groupBy("digest")
             .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(reshuffled(F.col("digest")).alias("digest"), "first"))
    return (keyed.join(first, "digest", "left")
            .withColumn("refers_to", F.when(F.col("first") != F.coalesce(F.col("id"), F.col("first")), F.col("first")))
            .drop("first"))


def _urn(id_col: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(">"))


def write_warc(records: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Writes ``(id, uri, payload binary, digest, bytes, refers_to)`` as WARC files below ``path``.

    A payload is cut into segments: the first in a response record, the rest
    in continuation records right after it, as the format provides; a row in
    flight is a segment, never a second copy of the payload. A revisit has no
    payload. Spark's own writer compresses and commits the files, so tasks of lost executors
    leave nothing behind. Line breaks and control characters in a uri are
    escaped; null uri and null payload are empty.
    """
    uri = F.regexp_replace(F.coalesce(F.col("uri"), F.lit("")), r"[\x00-\x20\x7f]", "_")
    segments = F.when(F.col("refers_to").isNotNull(), 1).otherwise(
        F.greatest(F.lit(1), F.ceil(F.col("bytes") / segment_bytes)).cast("int"))
    rows = records.withColumns({"uri": uri, "segments": segments}).withColumn("segment", F.explode(F.sequence(F.lit(1), "segments")))
    block = F.when(F.col("refers_to").isNotNull(), F.lit(b"")).otherwise(
        F.expr(f"substring(payload, (segment - 1) * {segment_bytes} + 1, {segment_bytes})"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(EOL))
    when = lambda cond, value: F.when(cond, value).otherwise(F.lit(""))
    first, revisit, cut = F.col("segment") == 1, F.col("refers_to").isNotNull(), F.col("segments") > 1
    kind = F.when(revisit, "revisit").when(first, "response").otherwise("continuation")
    record = F.when(first, _urn(F.col("id"))).otherwise(
        F.concat(F.regexp_replace(_urn(F.col("id")), ">$", ""), F.lit(":segment:"), F.col("segment").cast("string"), F.lit(">")))
    header = F.concat(
        F.lit(VERSION + EOL), line("WARC-Type", kind), line("WARC-Record-ID", record),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z" + EOL), line("WARC-Target-URI", F.col("uri")),
        when(first, line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))),
        when(revisit, F.concat(line("WARC-Refers-To", _urn(F.col("refers_to"))), F.lit(f"WARC-Profile: {REVISIT_PROFILE}{EOL}"))),
        when(cut, line("WARC-Segment-Number", F.col("segment"))),
        when(~first, line("WARC-Segment-Origin-ID", _urn(F.col("id")))),
        when(cut & (F.col("segment") == F.col("segments")), line("WARC-Segment-Total-Length", F.col("bytes"))),
        F.lit("Content-Type: text/html; charset=utf-8" + EOL),
        line("Content-Length", F.octet_length("block")), F.lit(EOL))
    (rows.withColumn("block", block)
     .select(F.concat(F.encode(header, "UTF-8"), F.col("block")).cast("string").alias("value"))
     .write.option("lineSep", EOL + EOL).option("compression", "gzip").text(path))


class _Stream:
    """Buffered bytes of an archive on any file system Arrow opens; gzip members are joined."""

    def __init__(self, path: str):
        from pyarrow import fs
        local = re.sub(r"^file:/+", "/", path)
        system, name = (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)
        raw = system.open_input_stream(name, compression=None, buffer_size=1 << 20)
        self._in = io.BufferedReader(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw, 1 << 20)

    def header(self) -> dict[str, str] | None:
        """The next record's fields in lower case; None at the end."""
        line = self._in.readline()
        while line in (b"\r\n", b"\n"):
            line = self._in.readline()
        if not line:
            return None
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := self._in.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        return fields

    def block(self, length: int, size: int) -> Iterator[bytes]:
        while length:
            part = self._in.read(min(length, size))
            if not part:
                raise ValueError("the archive ends within a record")
            length -= len(part)
            yield part


def _chunks(path: str, size: int) -> Iterator[tuple]:
    """Rows of CHUNKS of one archive; one row is held back, to mark the last of its record."""
    stream, held, state = _Stream(path), None, None
    while (fields := stream.header()) is not None:
        kind = fields.get("warc-type", "")
        if kind != "continuation":
            if held:
                yield (*held[:8], True, *held[9:])
            sha, offset, number = hashlib.sha256(), 0, 0
            state = (fields.get("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-refers-to"))
            digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
            held = (*state, 0, 0, 0, sha.hexdigest(), False, digest, b"")
        elif state is None or fields.get("warc-segment-origin-id") != state[0]:
            raise ValueError("a continuation without its first segment")
        for part in stream.block(int(fields.get("content-length", 0)), size):
            if number:
                yield held
            sha.update(part)
            held = (*state, number, offset, len(part), sha.hexdigest(), False, digest, part)
            offset, number = offset + len(part), number + 1
    if held:
        yield (*held[:8], True, *held[9:])


def read_warc(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, payload: bool = True) -> DataFrame:
    """The chunk table of all archives (plain or .gz) below ``path``, see ``CHUNKS``.

    One task streams an archive: a payload of any size becomes rows of at
    most ``chunk_bytes``, each with the digest of the payload up to its end,
    so ``is_last`` rows carry the payload digest and length and no task holds
    a record. With ``payload=False`` chunks are left null. Every record has
    at least one row; a folder without archives gives an empty table.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    n = max(1, files.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([pa.field(f.name, {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}.get(f.dataType.typeName(), pa.string())) for f in CHUNKS])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in _chunks(name, chunk_bytes):
                    rows.append(row if payload else (*row[:10], None))
                    held += len(row[10]) * payload + 200
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return files.repartition(n).mapInArrow(read, CHUNKS)


def record_table(chunks: DataFrame) -> DataFrame:
    """``(id, payload_bytes, payload_digest, record_type, refers_to)`` of response and revisit records.

    A response's figures are of the streamed payload; a revisit has those of
    the response it refers to. Raises where a streamed digest differs from
    the header's.
    """
    last = materialise(chunks.where("is_last").select(
        "record_id", "record_type", "refers_to", (F.col("offset") + F.col("size")).alias("payload_bytes"),
        F.col("running_sha256").alias("payload_digest"), "header_sha256"), "warc-records")
    number = lambda c: F.regexp_extract(c, r"^<urn:record:(-?\d+)>$", 1).try_cast("long")
    own = last.where("record_type = 'response'")
    checked = own.withColumn("payload_digest", F.when(F.col("payload_digest") == F.col("header_sha256"), F.col("payload_digest"))
                             .otherwise(F.raise_error(F.concat(F.lit("payload digest differs in "), F.col("record_id")))))
    visits = last.where("record_type = 'revisit'").select(
        "record_id", "record_type", F.col("refers_to").alias("to"), F.col("header_sha256").alias("payload_digest"))
    # Equal ids with equal payloads may repeat; one length per (id, digest) is enough.
    sizes = own.groupBy("record_id", "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    sizes = sizes.select(reshuffled(F.col("record_id")).alias("to"), F.col("payload_digest"), "payload_bytes")
    met = visits.join(sizes, ["to", "payload_digest"], "left").select(
        number(F.col("record_id")).alias("id"), "payload_bytes", "payload_digest", "record_type", number(F.col("to")).alias("refers_to"))
    return checked.select(number(F.col("record_id")).alias("id"), "payload_bytes", "payload_digest", "record_type",
                          F.lit(None).cast("long").alias("refers_to")).union(met)


def op1_warc(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    records = pages.select(F.col("page_id").cast("long").alias("id"), F.col("url").alias("uri"),
                           F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    path = shared_path(spark, "warc")
    write_warc(with_revisits(records), path)
    out = record_table(read_warc(spark, path, payload=False))
    return out.withColumnRenamed("id", "page_id")


OP1_SQL = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
     r AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to FROM r
"""
