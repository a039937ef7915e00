"""Document fingerprints: one-permutation MinHash with optimal densification and b-bit storage."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.shingles import grouped_texts, mix, shingle_sets

#: Bins of a fingerprint and bits kept of each: 256 bytes. At equal size many bins of few bits estimate better than few of many.
BINS, BITS = 512, 4
_SEED = 0xA0761D6478BD642F
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Rows of the bin matrix that is densified at once.
_ROWS = 256


def _probes(bins: int, attempt: int) -> np.ndarray:
    """The bin each empty bin asks in an attempt: a hash of (bin, attempt), the same for all documents."""
    with np.errstate(over="ignore"):
        key = np.arange(bins, dtype=np.uint64) + np.uint64(attempt) * np.uint64(bins) + np.uint64(_SEED)
        return (mix(key) % np.uint64(bins)).astype(np.int64)


def densified(matrix: np.ndarray, probes: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """``matrix`` (documents x bins of least hashes, ``_EMPTY`` where there is none) with every empty bin filled.

    An empty bin asks one bin after the other, by a hash of its number and the
    attempt, until one holds a value; so two documents fill a bin alike
    whenever the bin asked first by both holds the same value. Rows without
    any value stay empty.
    """
    bins, probes = matrix.shape[1], {} if probes is None else probes
    out, some = matrix.copy(), (matrix != _EMPTY)
    row, bin_ = np.nonzero(~some & some.any(axis=1)[:, None])
    attempt = 0
    while len(row):
        if attempt not in probes:
            # Hashed attempts find a value soon; walking on bin by bin ends in any case.
            probes[attempt] = _probes(bins, attempt) if attempt < 16 * bins else (np.arange(bins) + attempt) % bins
        asked = probes[attempt][bin_]
        found = some[row, asked]
        out[row[found], bin_[found]] = matrix[row[found], asked[found]]
        row, bin_ = row[~found], bin_[~found]
        attempt += 1
    return out


def signatures(texts: list[str | None], bins: int = BINS, bits: int = BITS, probes: dict | None = None) -> np.ndarray:
    """Low-order bits of each bin (documents x bins, uint8; ``2**bits`` throughout for texts without a word).

    Each shingle is hashed once: the high half picks its bin, the whole hash
    competes there for the least. The kept bits are those of a hash of value
    and bin, so a value that fills several bins agrees by chance in each of
    them on its own.
    """
    sets, out = shingle_sets(texts), np.empty((len(texts), bins), np.uint8)
    for at in range(0, len(texts), _ROWS):
        part = sets[at:at + _ROWS]
        matrix = np.full((len(part), bins), _EMPTY)
        owner = np.repeat(np.arange(len(part)), [len(s) for s in part])
        if len(owner):
            hashes = mix(np.concatenate(part) ^ np.uint64(_SEED))
            cell = owner * bins + ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((hashes, cell))
            cell, hashes = cell[order], hashes[order]
            first = np.append(True, cell[1:] != cell[:-1])
            matrix.ravel()[cell[first]] = hashes[first]
        full = densified(matrix, probes)
        with np.errstate(over="ignore"):
            low = mix(full ^ (np.arange(bins, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))) & np.uint64((1 << bits) - 1)
        out[at:at + _ROWS] = np.where(full == _EMPTY, 1 << bits, low)
    return out


def packed(signature: np.ndarray, bits: int = BITS) -> str:
    """A signature as text (base64 of its packed bits); '' for a text without a word."""
    if signature[0] >> bits:
        return ""
    planes = (signature[:, None] >> np.arange(bits - 1, -1, -1)) & 1
    return base64.b64encode(np.packbits(planes.astype(np.uint8)).tobytes()).decode()


def unpacked(fingerprint: str, bits: int = BITS) -> np.ndarray | None:
    """The bin values of a packed fingerprint; None for ''."""
    if not fingerprint:
        return None
    flat = np.unpackbits(np.frombuffer(base64.b64decode(fingerprint), np.uint8))
    return np.packbits(flat[:len(flat) // bits * bits].reshape(-1, bits), axis=1).ravel() >> (8 - bits)


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> float:
    """Estimated Jaccard similarity of two signatures, without the share of bins that agree by chance.

    Different values agree in ``bits`` bits with probability ``2**-bits``, so
    ``J + (1 - J) * 2**-bits`` of the bins agree; the estimate is held between
    0 and 1. Two texts without a word are alike (1), one without is unlike any
    other (0).
    """
    if a[0] >> bits or b[0] >> bits:
        return float(bool(a[0] >> bits) and bool(b[0] >> bits))
    chance = 2.0 ** -bits
    return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def fingerprint_likeness(a: str, b: str, bits: int = BITS) -> float:
    """``likeness`` of two packed fingerprints."""
    x, y = unpacked(a, bits), unpacked(b, bits)
    return likeness(x, y, bits) if x is not None and y is not None else float(x is None and y is None)


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``(id, fingerprint)`` of every row; one pass without a shuffle.

    Null and blank texts have the fingerprint '', texts under five words are
    one shingle. Rows may repeat, ids may be null.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes: dict = {}
        for batch in batches:
            for first, texts in grouped_texts(batch.column(1)):
                marks = [packed(s, bits) for s in signatures(texts, bins, bits, probes)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(marks, pa.string())], names=["id", "fingerprint"])
    return documents.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(sign, "id long, fingerprint string")


NEIGHBOURS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def edited(text: str, after: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many (or all) of ``after``."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def compare_neighbours(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``NEIGHBOURS`` of every row: its fingerprint, that of its edited text, and their likenesses.

    The next document is the next row by ascending id, that of the last one
    the first. Null texts are empty; null ids come first; rows of one id
    follow each other by a hash of their text. A single row is its own next.

    Texts are shuffled once: ranges of ids (as many as shuffle partitions,
    with cuts from the quantiles of the id column) are sorted and read in
    order, and the first row of each range also goes to the end of the range
    before it. Only cuts and first rows' keys, one a range, reach the driver.
    """
    spark = documents.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = F.col("id").isNotNull()
    # Null ids come first and sort as the smallest number; the flag keeps them apart from that id.
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = documents.select(F.col(id_col).cast("long").alias("id"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = ids.agg(F.percentile_approx("id", shares, 100 * ranges).alias("cuts")).first().cuts if shares else None
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.arrow_udf("int")
    def range_of(column: pa.Array) -> pa.Array:
        values = column.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(cuts, values, side="right").astype(np.int32))

    key = F.struct(known.alias("known"), "id", "mark")
    placed = docs.withColumn("mark", F.xxhash64("text"))
    first = {r.range: r.first for r in documents.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"))
             .withColumn("range", range_of("id")).groupBy("range").agg(F.min(key).alias("first")).collect()}
    used = sorted(first)
    # (range, key of its first row, range before it; the first row of all follows the last range)
    heads = spark.createDataFrame([(r, first[r].id, first[r].mark, used[i - 1]) for i, r in enumerate(used)],
                                  "range int, first_id long, first_mark long, before int")
    placed = placed.withColumn("range", range_of("id")).join(F.broadcast(heads), "range")
    is_first = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark"))
    # Rows equal in id and text are one another's like: each goes along as a tail, the first of them is used.
    targets = F.when(is_first, F.array(F.struct(F.col("range").alias("at"), F.lit(False).alias("tail")),
                                       F.struct(F.col("before").alias("at"), F.lit(True).alias("tail")))
                     ).otherwise(F.array(F.struct(F.col("range").alias("at"), F.lit(False).alias("tail"))))
    moved = placed.select(F.explode(targets).alias("to"), "id", "mark", "text").select("to.at", "to.tail", known.alias("known"), "id", "mark", "text")
    ordered = moved.repartitionById(ranges, "at").sortWithinPartitions("at", "tail", "known", "id", "mark")
    return ordered.select("at", "tail", "id", "text").mapInArrow(_in_order, NEIGHBOURS)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures of the rows of sorted ranges; a row is answered when the one after it is read."""
    probes: dict = {}
    last, closed = None, None  # (range, id, text, signature) that waits for its next; range whose tail was used
    for batch in batches:
        for first, texts in grouped_texts(batch.column(3)):
            n = len(texts)
            ats, tails, ids = (batch.column(i).slice(first, n).to_pylist() for i in range(3))
            marks = signatures(texts, probes=probes)
            pending = []  # (id, text, signature, next text, next signature)
            for at, tail, doc, text, mark in zip(ats, tails, ids, texts, marks):
                if tail and closed == at:
                    continue
                if last is not None:
                    pending.append((*last, text, mark))
                last, closed = (None, at) if tail else ((doc, text, mark), closed)
            if pending:
                yield _compared(pending, probes)


def _compared(pending: list[tuple], probes: dict) -> pa.RecordBatch:
    changed = [edited(text, after) for _, text, _, after, _ in pending]
    marks = signatures(changed, probes=probes)
    return pa.RecordBatch.from_arrays([
        pa.array([p[0] for p in pending], pa.int64()), pa.array([len(p[1]) for p in pending], pa.int64()),
        pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
        pa.array([packed(p[2]) for p in pending], pa.string()), pa.array([packed(m) for m in marks], pa.string()),
        pa.array([likeness(p[2], m) for p, m in zip(pending, marks)], pa.float64()),
        pa.array([likeness(p[2], p[4]) for p in pending], pa.float64())], names=NEIGHBOURS.names)


def op12_fingerprints(documents: DataFrame) -> DataFrame:
    return compare_neighbours(documents).withColumnRenamed("id", "doc_id")
