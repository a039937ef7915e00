"""Substring deduplication by hashing lines, sentences or paragraphs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.common import materialise, reshuffled

#: How a text is cut: single lines; sentences inside lines (white space after ``.``, ``!`` or ``?``); stretches between blank lines.
SEPARATORS = {"line": r"\n", "sentence": r"\n|(?<=[.!?])[ \t\r\f\x0b]+", "paragraph": r"\n[ \t\r\f\x0b]*\n\s*"}
#: Words that consecutive repeated units need together before the query cuts them.
RUN_WORDS = 30
_SPACE = re.compile(r"[ \t\r\f\x0b\n]+")

#: A unit of a document, by its number among those that are not empty.
UNITS = T.StructType([T.StructField("id", T.LongType()), T.StructField("text_hash", T.LongType()),
                      T.StructField("seq", T.IntegerType()), T.StructField("digest", T.BinaryType())])


def units_of(text: str, unit: str = "line") -> Iterator[tuple[int, int, int, str]]:
    """``(start, end, where the next unit starts, normalised unit)`` in code points of the original text."""
    at = 0
    for gap in re.finditer(SEPARATORS[unit], text):
        yield at, gap.start(), gap.end(), _SPACE.sub(" ", text[at:gap.start()].lower()).strip(" ")
        at = gap.end()
    yield at, len(text), len(text), _SPACE.sub(" ", text[at:].lower()).strip(" ")


def unit_table(documents: DataFrame, unit: str = "line", min_words: int = 1,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A slim row (see ``UNITS``) of every unit that is not empty and has ``min_words`` words; null texts have none."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            columns = [[], [], [], []]
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                norms = [u[3] for u in units_of(text.as_py() or "", unit) if u[3]]
                for seq, norm in enumerate(norms):
                    if min_words <= 1 or norm.count(" ") + 1 >= min_words:
                        for column, value in zip(columns, (doc, key, seq, hashlib.blake2b(norm.encode(), digest_size=16).digest())):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=UNITS.names)
    return documents.select(F.col(id_col).cast("long"), F.xxhash64(text_col), F.col(text_col)).mapInArrow(cut, UNITS)


def mark_repeats(units: DataFrame) -> DataFrame:
    """The units that repeat an earlier one, with ``first_id`` and ``first_seq`` of the earliest equal unit.

    Earliest is the smallest id, then the smallest place; null ids come last.
    Rows equal in id and text are the same document and marked alike.
    """
    rank = F.struct(F.col("id").isNull().alias("unknown"), "id", "seq", "text_hash")
    first = (units.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("copies"))
             .where("copies > 1").select(reshuffled(F.col("digest")).alias("digest"), "first"))
    same = F.struct(F.col("id").isNull(), "id", "seq", "text_hash").eqNullSafe(F.col("first"))
    return (units.join(first, "digest").where(~same)
            .select(*units.columns, F.col("first.id").alias("first_id"), F.col("first.seq").alias("first_seq")))


_SPANS = "array<struct<start: bigint, end: bigint>>"
_CUT = f"struct<text: string, removed: {_SPANS}, kept: {_SPANS}, short: bigint>"


def cut_runs(text: str, again: list[int], unit: str, least: int) -> tuple[str, list[dict], list[dict], int]:
    """``text`` without the runs of repeats, the spans removed and kept, and how many repeats stay.

    ``again`` are the ascending numbers of the repeated units. Repeats with no
    other unit but empty ones between them are a run; a run goes if its units
    have ``least`` words together.
    """
    units = [u for u in units_of(text, unit) if u[3]]
    gone, run, words = [], [], 0
    for at, seq in enumerate(again):
        run.append(units[seq])
        words += units[seq][3].count(" ") + 1
        if at + 1 == len(again) or again[at + 1] != seq + 1:
            gone += run if words >= least else []
            run, words = [], 0
    edges = [0, *(x for start, _, resume, _ in gone for x in (start, resume)), len(text)]
    kept = [{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2]) if e > s]
    left = "".join(text[k["start"]:k["end"]] for k in kept)
    if gone and gone[-1][1] == len(text):
        # A text that lost its last unit ends at the line's end before it.
        left = re.sub(r"\n\s*\Z" if unit == "paragraph" else r"\n\Z", "", left)
    return left, [{"start": u[0], "end": u[1]} for u in gone], kept, len(again) - len(gone)


def remove_repeats(documents: DataFrame, unit: str = "line", min_words: int = 1, min_run_words: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` without their repeated units, with ``removed_spans``, ``kept_spans`` and ``n_short_repeats``.

    Every unit that is not empty (and has ``min_words`` words) is compared
    with all others; the earliest of equal ones stays. Repeats are cut where
    consecutive ones have ``min_run_words`` words together (1: all are);
    ``n_short_repeats`` counts those left.

    Spans are ``(start, end)`` in code points of the original text; the text
    is its kept spans put together, a removed unit taking the separator after
    it along (the last unit: the one before, if that is a line's end). Null
    texts stay null with empty spans, empty tables stay empty, and columns of
    the three names are replaced. What moves for a unit is its digest and
    number; places and runs are worked out again where the text is.
    """
    repeats = mark_repeats(materialise(unit_table(documents, unit, min_words, id_col, text_col), "units"))
    gone = (repeats.groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
            .agg(F.sort_array(F.collect_set("seq")).alias("__again")))
    names = [c for c in documents.columns if c not in ("removed_spans", "kept_spans", "n_short_repeats")]
    own = [f"__{i}" for i in range(len(names))]
    id_own, text = F.col(own[names.index(id_col)]), F.col(own[names.index(text_col)])
    joined = documents.select(*[F.col(c).alias(o) for c, o in zip(names, own)]).join(
        gone, id_own.eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left")

    @F.arrow_udf(_CUT)
    def cut(texts: pa.Array, again: pa.Array) -> pa.Array:
        out = []
        for whole, numbers in zip(texts, again):
            whole = whole.as_py()
            if whole is None or not numbers.is_valid:
                kept = [{"start": 0, "end": len(whole)}] if whole else []
                out.append({"text": whole, "removed": [], "kept": kept, "short": 0})
            else:
                out.append(dict(zip(("text", "removed", "kept", "short"), cut_runs(whole, numbers.as_py(), unit, min_run_words))))
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.array(out, pa.struct([("text", pa.string()), ("removed", spans), ("kept", spans), ("short", pa.int64())]))
    done = joined.withColumn("__cut", cut(text, F.col("__again")))
    return done.select(*[F.col("__cut.text").alias(c) if c == text_col else F.col(o).alias(c) for c, o in zip(names, own)],
                       F.col("__cut.removed").alias("removed_spans"), F.col("__cut.kept").alias("kept_spans"),
                       F.col("__cut.short").alias("n_short_repeats"))


def op5_unit_dedup(documents: DataFrame) -> DataFrame:
    out = remove_repeats(documents, "sentence", min_run_words=RUN_WORDS)
    return out.select("doc_id", F.size("removed_spans").alias("n_removed"), "n_short_repeats",
                      F.col("removed_spans").cast("string").alias("removed"), "text")


#: chr(1), which no text of the tables holds, marks where a unit ends: before a line's end, or behind a full stop before white space.
OP5_SQL = f"""
WITH cut AS (SELECT doc_id, text, unnest(string_split(regexp_replace(regexp_replace(text, '([.!?])([ \\t\\r\\f\\x0b]+)', '\\1' || chr(1) || '\\2' || chr(2), 'g'),
                    '\\n', chr(1) || chr(10) || chr(2), 'g'), chr(2))) AS part,
                    generate_subscripts(string_split(regexp_replace(regexp_replace(text, '([.!?])([ \\t\\r\\f\\x0b]+)', '\\1' || chr(1) || '\\2' || chr(2), 'g'),
                    '\\n', chr(1) || chr(10) || chr(2), 'g'), chr(2)), 1) AS pos FROM documents WHERE text IS NOT NULL),
     sized AS (SELECT doc_id, text, pos, part LIKE '%' || chr(1) || '%' AS ended, split_part(part, chr(1), 1) AS unit, split_part(part, chr(1), 2) AS gap FROM cut),
     placed AS (SELECT *, coalesce(sum(length(unit) + length(gap)) OVER (PARTITION BY doc_id, text ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
                       trim(regexp_replace(lower(unit), '[ \\t\\r\\f\\x0b]+', ' ', 'g'), ' ') AS n FROM sized),
     counted AS (SELECT *, length(n) - length(replace(n, ' ', '')) + 1 AS words, row_number() OVER (PARTITION BY doc_id, text ORDER BY pos) AS seq,
                        row_number() OVER (PARTITION BY n ORDER BY doc_id, start) > 1 AS again FROM placed WHERE n <> ''),
     runs AS (SELECT *, seq - row_number() OVER (PARTITION BY doc_id, text ORDER BY seq) AS run FROM counted WHERE again),
     judged AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, text, run) >= {RUN_WORDS} AS long FROM runs),
     done AS (SELECT p.doc_id, p.text, string_agg(p.unit || p.gap, '' ORDER BY p.pos) FILTER (NOT coalesce(long, FALSE)) AS cleaned,
                     count(*) FILTER (long) AS c, count(*) FILTER (NOT long) AS short,
                     string_agg('{{' || p.start || ', ' || (p.start + length(p.unit)) || '}}', ', ' ORDER BY p.pos) FILTER (long) AS spans,
                     coalesce(bool_or(long AND p.start + length(p.unit) = length(p.text)), FALSE) AS tail
              FROM placed p LEFT JOIN judged j ON p.doc_id = j.doc_id AND p.text = j.text AND p.pos = j.pos GROUP BY p.doc_id, p.text)
SELECT d.doc_id, coalesce(c, 0)::INTEGER AS n_removed, coalesce(short, 0) AS n_short_repeats, '[' || coalesce(spans, '') || ']' AS removed,
       CASE WHEN d.text IS NULL THEN NULL WHEN tail THEN regexp_replace(coalesce(cleaned, ''), '\\n$', '') ELSE coalesce(cleaned, '') END AS text
FROM documents d LEFT JOIN done ON d.doc_id = done.doc_id AND d.text = done.text
"""
