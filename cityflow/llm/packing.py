"""Shortest-pack-first packing over the length histogram."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.common import materialise

#: Rows of one (length, block) group, on average, when ranks are dealt.
RANK_BLOCK_ROWS = 4096
#: Code points handed to the tokenizer at once.
PIECE_CHARS = 1 << 16
#: Ids appended to each document.
END_ID = 1

# The split pattern of the public byte-level vocabulary, and its byte alphabet.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

PIECES = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType())])


class ByteEncoder:
    """Ids of the byte-level vocabulary in a ``tokenizers`` file.

    The file's vocabulary is loaded as ranks of ``tiktoken``, which merges
    the same pairs in the same order several times faster; the tests compare
    the ids with ``tokenizers`` itself. Strings of special tokens get their
    own ids, as there.
    """

    def __init__(self, path: str):
        import tiktoken
        spec = json.loads(open(path, encoding="utf-8").read())
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        letters = {chr(b): b for b in PRINTABLE}
        letters |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}
        ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
        self._encoding = tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        """uint32 ids of the whole text.

        A long text is cut where white space follows something else; no id
        ever spans such a place.
        """
        parts, at = [], 0
        while len(text) - at > PIECE_CHARS:
            cut = _BOUNDARY.search(text, at + PIECE_CHARS)
            if cut is None:
                break
            parts.append(self._encode(text[at:cut.start() + 1]))
            at = cut.start() + 1
        parts.append(self._encode(text[at:]))
        return np.concatenate(parts)

    def _encode(self, text: str) -> np.ndarray:
        return np.asarray(self._encoding.encode(text, allowed_special="all"), dtype="<u4")


_BOUNDARY = re.compile(r"\S(?=\s)")


def tokenized_pieces(documents: DataFrame, tokenizer_path: str, capacity: int = 2048,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids and the end id, cut every ``capacity`` ids: ``(id, start, length, ids_crc32, doc_tokens)``.

    Null text is empty: one piece with the end id. The ids themselves stay in
    the task; a document's row becomes ceil(ids / capacity) slim rows.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(tokenizer_path)
        for batch in batches:
            rows = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start:start + capacity]
                    for column, value in zip(rows, (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], names=PIECES.names)
    return documents.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, PIECES)


def pack_histogram(counts: dict[int, int], capacity: int) -> tuple[pd.DataFrame, int]:
    """Places every length of the histogram; ``(runs, number of sequences)``.

    Longest lengths first; each goes to the shortest open pack (the most room
    left), all packs of one pattern at a time, so the work depends on the
    number of different lengths and patterns and not on the counts. A run
    says: pieces of ``length`` with ranks ``rank`` .. ``rank + packs - 1`` go
    at ``offset`` of sequences ``sequence`` .. ``sequence + packs - 1``.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges (first sequence, packs)
    opened = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            fits = max((r for r in room if r >= length), default=None)
            if fits is None:
                packs = -(-left // (capacity // length))
                room.setdefault(capacity, []).append((opened, packs))
                opened += packs
                continue
            first, packs = room[fits].pop()
            if not room[fits]:
                del room[fits]
            used = min(packs, left)
            runs.append((length, rank, used, first, capacity - fits))
            if used < packs:
                room.setdefault(fits, []).append((first + used, packs - used))
            if fits > length:
                room.setdefault(fits - length, []).append((first, used))
            rank, left = rank + used, left - used
    return pd.DataFrame(runs, columns=["length", "rank", "packs", "sequence", "offset"], dtype="int64"), opened


def with_rank(pieces: DataFrame) -> DataFrame:
    """``rank``: 0, 1, ... among the pieces of a length, without one task per length.

    Pieces are numbered inside (length, block), blocks being hashes sized by
    the row count; the blocks' offsets come from their counts alone.
    """
    from pyspark.sql import Window
    blocks = max(1, -(-pieces.count() // RANK_BLOCK_ROWS))
    keyed = pieces.withColumn("block", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(blocks)))
    counts = keyed.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "block").orderBy("id", "start", "ids_crc32")
    return (keyed.withColumn("at", F.row_number().over(inside) - 1).join(first, ["length", "block"])
            .withColumn("rank", F.col("first") + F.col("at")).drop("block", "first", "at"))


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of ``length`` 1 .. ``capacity``.

    The histogram (at most ``capacity`` rows) and the runs, whose number
    depends on the lengths and not on the documents, are all the driver sees.
    Equal rows are separate pieces and get places of their own. An empty
    table gives an empty result.
    """
    pieces = materialise(with_rank(materialise(pieces, "pieces")), "ranked")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs, _ = pack_histogram(counts, capacity)
    table = {int(k): tuple(v[c].to_numpy() for c in ("rank", "sequence", "offset")) for k, v in runs.groupby("length")}
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, offset = np.empty(len(frame), np.int64), np.empty(len(frame), np.int64)
            for length, at in frame.groupby("length").indices.items():
                ranks, first, offsets = table[int(length)]
                rank = frame["rank"].to_numpy()[at]
                run = np.searchsorted(ranks, rank, side="right") - 1
                sequence[at], offset[at] = first[run] + rank - ranks[run], offsets[run]
            yield frame.assign(sequence_id=sequence, offset=offset)
    return pieces.mapInPandas(place, schema).drop("rank")


def op10_packing(documents: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    out = pack(tokenized_pieces(documents, tokenizer_path, capacity), capacity)
    return out.withColumnRenamed("id", "doc_id")
