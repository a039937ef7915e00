"""Cross-tokenizer alignment with an identity-map fast path.

A text is encoded by two tokenizers, A (byte-level BPE) and B (sentence
pieces). Byte offsets where a token of both ends cut the text into groups. In
a group of one token each the two ids stand for the same bytes, and nearly
always they are the pair that a map from A ids to B ids foretells. The pairs of
the map are counted in vectors as long as A's vocabulary and never shuffled;
only the other links, those of irregular groups, are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.common import materialise
from cityflow.llm.packing import ByteEncoder
from cityflow.llm.shingles import grouped_texts

#: Code points handed to a tokenizer at once.
PIECE_CHARS = 1 << 16
#: A pair of ids as one number: A's id times this, plus B's.
PAIR_BASE = 1 << 32
_CUT = re.compile(r"(?<=\S) (?=\S)")

ROWS = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("id", T.LongType()), T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()), T.StructField("n_links", T.LongType()),
    T.StructField("groups_sha256", T.StringType()),
    T.StructField("same", T.ArrayType(T.IntegerType())), T.StructField("same_times", T.ArrayType(T.IntegerType())),
    T.StructField("odd", T.ArrayType(T.LongType())), T.StructField("odd_times", T.ArrayType(T.IntegerType()))])


class Pair:
    """Both tokenizers, the bytes of their ids, and the map of A ids to the B ids of the same bytes."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self._a = ByteEncoder(a_path)._encoding
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [b""] * self._a.n_vocab
        for i in range(self._a.n_vocab):
            try:
                self.a_bytes[i] = self._a.decode_single_token_bytes(i)
            except KeyError:  # an id that stands for nothing
                pass
        pieces = [self._b.id_to_piece(i) for i in range(self._b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        # A byte of its own as piece goes before the fallback to it; -1: no such piece.
        ids = {x: i for i, x in reversed(list(enumerate(self.b_bytes))) if self._b.is_byte(i)}
        ids |= {x: i for i, x in reversed(list(enumerate(self.b_bytes)))
                if not (self._b.is_byte(i) or self._b.is_control(i) or self._b.is_unknown(i))}
        self.same = np.array([ids.get(x, -1) if x else -1 for x in self.a_bytes])
        # Only if no piece holds a space after something else can a text be cut before a space.
        self._cuttable = not any(re.search("[^▁]▁", p) for p in pieces)
        width = max(len(str(max(len(self.a_bytes), len(self.b_bytes)))), 1) + 1
        self._digits = np.zeros((max(len(self.a_bytes), len(self.b_bytes)), width), np.uint8)
        self._length = np.zeros(len(self._digits), np.int64)
        for i in range(len(self._digits)):
            text = str(i).encode()
            self._digits[i, :len(text)], self._length[i] = np.frombuffer(text, np.uint8), len(text)

    def _parts(self, text: str) -> Iterator[str]:
        """Pieces that both tokenizers read alike alone and in the text, each taken to follow a space."""
        at = 0
        while self._cuttable and len(text) - at > PIECE_CHARS:
            cut = _CUT.search(text, at + PIECE_CHARS)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.end()
        yield text[at:]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of space and text, B's ids of the text; none if the text is empty or the bytes of either differ from space and text."""
        a, b = [], []
        if text:
            for part in self._parts(text):
                a += self._a.encode_ordinary(" " + part)
                b += self._b.encode(part, num_threads=1)
            whole = (" " + text).encode()
            if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
                a, b = [], []
        return np.array(a, np.int64), np.array(b, np.int64)

    def written(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;...`` of consecutive groups as bytes, and the length of each token's part in order of writing.

        ``a_group`` and ``b_group`` are the ascending group numbers of the tokens.
        """
        n = len(a) + len(b)
        ids, ends = np.empty(n, np.int64), np.empty(n, np.uint8)
        before = np.searchsorted(b_group, a_group, "left")
        place_a, place_b = np.arange(len(a)) + before, np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
        ids[place_a], ids[place_b] = a, b
        ends[place_a] = np.where(np.append(a_group[1:] != a_group[:-1], True), ord("|"), ord(","))
        ends[place_b] = np.where(np.append(b_group[1:] != b_group[:-1], True), ord(";"), ord(","))
        cells, size = self._digits[ids], self._length[ids]
        cells[np.arange(n), size] = ends
        return cells[np.arange(cells.shape[1]) <= size[:, None]], size + 1


def aligned(pair: Pair, texts: list[str | None]) -> dict[str, list]:
    """The columns of ``ROWS`` from ``n_a`` on, for some texts at once."""
    codes = [pair.encode(t) for t in texts]
    n_a, n_b = (np.array([len(c[k]) for c in codes], np.int64) for k in (0, 1))
    a, b = (np.concatenate([c[k] for c in codes]) if codes else np.empty(0, np.int64) for k in (0, 1))
    doc = np.repeat(np.arange(len(texts)), n_a)
    end_a, end_b = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
    # At each byte offset: 1 if a token of A ends there, 2 if one of B does.
    ends = np.zeros(int(end_a[-1]) + 1 if len(a) else 0, np.uint8)
    ends[end_a] = 1
    ends[end_b] += 2
    # Between two neighbouring ends of either lies one overlap of an A with a B token.
    ends = ends[ends > 0]
    of_a, of_b, shared = (ends & 1) > 0, ends > 1, ends == 3
    at_a, at_b, group = (np.cumsum(x) - x for x in (of_a, of_b, shared))
    groups_a, groups_b = group[of_a], group[of_b]
    link_a, link_b, link_doc = a[at_a], b[at_b], doc[at_a]
    # A pair of the map also counts where it overlaps inside a larger group, so that all its sightings are in the vector.
    plain = pair.same[link_a] == link_b
    n_groups = np.bincount(link_doc[shared], minlength=len(texts))
    same, same_times = _per_document(link_doc[plain], link_a[plain], len(texts))
    odd, odd_times = _per_document(link_doc[~plain], link_a[~plain] * PAIR_BASE + link_b[~plain], len(texts))
    text, sizes = pair.written(a, b, groups_a, groups_b)
    stops = np.cumsum(np.concatenate([[0], sizes]))[np.cumsum(n_a + n_b)] if len(texts) else []
    digests, at = [], 0
    for stop in stops:
        # The last group of a document ends without its semicolon.
        digests.append(hashlib.sha256(text[at:stop - 1].tobytes()).hexdigest() if stop > at else "")
        at = stop
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_a + n_b - n_groups, "groups_sha256": digests,
            "same": same, "same_times": same_times, "odd": odd, "odd_times": odd_times}


def _per_document(doc: np.ndarray, code: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """The different codes of each of ``n`` documents, and how often each occurs there."""
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (code[1:] != code[:-1]))) if len(doc) else np.empty(0, np.int64)
    times = np.diff(np.append(first, len(doc)))
    offsets = pa.array(np.searchsorted(doc[first], np.arange(n + 1)), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(code[first])), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))


def alignment_rows(documents: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ROWS``: figures and digest of each document, its different identity links (by A's id) and its other links, with their numbers.

    ``row`` numbers the rows of a task; write the table before using it as a
    key.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pair, row = Pair(a_path, b_path), TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0)
            for first, texts in grouped_texts(batch.column(1)):
                found = aligned(pair, texts)
                found |= {"row": np.arange(row, row + len(texts)), "id": ids.slice(first, len(texts)), "same": found["same"].cast(pa.list_(pa.int32()))}
                row += len(texts)
                yield pa.RecordBatch.from_arrays([x if isinstance(x := found[c], pa.Array) else pa.array(x) for c in ROWS.names], names=ROWS.names)
    return documents.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(encode, ROWS)


def identity_counts(rows: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each A id in an identity link: a vector of the vocabulary's length.

    Each task adds up a vector of its own; only its numbers above 0 leave it.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        a = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(held[a])], names=["a", "docs"])
    out = np.zeros(size, np.int64)
    # At most ``size`` rows.
    for a, docs in rows.select("same").mapInArrow(count, "a long, docs long").groupBy("a").agg(F.sum("docs")).collect():
        out[a] = docs
    return out


def odd_counts(rows: DataFrame) -> DataFrame:
    """``(pair, docs)`` of the pairs that are no identity link; combined in each task before the shuffle."""
    return rows.select(F.explode("odd").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))


def align(documents: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    The count of a pair of ids is the number of rows of ``documents`` that
    hold it linked. ``n_best`` counts a row's links whose pair has the highest
    count of its A id (ties included), ``count_sum`` adds the counts of all
    its links. Null and empty texts, and those a tokenizer does not give back
    byte by byte, have zeros and the digest ''. Rows that repeat are
    documents of their own, ids may be null, an empty table gives an empty
    one; other columns of ``documents`` are not read.

    The driver holds vectors of A's vocabulary only. The pairs of a frequent
    word meet their count in a join whose hot partitions AQE splits; the
    counts are summed in every task before they move.
    """
    spark = documents.sparkSession
    size = len(Pair(a_path, b_path).a_bytes)
    rows = materialise(alignment_rows(documents, a_path, b_path, id_col, text_col), "alignment")
    counts = materialise(odd_counts(rows).withColumn("a", F.shiftright("pair", 32)), "alignment-odd")
    plain = identity_counts(rows, size)
    best = plain.copy()
    # One row per A id: no more than the vocabulary.
    for a, docs in counts.groupBy("a").agg(F.max("docs")).collect():
        best[a] = max(best[a], docs)

    @F.arrow_udf("struct<best: bigint, total: bigint>")
    def identity(same: pa.Array, times: pa.Array) -> pa.Array:
        a = same.flatten().to_numpy(zero_copy_only=False)
        n = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(same)), same.value_lengths().to_numpy(zero_copy_only=False))
        sums = [np.zeros(len(same), np.int64) for _ in range(2)]
        np.add.at(sums[0], owner, n * (plain[a] == best[a]))
        np.add.at(sums[1], owner, n * plain[a])
        return pa.StructArray.from_arrays([pa.array(s) for s in sums], names=["best", "total"])

    tops = spark.createDataFrame([(int(a), int(best[a])) for a in np.flatnonzero(best)], "a long, top long")
    known = counts.join(F.broadcast(tops), "a").select("pair", "docs", (F.col("docs") == F.col("top")).alias("is_best"))
    links = rows.select("row", F.explode(F.arrays_zip("odd", "odd_times")).alias("l")).select("row", F.col("l.odd").alias("pair"), F.col("l.odd_times").alias("times"))
    sums = (links.join(known, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("odd_best"), F.sum(F.col("times") * F.col("docs")).alias("odd_total")))
    own = rows.withColumn("own", identity("same", "same_times")).drop("same", "same_times", "odd", "odd_times")
    none = F.lit(0).cast("long")
    return own.join(sums, "row", "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", (F.col("own.best") + F.coalesce("odd_best", none)).alias("n_best"),
        (F.col("own.total") + F.coalesce("odd_total", none)).alias("count_sum"), "groups_sha256")


def op11_alignment(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    return align(documents, a_path, b_path).withColumnRenamed("id", "doc_id")
