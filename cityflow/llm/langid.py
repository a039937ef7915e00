"""Language identification: averaged hashed subword embeddings with a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.common import held_out

#: log2 of the hash buckets, embedding width and subword lengths in bytes.
BITS, DIM, GRAMS = 13, 16, (3, 4)
#: Bytes of text per numpy pass; a longer text is read in pieces.
PIECE_BYTES = 1 << 20
#: Labelled rows that the fit may gather (its only sample): of a language, and of all languages together.
ROWS_PER_LANG, ROWS = 500, 8000
#: Share of rightly read rows that the rejection threshold may lose; 99 calibration rows resolve it.
REJECT_SHARE = 0.01
UNKNOWN = "und"

# Byte classes: ASCII letters in lower case, bytes of other scripts as they are, the rest a space.
FOLD = np.array([b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)], np.uint8)


def _pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, row of each segment, first place, end of its places, end of its bytes): about PIECE_BYTES at a time.

    A segment is a text, or a stretch of a long one; a subword of it begins
    at one of its places and may reach into the bytes behind them, so that
    long texts have the subwords they have in one piece. Runs of spaces are
    one space, and every text begins with a space as words do.
    """
    rows, spans, held = [], [], 0
    for row, (s, e) in enumerate(zip(starts, ends)):
        if e - s > PIECE_BYTES:
            flat, _, _, end, _ = _folded(data, [row], [(s, e)])
            for at in range(0, int(end[0]), PIECE_BYTES):
                part = flat[at:at + PIECE_BYTES + max(GRAMS) - 1]
                yield part, np.array([row]), np.array([0]), np.array([min(PIECE_BYTES, len(part))]), np.array([len(part)])
            continue
        rows.append(row)
        spans.append((s, e))
        held += e - s
        if held >= PIECE_BYTES:
            yield _folded(data, rows, spans)
            rows, spans, held = [], [], 0
    if rows:
        yield _folded(data, rows, spans)


def _folded(data, rows, spans):
    parts = []
    for s, e in spans:
        parts += [b" ", data[s:e]]
    flat = FOLD[np.concatenate([np.frombuffer(p, np.uint8) if isinstance(p, bytes) else p for p in parts])]
    sizes = np.array([e - s + 1 for s, e in spans])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    keep = (flat != 32) | (np.concatenate([[0], flat[:-1]]) != 32)
    keep[first] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return flat[keep], np.array(rows), before[first], before[first + sizes], before[first + sizes]


def _hashes(flat: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n bytes from each place on."""
    wide = flat.astype(np.uint32)
    code = wide[:len(wide) - n + 1].copy()
    for i in range(1, n):
        code |= wide[i:len(wide) - n + 1 + i] << np.uint32(8 * i)
    code *= np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA77 + 2 * n)
    return (code >> np.uint32(32 - BITS)).astype(np.int32)


def subword_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a whole text's subwords."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    total = np.zeros(1 << BITS, np.int64)
    for flat, _, s, b, e in _pieces(data, np.array([0]), np.array([len(data)])):
        for first, last, end in zip(s, b, e):
            for n in GRAMS:
                if min(last, end - n + 1) > first:
                    total += np.bincount(_hashes(flat[first:min(end, last + n - 1)], n), minlength=1 << BITS)
    buckets = np.flatnonzero(total)
    return buckets.astype(np.int32), total[buckets].astype(np.float32)


@dataclass
class LangModel:
    """Fitted model: languages, embeddings of the buckets, softmax weights and bias, temperature, threshold."""

    langs: list[str] = field(default_factory=list)
    embed: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS, DIM), np.float32))
    weight: np.ndarray = field(default_factory=lambda: np.zeros((DIM, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Averages of the narrower of embeddings and per-bucket logits; either way the same sums."""
        narrow = len(self.langs) <= DIM
        table = (self.embed @ self.weight).astype(np.float32) if narrow else self.embed
        sums, counts = np.zeros((len(starts), table.shape[1])), np.zeros(len(starts))
        for flat, rows, s, b, e in _pieces(data, starts, ends):
            for n in GRAMS:
                stop = np.minimum(b, e - n + 1)
                some = stop > s
                if not some.any():
                    continue
                values = table[_hashes(flat, n)]
                cuts = np.column_stack([s[some], np.minimum(stop[some], len(values))]).ravel()
                values = np.concatenate([values, np.zeros((1, values.shape[1]), values.dtype)])
                np.add.at(sums, rows[some], np.add.reduceat(values, cuts, axis=0)[::2].astype(float))
                np.add.at(counts, rows[some], (stop - s)[some])
        mean = sums / np.maximum(counts, 1)[:, None]
        return (mean if narrow else mean @ self.weight) + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return _softmax(logits / self.temperature)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(samples: list[tuple[np.ndarray, np.ndarray, str]], epochs: int = 25, batch: int = 32, rate: float = 2.0,
        seed: int = 7) -> LangModel:
    """SGD on ``(buckets, counts, lang)`` rows; every fifth row only calibrates.

    The temperature minimises the calibration rows' loss. The rejection
    threshold is the conformal quantile of the rightly read ones: at most
    ``REJECT_SHARE`` of such rows fall below it, or 1 in n + 1 if n of them
    are too few to resolve that share.
    """
    langs = sorted({lang for *_, lang in samples})
    if not langs:
        return LangModel()

    def dense(at) -> np.ndarray:
        """Subword shares of some rows; all others stay sparse."""
        x = np.zeros((len(at), 1 << BITS), np.float32)
        for i, k in enumerate(at):
            buckets, counts, _ = samples[k]
            x[i, buckets] = counts / max(1.0, counts.sum())
        return x
    place = {lang: i for i, lang in enumerate(langs)}
    y = np.array([place[lang] for *_, lang in samples])
    calibration = np.arange(len(samples)) % 5 == 4
    rows, rng = np.flatnonzero(~calibration), np.random.default_rng(seed)
    embed = rng.normal(0, 1, (1 << BITS, DIM)).astype(np.float32)
    weight, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    share = np.bincount(y[rows], minlength=len(langs)) / len(rows)
    balance = (1 / np.maximum(share, 1e-9) / len(langs)).astype(np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for at in np.array_split(rng.permutation(rows), max(1, len(rows) // batch)):
            part = dense(at)
            hidden = part @ embed
            error = _softmax(hidden @ weight + bias)
            error[np.arange(len(at)), y[at]] -= 1
            error *= balance[y[at]][:, None] / len(at)
            back = error @ weight.T
            weight -= step * hidden.T @ error
            bias -= 0.1 * step * error.sum(axis=0)
            used = np.flatnonzero(part.any(axis=0))
            # Rows of the embedding see 1/length of a gradient; the step is scaled back by a typical length.
            embed[used] -= step * 100 * (part[:, used].T @ back)
    model = LangModel(langs, embed, weight, bias.astype(float))
    held = np.flatnonzero(calibration) if calibration.any() else rows
    logits = np.vstack([dense(at) @ embed @ weight for at in np.array_split(held, max(1, len(held) // 256))]) + model.bias
    truth = y[held]
    # Platt's smoothed targets: without an error among n rows, a rate of 1 in n + 2 is assumed.
    target = np.full((len(held), len(langs)), 1 / (len(held) + 2) / max(1, len(langs) - 1))
    target[np.arange(len(held)), truth] = (len(held) + 1) / (len(held) + 2)
    loss = lambda t: -(target * np.log(np.maximum(_softmax(logits / t), 1e-12))).sum(axis=1).mean()
    model.temperature = float(min(np.geomspace(0.1, 100, 61), key=loss))
    p = model.probabilities(logits)
    good = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
    model.threshold = float(good[max(1, int(REJECT_SHARE * (len(good) + 1))) - 1]) if len(good) else 0.0
    return model


SAMPLE = T.StructType([T.StructField("lang", T.StringType()), T.StructField("u", T.LongType()),
                       T.StructField("buckets", T.BinaryType()), T.StructField("counts", T.BinaryType())])


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows_per_lang: int = ROWS_PER_LANG, rows_in_all: int = ROWS) -> LangModel:
    """Fits on at most about ``rows_per_lang`` hashed rows of each language, and ``rows_in_all`` of all.

    Only rows with text and language that are not held out are seen. Their
    whole texts become bucket counts on the executors; those bounded counts
    are all that reaches the driver, where numpy fits the model. Many
    languages share the rows evenly; with more languages than rows, the most
    frequent ``rows_in_all`` are learned. Without labelled rows the model
    knows no language.
    """
    rows = documents.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id")) \
        .where(~held_out("id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(rows_in_all)
    langs = sizes.count()
    if not langs:
        return LangModel()
    scale = 1 << 40
    wanted = min(rows_per_lang, rows_in_all / langs)
    share = sizes.select(F.col("lang").alias("l"), F.least(F.lit(scale), F.floor(F.lit(wanted * scale) / F.col("n"))).alias("limit"))
    # At most ``rows_in_all`` rows of a tag and a number; the texts stay where they are.
    drawn = rows.withColumn("u", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(scale)))
    picked = drawn.join(F.broadcast(share), F.col("lang") == F.col("l")).where(F.col("u") < F.col("limit"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [subword_counts(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([b.astype("<u2").tobytes() for b, _ in found], pa.binary()),
                 pa.array([c.astype("<f4").tobytes() for _, c in found], pa.binary())], names=SAMPLE.names)
    # Packed numbers: a few kB a row in the driver.
    got = [(r["u"], r["lang"], bytes(r["buckets"]), bytes(r["counts"]))
           for r in picked.select("text", "lang", "u").mapInArrow(count, SAMPLE).collect()]
    got.sort()
    return fit([(np.frombuffer(b, "<u2"), np.frombuffer(c, "<f4"), lang) for _, lang, b, c in got])


def identify(documents: DataFrame, model: LangModel, text_col: str = "text") -> DataFrame:
    """``documents`` with ``lang_pred``, ``lang_score`` and ``lang_rejected``.

    The whole text is read. Null texts and texts without a letter are ``und``
    with score 0 and rejected, as is everything under a model that knows no
    language; others are rejected when the calibrated score is below the
    model's threshold. Columns of these three names are replaced.
    """
    names = [c for c in documents.columns if c not in ("lang_pred", "lang_score", "lang_rejected")]
    base = documents.select(*names)
    schema = T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("lang_score", T.DoubleType()), T.StructField("lang_rejected", T.BooleanType())])
    letters = "__has_letter"
    base = base.withColumn(letters, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    at = names.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.large_string())
            _, offsets, data = texts.buffers()
            offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
            known = np.asarray(batch.column(len(names)).to_numpy(zero_copy_only=False), dtype=bool) & bool(model.langs)
            best, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            if known.any():
                p = model.probabilities(model.logits(data, offsets[:-1][known], offsets[1:][known]))
                best[known], score[known] = np.array(model.langs, dtype=object)[p.argmax(axis=1)], p.max(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(best, pa.string()), pa.array(score), pa.array(~known | (score < model.threshold))],
                names=schema.names)
    return base.mapInArrow(predict, schema)


def op8_langid(documents: DataFrame) -> DataFrame:
    model = train(documents)
    out = identify(documents.select("doc_id", "text", held_out("doc_id").alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))
