"""Quality classifier: a generalised additive model with pairwise interactions."""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.common import held_out, materialise

#: Bins per feature, bins per side of a pair, pairs kept, labelled rows the fit may gather.
BINS, PAIR_BINS, PAIRS, SAMPLE_ROWS = 32, 8, 6, 20_000

FEATURES = ["log_chars", "log_words", "word_chars", "long_words", "upper", "digits", "punct", "symbols", "symbol_tail",
            "non_ascii", "spaces", "line_words", "short_lines", "dup_lines", "distinct_words", "same_next", "top_word", "end_mark"]

_SYMBOLS = b"#$%&*+/<=>@\\^_`{|}~!"
_KIND = np.zeros(256, np.uint8)  # 1 upper, 2 digit, 3 punctuation, 4 symbol, 5 other bytes, 6 space
for _b in range(256):
    _KIND[_b] = (5 if _b >= 0x80 else 1 if chr(_b).isupper() else 2 if chr(_b).isdigit() else 4 if _b in _SYMBOLS
                 else 6 if chr(_b).isspace() else 3 if 0x21 <= _b <= 0x7E and not chr(_b).isalpha() else 0)


def text_features(text: str | None) -> list[float]:
    """``FEATURES`` of a whole text; null and empty texts give zeros."""
    text = text or ""
    raw = text.encode("utf-8")
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=7) / max(1, len(raw))
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    counts = Counter(words)
    distinct, top, same = len(counts), max(counts.values(), default=0), sum(map(str.__eq__, words, words[1:]))
    sizes = [len(x.split()) for x in lines]
    return [np.log1p(len(text)), np.log1p(len(words)), len(text) / n, sum(len(w) > 12 for w in words) / n, kinds[1], kinds[2],
            kinds[3], kinds[4], sum(w[-1] in "#$%&*!|" for w in words) / n, kinds[5], kinds[6],
            len(words) / max(1, len(lines)), sum(s < 4 for s in sizes) / max(1, len(sizes)),
            1 - len(set(lines)) / max(1, len(lines)), distinct / n, same / n, top / n,
            sum(x.rstrip()[-1] in ".!?" for x in lines) / max(1, len(lines))]


def feature_table(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, features)`` of every row; the text is read once and goes no further."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                           T.StructField("features", T.ArrayType(T.DoubleType()))])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))],
                                             names=schema.names)
    return documents.select(F.col(id_col).cast("long"), held_out(id_col), F.col(text_col)).mapInArrow(extract, schema)


@dataclass
class Gam:
    """Lookup tables: a score per bin of each feature, and per cell of each chosen pair."""

    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: table entries of a row's bins, added and squashed."""
        if not self.edges:
            return np.full(len(x), _sigmoid(self.intercept))
        bins = self.bins(x)
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[bins[:, j]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[_coarse(bins[:, i]), _coarse(bins[:, j])]
        return _sigmoid(total)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _coarse(bins: np.ndarray) -> np.ndarray:
    return bins * PAIR_BINS // BINS


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int = 3, ridge: float = 1.0) -> np.ndarray:
    """Leaf value of every bin of a shallow tree on ordered bins: the best cut is made ``leaves - 1`` times."""
    spans = [(0, len(grad))]
    worth = lambda s, e: grad[s:e].sum() ** 2 / (hess[s:e].sum() + ridge)
    for _ in range(leaves - 1):
        found = [(worth(s, c) + worth(c, e) - worth(s, e), k, c) for k, (s, e) in enumerate(spans) for c in range(s + 1, e)]
        gain, k, cut = max(found, default=(0, 0, 0))
        if gain <= 1e-9:
            break
        s, e = spans[k]
        spans[k:k + 1] = [(s, cut), (cut, e)]
    out = np.zeros(len(grad))
    for s, e in spans:
        out[s:e] = grad[s:e].sum() / (hess[s:e].sum() + ridge)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """(values, gain) of the best depth-two tree on a grid: one cut of the rows, then a cut of the columns on each side."""
    best, out = 0.0, np.zeros_like(grad)
    for flip in (False, True):
        g, h = (grad.T, hess.T) if flip else (grad, hess)
        for cut in range(1, len(g)):
            gain, values = 0.0, np.zeros_like(g)
            for part in (slice(0, cut), slice(cut, None)):
                gc, hc = np.cumsum(g[part].sum(axis=0)), np.cumsum(h[part].sum(axis=0))
                left, right = gc[:-1] ** 2 / (hc[:-1] + ridge), (gc[-1] - gc[:-1]) ** 2 / (hc[-1] - hc[:-1] + ridge)
                c = int(np.argmax(left + right))
                gain += (left + right)[c]
                values[part, :c + 1], values[part, c + 1:] = gc[c] / (hc[c] + ridge), (gc[-1] - gc[c]) / (hc[-1] - hc[c] + ridge)
            gain -= g.sum() ** 2 / (h.sum() + ridge)
            if gain > best:
                best, out = gain, values.T if flip else values
    return out, best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 40, rate: float = 0.2) -> Gam:
    """Cyclic boosting: every round adds a shallow tree to each feature's table in turn, then the strongest pairs likewise."""
    prior = (y.sum() + 0.5) / (len(y) + 1)
    model = Gam(intercept=float(np.log(prior / (1 - prior))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="higher")) for j in range(x.shape[1])]
    bins = model.bins(x)
    model.tables = [np.zeros(BINS) for _ in model.edges]
    total = np.full(len(y), model.intercept)
    sums = lambda cells, n, w: np.bincount(cells, weights=w, minlength=n)
    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            p = _sigmoid(total)
            step = rate * _tree(sums(bins[:, j], BINS, y - p), sums(bins[:, j], BINS, p * (1 - p)))
            table += step
            total += step[bins[:, j]]
    coarse = _coarse(bins)
    cells = {(i, j): coarse[:, i] * PAIR_BINS + coarse[:, j] for i, j in itertools.combinations(range(x.shape[1]), 2)}
    grid = lambda pair, w: sums(cells[pair], PAIR_BINS ** 2, w).reshape(PAIR_BINS, PAIR_BINS)
    p = _sigmoid(total)
    gains = {pair: _pair_tree(grid(pair, y - p), grid(pair, p * (1 - p)))[1] for pair in cells}
    model.pairs = sorted(sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS])
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(pair_rounds):
        for pair, table in zip(model.pairs, model.pair_tables):
            p = _sigmoid(total)
            step = rate * _pair_tree(grid(pair, y - p), grid(pair, p * (1 - p)))[0]
            table += step
            total += step.ravel()[cells[pair]]
    return model


def train(features: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Gam:
    """Fits on at most about ``sample_rows`` hashed labelled rows that are not held out.

    ``labels`` is ``(doc_id, quality)``; null labels are ignored and a
    document labelled several times counts each time. Without labels of both
    kinds every text gets the labels' share of ones (one half if none).
    """
    rows = features.where(~F.col("held_out")).join(
        labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("y")), "id")
    rows = materialise(rows.select("id", "features", "y"), "gam-train")
    n, scale = rows.count(), 1 << 40
    limit = scale if n <= sample_rows else int(sample_rows / n * scale)
    got = rows.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(scale)) < limit).orderBy("id", "y").toPandas()
    x = np.array(got["features"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy(dtype=float))


def score(features: DataFrame, model: Gam, cut: float = 0.7) -> DataFrame:
    """``(id, held_out, score, predicted)`` of a feature table."""
    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            p = model.score(np.array(frame["features"].tolist(), dtype=float).reshape(-1, len(FEATURES)))
            yield frame[["id", "held_out"]].assign(score=p, predicted=(p >= cut).astype("int32"))
    return features.mapInPandas(add, "id long, held_out boolean, score double, predicted int")


def op4_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    features = materialise(feature_table(documents), "gam-features")
    return score(features, train(features, labels)).withColumnRenamed("id", "doc_id")
