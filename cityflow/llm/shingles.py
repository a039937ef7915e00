"""Word shingles of whole texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words of a shingle; a shorter text is one shingle of all its words.
WIDTH = 5
#: Bytes hashed per numpy pass, and text bytes handled together.
PIECE_BYTES = 1 << 20
_SPACES = (32, 9, 10, 11, 12, 13)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACES)] = True
_BASE = 0x9E3779B97F4A7C15
_STEP = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2^64."""
    if len(_TABLES.get("up", ())) < n:
        size = max(n, 2 * PIECE_BYTES)
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _TABLES["up"], _TABLES["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _word_hashes(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the words, runs of bytes that are not white space.

    A word's hash is its polynomial: a difference of running sums, moved to
    the origin by the inverse power.
    """
    space = _IS_SPACE[flat]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _tables(len(flat) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[:len(flat)], dtype=np.uint64)])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_STEP)), starts


def _cuts(raw: bytes) -> Iterator[tuple[int, int]]:
    """A text in pieces of about PIECE_BYTES that end at white space."""
    at = 0
    while len(raw) - at > PIECE_BYTES:
        gap = _GAP.search(raw, at + PIECE_BYTES)
        if gap is None:
            break
        yield at, gap.start()
        at = gap.start()
    yield at, len(raw)


_GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; none for null and blank texts."""
    parts, rows, sizes = [], [], []
    words, owner = [], []

    def flush():
        if not parts:
            return
        flat = np.frombuffer(b" ".join(parts), np.uint8)
        first = np.concatenate([[0], np.cumsum(np.array(sizes) + 1)[:-1]])
        hashes, starts = _word_hashes(flat)
        words.append(hashes)
        owner.append(np.array(rows)[np.searchsorted(first, starts, side="right") - 1])
        parts.clear(), rows.clear(), sizes.clear()
    held = 0
    for row, text in enumerate(texts):
        raw = (text or "").encode("utf-8")
        for s, e in _cuts(raw):
            parts.append(raw[s:e])
            rows.append(row)
            sizes.append(e - s)
            held += e - s + 1
            if held >= PIECE_BYTES:
                flush()
                held = 0
    flush()
    w = np.concatenate(words) if words else np.empty(0, np.uint64)
    count = np.bincount(np.concatenate(owner), minlength=len(texts)) if words else np.zeros(len(texts), np.int64)
    ends = np.cumsum(count)
    with np.errstate(over="ignore"):
        rolled = w[:max(0, len(w) - width + 1)].copy()
        for i in range(1, width):
            rolled = rolled * np.uint64(_STEP) + w[i:len(w) - width + 1 + i]
        rolled = mix(rolled)
        out = []
        for n, end in zip(count, ends):
            if n >= width:
                out.append(np.unique(rolled[end - n:end - width + 1]))
            elif n:
                acc = np.uint64(n)
                for x in w[end - n:end]:
                    acc = acc * np.uint64(_STEP) + x
                out.append(mix(np.array([acc])))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def grouped_texts(column: pa.Array, limit: int = 2 * PIECE_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of runs of rows with about ``limit`` characters."""
    first, held, size = 0, [], 0
    for i, text in enumerate(column):
        held.append(text.as_py())
        size += len(held[-1] or "")
        if size >= limit:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def set_digest(hashes: np.ndarray) -> bytes:
    """16 bytes that stand for a shingle set."""
    with np.errstate(over="ignore"):
        a = mix(hashes).sum(dtype=np.uint64)
        b = mix(hashes ^ np.uint64(_BASE)).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return np.array([a, b], dtype="<u8").tobytes()
