"""Hierarchical navigable small-world graphs in numpy, many queries per step."""

from __future__ import annotations

import math

import numpy as np

#: Links per node (twice on the lowest layer), beam while building, nodes inserted and queries answered together.
LINKS, BUILD_BEAM, BATCH = 16, 64, 256
#: A query with more true pairs than this belongs to a large group.
FEW = 32


class Graph:
    """A graph over the rows of ``x`` (unit vectors); similarity is the dot product."""

    def __init__(self, x: np.ndarray, seed: int = 1):
        self.x = np.ascontiguousarray(x, dtype=np.float32)
        n = len(x)
        draws = np.random.default_rng(seed).random(n)
        levels = np.minimum((-np.log(np.maximum(draws, 1e-12)) / math.log(LINKS)).astype(int), 8)
        # Nodes of high layers come first, so each layer holds a prefix of the order.
        self.order = np.argsort(-levels, kind="stable")
        self.sizes = [int((levels >= layer).sum()) for layer in range(int(levels.max(initial=0)) + 1)]
        self.layers = [np.full((n, LINKS * (2 if layer == 0 else 1)), -1, np.int32) for layer in range(len(self.sizes))]
        for layer in range(len(self.sizes) - 1, -1, -1):
            self._build(layer)

    def _build(self, layer: int) -> None:
        ids = self.order[:self.sizes[layer]]
        for at in range(0, len(ids), BATCH):
            new = ids[at:at + BATCH]
            q = self.x[new]
            if at:
                start = self._descend(q, layer) if at >= BATCH and layer + 1 < len(self.sizes) else np.full((len(new), 1), ids[0])
                found, sims = self._search(q, start, layer, BUILD_BEAM)
            else:
                found, sims = np.full((len(new), 0), -1), np.zeros((len(new), 0), np.float32)
            # Nodes inserted together also see each other.
            own = q @ q.T
            np.fill_diagonal(own, -np.inf)
            k = min(len(new) - 1, BUILD_BEAM)
            near = np.argpartition(-own, k - 1, axis=1)[:, :k] if k else np.empty((len(new), 0), int)
            found = np.hstack([found, new[near]]).astype(np.int64)
            sims = np.hstack([sims, np.take_along_axis(own, near, 1)])
            self._link(new, found, sims, layer)

    def _link(self, new, found, sims, layer) -> None:
        table = self.layers[layer]
        chosen = self._diverse(found, sims, LINKS)
        table[new, :chosen.shape[1]] = chosen
        src, dst = np.repeat(new, chosen.shape[1]), chosen.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        if not len(dst):
            return
        sim = np.einsum("ij,ij->i", self.x[src], self.x[dst])
        order = np.lexsort((-sim, dst))
        src, dst, sim = src[order], dst[order], sim[order]
        first = np.flatnonzero(np.concatenate([[True], dst[1:] != dst[:-1]]))
        rank = np.arange(len(dst)) - np.repeat(first, np.diff(np.concatenate([first, [len(dst)]])))
        width = table.shape[1]
        keep = rank < 2 * width
        target = dst[first]
        row = np.searchsorted(target, dst[keep])
        extra = np.full((len(target), 2 * width), -1, np.int64)
        extra[row, rank[keep]] = src[keep]
        both = np.hstack([table[target], extra])
        # A node inserted in this batch may already have the reverse link.
        both = np.sort(both, axis=1)[:, ::-1]
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        gathered = np.einsum("td,tkd->tk", self.x[target], self.x[np.maximum(both, 0)])
        gathered[both < 0] = -np.inf
        top = np.argsort(-gathered, axis=1, kind="stable")[:, :2 * width]
        both, gathered = np.take_along_axis(both, top, 1), np.take_along_axis(gathered, top, 1)
        full = (both >= 0).sum(axis=1) > width
        plain = both[:, :width].copy()
        if full.any():
            plain[full] = self._diverse(both[full], gathered[full], width)
        table[target] = plain

    def _diverse(self, found: np.ndarray, sims: np.ndarray, limit: int) -> np.ndarray:
        """Neighbours nearer to the node than to a neighbour chosen before, then the nearest others."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, :max(limit, BUILD_BEAM)]
        found, sims = np.take_along_axis(found, order, 1), np.take_along_axis(sims, order, 1)
        sims = np.where(found < 0, -np.inf, sims)
        x = self.x[np.maximum(found, 0)]
        between = x @ x.transpose(0, 2, 1)
        taken = np.zeros(found.shape, bool)
        closest = np.full(found.shape, -np.inf)
        for c in range(found.shape[1]):
            ok = (sims[:, c] > closest[:, c]) & (found[:, c] >= 0) & (taken.sum(axis=1) < limit)
            taken[ok, c] = True
            closest[ok] = np.maximum(closest[ok], between[ok, :, c])
        score = np.where(taken, 0, 1) * (found.shape[1] + 1) + np.arange(found.shape[1])
        first = np.argsort(score, axis=1, kind="stable")[:, :limit]
        out = np.take_along_axis(found, first, 1)
        if out.shape[1] < limit:
            out = np.hstack([out, np.full((len(out), limit - out.shape[1]), -1)])
        return out

    def _descend(self, q: np.ndarray, layer: int) -> np.ndarray:
        at = np.full((len(q), 1), self.order[0])
        for above in range(len(self.sizes) - 1, layer, -1):
            at, _ = self._search(q, at, above, 4)
            at = np.where(at < 0, self.order[0], at)
        return at

    def _search(self, q: np.ndarray, start: np.ndarray, layer: int, beam: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the best ``beam`` nodes found for each query, nearest first; -1 pads."""
        table, rows = self.layers[layer], np.arange(len(q))[:, None]
        start = np.sort(start, axis=1)
        start[:, 1:][start[:, 1:] == start[:, :-1]] = -1
        seen = np.zeros((len(q), len(self.x) + 1), bool)
        seen[rows, start] = True
        seen[:, -1] = True
        ids = np.full((len(q), beam), -1)
        sims = np.full((len(q), beam), -np.inf, np.float32)
        width = min(beam, start.shape[1])
        ids[:, :width] = start[:, :width]
        sims[:, :width] = np.where(ids[:, :width] < 0, -np.inf, np.einsum("qd,qkd->qk", q, self.x[np.maximum(ids[:, :width], 0)]))
        done = ids < 0
        live = np.arange(len(q))
        while len(live):
            open_sims = np.where(done[live], -np.inf, sims[live])
            pick = np.argsort(-open_sims, axis=1)[:, :step]
            some = np.take_along_axis(open_sims, pick, 1) > -np.inf
            going = some.any(axis=1)
            live, pick, some = live[going], pick[going], some[going]
            if not len(live):
                break
            r = live[:, None]
            done[r, pick] |= some
            near = table[np.where(some, ids[r, pick], 0)]
            near[~some] = -1
            near = np.sort(near.reshape(len(live), -1), axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[r, near]] = -1
            seen[r, near] = True
            new = np.einsum("qd,qkd->qk", q[live], self.x[np.maximum(near, 0)])
            new[near < 0] = -np.inf
            all_ids, all_sims = np.hstack([ids[live], near]), np.hstack([sims[live], new])
            all_done = np.hstack([done[live], near < 0])
            top = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[live], sims[live] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_sims, top, 1)
            done[live] = np.take_along_axis(all_done, top, 1) | (ids[live] < 0)
        return ids, sims

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` rows for each query vector."""
        q = np.ascontiguousarray(q, dtype=np.float32)
        return self._search(q, self._descend(q, 0), 0, beam)

    def pack(self) -> bytes:
        return b"".join([np.array([len(self.sizes), *self.sizes], "<i4").tobytes(), self.order.astype("<i4").tobytes(),
                         *(t.astype("<i4").tobytes() for t in self.layers)])

    @classmethod
    def unpack(cls, x: np.ndarray, packed: bytes) -> Graph:
        out, flat, n = cls.__new__(cls), np.frombuffer(packed, "<i4"), len(x)
        out.x = np.ascontiguousarray(x, dtype=np.float32)
        out.sizes = flat[1:1 + flat[0]].tolist()
        at = 1 + int(flat[0])
        out.order, at = flat[at:at + n], at + n
        out.layers = []
        for layer in range(len(out.sizes)):
            width = LINKS * (2 if layer == 0 else 1)
            out.layers.append(flat[at:at + n * width].reshape(n, width))
            at += n * width
        return out


def range_pairs(graph: Graph, x: np.ndarray, q: np.ndarray, threshold: float, beam: int) -> np.ndarray:
    """Boolean matrix (queries x rows): the pairs the graph finds whose dot product is at least ``threshold`` in double precision.

    A query whose whole beam lies above the threshold is asked again with a
    beam twice as wide; one that fills a beam as wide as the graph is near to
    everything, and compared with it.
    """
    out = np.zeros((len(q), len(x)), bool)
    for at in range(0, len(q), BATCH):
        todo, wide = np.arange(at, min(at + BATCH, len(q))), beam
        while len(todo):
            ids, sims = graph.search(q[todo], wide)
            # Single precision is off by about 1e-6; the verdict is taken in double precision.
            r, c = np.nonzero((ids >= 0) & (sims >= threshold - 1e-4))
            hit = ids[r, c]
            good = np.einsum("ij,ij->i", q[todo[r]], x[hit]) >= threshold
            out[todo[r[good]], hit[good]] = True
            todo, wide = todo[(ids[:, -1] >= 0) & (sims[:, -1] >= threshold - 1e-4)], wide * 2
            if wide >= 2 * len(x) and len(todo):
                out[todo] = q[todo] @ x.T >= threshold
                break
    return out


def audit(graph: Graph, x: np.ndarray, q: np.ndarray, threshold: float, beams, own: np.ndarray | None = None) -> np.ndarray:
    """Recall of a search, measured: (beams x 2 kinds x 2) numbers of queries with true pairs, and sums of the shares found.

    Kinds: queries with up to ``FEW`` true pairs, and with more; so a hot group
    cannot stand for small ones. ``own``: the queries' own rows of the graph,
    which say nothing of the search. A beam that finds all is not widened.
    """
    truth = q @ x.T >= threshold
    if own is not None:
        truth[np.arange(len(q)), own] = False
    pairs = truth.sum(axis=1)
    kinds = (pairs > 0) & (pairs <= FEW), pairs > FEW
    out, share = np.zeros((len(beams), 2, 2)), np.zeros(len(q))
    for b, beam in enumerate(beams):
        if (share < 1)[pairs > 0].any():
            share = (range_pairs(graph, x, q, threshold, beam) & truth).sum(axis=1) / np.maximum(pairs, 1)
        for k, kind in enumerate(kinds):
            out[b, k] = kind.sum(), share[kind].sum()
    return out
