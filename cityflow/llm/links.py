"""Link counts and spanning forests of a block of compared members."""

from __future__ import annotations

import numpy as np


def forest(linked: np.ndarray) -> np.ndarray:
    """Parent of each node in a spanning forest of a symmetric boolean matrix; roots have themselves."""
    parent = np.arange(len(linked))
    seen = np.zeros(len(linked), bool)
    for root in range(len(linked)):
        if seen[root]:
            continue
        seen[root] = True
        front = [root]
        while front:
            node = front.pop()
            new = np.flatnonzero(linked[node] & ~seen)
            seen[new] = True
            parent[new] = node
            front.extend(new.tolist())
    return parent


def two_sided(between: np.ndarray) -> np.ndarray:
    """The symmetric matrix of a bipartite one."""
    n, m = between.shape
    out = np.zeros((n + m, n + m), bool)
    out[:n, n:], out[n:, :n] = between, between.T
    return out
