"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import materialise, reshuffled


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of the edge columns ``a`` and ``b``.

    Keys are strings or binaries (null edges are ignored); ``component`` is
    the smallest key of the component. Each round hangs the neighbours of a
    node on its smallest neighbour (large star, then small star), so paths
    shrink by halves and the number of rounds is logarithmic. Edges stay in
    the shared folder between rounds and only two sums reach the driver. An
    empty edge table gives an empty result; self loops give their node its
    own component.
    """
    pairs = edges.select("a", "b").where("a is not null and b is not null")
    loops = pairs.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    stars = materialise(pairs.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        stars = materialise(_small_star(_large_star(stars)), "edges")
        # Every u hangs on one v and the pairs stay the same: all stars are flat.
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    found = stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
    lone = loops.distinct().join(found.select("node"), "node", "left_anti")
    return found.union(lone)


def _with_min(both: DataFrame) -> DataFrame:
    """Adds the smallest of each u and its neighbours."""
    least = both.groupBy("u").agg(F.min("w").alias("m"))
    least = least.select(reshuffled(F.col("u")).alias("u"), F.least("u", "m").alias("m"))
    return both.join(least, "u")


def _large_star(stars: DataFrame) -> DataFrame:
    """Larger neighbours of u move to the smallest node around u."""
    both = stars.select("u", F.col("v").alias("w")).union(stars.select(F.col("v").alias("u"), F.col("u").alias("w")))
    out = _with_min(both).where("w > u and w <> m").select(F.col("w").alias("u"), F.col("m").alias("v"))
    return out.distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """Smaller neighbours of u, and u, move to the smallest of them."""
    got = _with_min(stars.select("u", F.col("v").alias("w")))
    out = got.select(F.explode(F.array(F.struct(F.col("w").alias("u"), F.col("m").alias("v")),
                                       F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return out.where("u <> v").distinct()
