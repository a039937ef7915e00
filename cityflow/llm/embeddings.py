"""Near-duplicate embeddings by HNSW graphs per shard."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import materialise, reshuffled
from cityflow.llm.components import connected_components
from cityflow.llm.hnsw import Graph, audit, range_pairs
from cityflow.llm.links import forest, two_sided

#: Different vectors of a shard at most, on average.
SHARD_ROWS = 4096
#: Shards whose queries a task puts to one graph, and queries of a shard that are audited.
QUERY_SHARDS, AUDIT_ROWS = 8, 64
#: Beams that the audit may choose from.
BEAMS = (64, 128, 256, 512, 1024, 4096)
LINKS = "a binary, b binary, links long"


def unit_rows(embeddings: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(id, label, digest, dims, unit)``: unit vectors in double precision.

    The digest stands for label and direction; it is null where a vector
    links with nothing.
    """
    schema = "id long, label string, digest binary, dims int, unit binary"

    def scale(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            digests, units, dims = [], [], []
            for label, vector in zip(frame["label"], frame["vector"]):
                x = np.empty(0) if vector is None else np.array(vector, dtype=np.float64)
                size = np.abs(x).max(initial=0.0)
                good = len(x) > 0 and np.isfinite(x).all() and size > 0
                if good:
                    x = x / size  # no overflow of the squares
                    x = x / np.sqrt((x * x).sum()) + 0.0
                units.append(x.tobytes() if good else None)
                known = good and label is not None
                digests.append(hashlib.blake2b(units[-1] + label.encode(), digest_size=16).digest() if known else None)
                dims.append(len(x))
            yield pd.DataFrame({"id": frame["id"], "label": frame["label"], "digest": digests, "dims": np.array(dims, np.int32), "unit": units})
    finite = F.col(vector_col).cast("array<double>")
    # A null component is as bad as a non-finite one.
    vector = F.transform(finite, lambda v: F.coalesce(v, F.lit(float("nan"))))
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), vector.alias("vector"))
    return rows.mapInPandas(scale, schema)


def _matrix(blobs, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(-1, dims)


def build_shards(vectors: DataFrame) -> DataFrame:
    """A row per shard of ``(label, dims, digest, weight, unit)``: its vectors, their graph, and which of them are audited."""
    counts = vectors.groupBy("label", "dims").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"))
    dealt = vectors.join(counts, ["label", "dims"]).withColumn("shard", F.pmod(F.xxhash64("digest"), F.col("shards")).cast("int"))
    schema = "label string, dims int, shards int, shard int, digests binary, weights binary, units binary, graph binary, audited binary"

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("digest")
        x = _matrix(frame["unit"], int(key[1]))
        some = np.sort(np.random.default_rng(len(x)).permutation(len(x))[:AUDIT_ROWS])
        return pd.DataFrame([[*key, b"".join(frame["digest"]), frame["weight"].to_numpy(np.int64).tobytes(), x.tobytes(), Graph(x).pack(), some.astype("<i8").tobytes()]],
                            columns=["label", "dims", "shards", "shard", "digests", "weights", "units", "graph", "audited"])
    return dealt.groupBy("label", "dims", "shards", "shard").applyInPandas(build, schema)


PLACE = ["label", "dims", "shard", "part"]


def _meetings(shards: DataFrame, queries: DataFrame):
    """Every graph of a label with the ``queries`` of its own shard and of all later ones, ``QUERY_SHARDS`` of them a group.

    A graph moves once a group and not once a pair of shards.
    """
    part = lambda shard: F.floor(shard / QUERY_SHARDS).cast("int")
    # Columns of their own on each side: both may come from one table.
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])
    graphs = shards.withColumn("part", F.explode(F.sequence(part(F.col("shard")), part(F.col("shards") - 1))))
    asked = queries.withColumnRenamed("shard", "q_shard").withColumns(
        {"shard": F.explode(F.sequence(F.lit(0), F.col("q_shard"))), "part": part(F.col("q_shard"))})
    return graphs.groupBy(*PLACE).cogroup(asked.groupBy(*PLACE))


def audited_beams(shards: DataFrame, threshold: float) -> DataFrame:
    """``(label, dims, beam, kind, queries, found)``: the audit of every meeting, summed over a label.

    The audited vectors of each shard are put to the graph of every shard
    and compared with all its rows; only they move. ``found / queries`` is the
    recall of the average query of that kind (0: up to 32 true pairs, 1: more).
    """
    sample = shards.select("label", "dims", "shard", F.col("units").alias("q_units"), "audited")

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["q_units"] = [_matrix([u], int(d))[np.frombuffer(a, "<i8")].tobytes() for u, d, a in zip(frame["q_units"], frame["dims"], frame["audited"])]
            yield frame
    picked = sample.mapInPandas(pick, sample.schema)

    def measure(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in left.itertuples():
            x = _matrix([row.units], int(row.dims))
            graph, total = Graph.unpack(x, row.graph), 0
            for q in right.itertuples():
                own = np.frombuffer(q.audited, "<i8") if q.q_shard == row.shard else None
                total = total + audit(graph, x, _matrix([q.q_units], int(row.dims)), threshold, BEAMS, own)
            out += [(key[0], key[1], beam, kind, int(total[b, kind, 0]), float(total[b, kind, 1])) for b, beam in enumerate(BEAMS) for kind in (0, 1)]
        return pd.DataFrame(out, columns=["label", "dims", "beam", "kind", "queries", "found"])
    met = _meetings(shards.select("label", "dims", "shards", "shard", "units", "graph"), picked).applyInPandas(
        measure, "label string, dims int, beam int, kind int, queries long, found double")
    return met.groupBy("label", "dims", "beam", "kind").agg(F.sum("queries").alias("queries"), F.sum("found").alias("found"))


def chosen_beams(audits: DataFrame, recall: float) -> DataFrame:
    """``(label, dims, beam)``: the narrowest beam at which both kinds of a label's queries, and of all labels together, reach ``recall``.

    Labels with few links are carried by the pool of all labels. The widest
    beam is as wide as a shard.
    """
    pooled = {(r.beam, r.kind): (r.queries, r.found) for r in audits.groupBy("beam", "kind").agg(
        F.sum("queries").alias("queries"), F.sum("found").alias("found")).collect()}
    enough = [beam for beam in BEAMS if all(pooled.get((beam, kind), (0, 0))[1] >= recall * pooled.get((beam, kind), (0, 0))[0] for kind in (0, 1))]
    least = min(enough, default=BEAMS[-1])
    good = audits.groupBy("label", "dims", "beam").agg(F.bool_and(F.col("found") >= recall * F.col("queries")).alias("good"))
    own = good.groupBy("label", "dims").agg(F.coalesce(F.min(F.when(F.col("good"), F.col("beam"))), F.lit(BEAMS[-1])).alias("beam"))
    return own.withColumn("beam", F.greatest("beam", F.lit(least)))


def _links_of(row, graph: Graph, x: np.ndarray, q, threshold: float) -> pd.DataFrame:
    """``LINKS`` between the vectors of a graph and those of a query shard (or among its own)."""
    own = q.q_shard == row.shard
    found = range_pairs(graph, x, _matrix([q.q_units], int(row.dims)), threshold, int(row.beam))
    if own:
        np.fill_diagonal(found, False)
        linked, raw, weights = found | found.T, row.digests, np.frombuffer(row.weights, np.int64)
    else:
        linked, raw = two_sided(found), q.q_digests + row.digests
        weights = np.concatenate([np.frombuffer(q.q_weights, np.int64), np.frombuffer(row.weights, np.int64)])
    some = np.flatnonzero(linked.any(axis=1))
    near = linked[np.ix_(some, some)]
    digest = np.array([raw[16 * i:16 * i + 16] for i in some], dtype=object)
    return pd.DataFrame({"a": digest, "b": digest[forest(near)], "links": near @ weights[some] if len(some) else np.zeros(0, np.int64)})


def shard_links(shards: DataFrame, beams: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, links)`` of every pair of shards of a label: each vector with links there, its forest parent, its link weight.

    All vectors of a shard are queries; they are put to the graph of their
    own shard and of every other one, once for each unordered pair, with the
    beam of their label.
    """
    queries = shards.select("label", "dims", "shard", *[F.col(c).alias("q_" + c) for c in ("digests", "weights", "units")])
    # One row a label.
    graphs = shards.drop("audited").join(beams, ["label", "dims"])

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = [pd.DataFrame({"a": [], "b": [], "links": []})]
        for row in left.itertuples():
            x = _matrix([row.units], int(row.dims))
            graph = Graph.unpack(x, row.graph)
            parts += [_links_of(row, graph, x, q, threshold) for q in right.itertuples()]
        return pd.concat(parts).astype({"links": "int64"})
    return _meetings(graphs, queries).applyInPandas(search, LINKS)


def near_duplicates(embeddings: DataFrame, threshold: float = 0.98, recall: float = 0.99, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every vector.

    Vectors of one label (and dimension) are linked when their cosine in
    double precision is at least ``threshold``. Equal directions are one
    vector with a weight, so groups of copies never meet as pairs; different
    ones are searched through the graph of every shard of their label, with a
    beam at which audits of the label reach ``recall``, and verified. Null
    labels, and vectors that are null, empty, zero or hold
    null or non-finite components, link with nothing. ``component_id`` is the
    smallest id reachable by links, ``kept`` marks it (all rows that repeat
    that id); a null id is larger than any other. Empty tables give empty
    results.
    """
    rows = materialise(unit_rows(embeddings, id_col, vector_col, label_col), "units")
    good = rows.where("digest is not null")
    classes = materialise(good.groupBy("label", "dims", "digest").agg(
        F.min("id").alias("rep"), F.count("*").alias("weight"), F.first("unit").alias("unit")), "vectors")
    shards = materialise(build_shards(classes.drop("rep")), "shards")
    beams = chosen_beams(materialise(audited_beams(shards, threshold), "recall"), recall)
    links = materialise(shard_links(shards, beams, threshold), "vector-links")
    grouped = connected_components(links.select("a", "b"))
    degree = links.groupBy("a").agg(F.sum("links").alias("links"))
    info = (classes.select(F.col("digest").alias("key"), "rep", "weight").join(grouped, F.col("key") == F.col("node"), "left")
            .join(degree, F.col("key") == F.col("a"), "left")
            .select("key", "rep", F.coalesce("component", "key").alias("component"),
                    (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    info = materialise(info, "vector-info")
    first = info.groupBy("component").agg(F.min("rep").alias("component_id")).select(
        reshuffled(F.col("component")).alias("component"), "component_id")
    full = info.join(first, "component").select(reshuffled(F.col("key")).alias("key"), "n_links", "component_id")
    out = rows.select("id", F.col("digest").alias("key")).join(full, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def op7_embeddings(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings).withColumnRenamed("id", "vec_id")


OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
     g AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND list_max(list_transform(e, lambda x: abs(x))) > 0),
     l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
           WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
     reach AS (SELECT vec_id AS d, vec_id AS r FROM v UNION SELECT l.b AS d, reach.r FROM reach JOIN l ON l.a = reach.d),
     c AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d)
SELECT d AS vec_id, (SELECT count(*) FROM l WHERE l.a = c.d) AS n_links, component_id, d = component_id AS kept FROM c
"""
