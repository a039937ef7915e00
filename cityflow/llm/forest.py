"""N-gram Jaccard join with a MinHash LSH forest.

Each trie of the forest sorts documents by MinHash values of its own; two
documents meet where they share a prefix. The prefix begins at the longest
that gives a pair at the threshold the wanted recall, and is shortened while
an audit of sampled documents, compared with all others, finds less. Pairs
that met are verified exactly, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.common import materialise, reshuffled
from cityflow.llm.components import connected_components
from cityflow.llm.links import forest, two_sided
from cityflow.llm.shingles import grouped_texts, set_digest, shingle_sets

#: Prefix tries, longest prefix of a trie, wanted recall of a pair at the threshold, Jaccard threshold.
TRIES, LONGEST, RECALL, SIMILARITY = 24, 8, 0.9999, 0.8
#: Members and shingles of one block of documents compared together.
BLOCK_MEMBERS, BLOCK_SHINGLES = 512, 400_000
#: Documents of the audit's sample, on average, and shingles of a sampled text at most.
AUDIT_DOCS, AUDIT_SHINGLES = 256, 1 << 14

SIGNED = T.StructType([T.StructField("id", T.LongType()), T.StructField("text_hash", T.LongType()),
                       T.StructField("digest", T.BinaryType()), T.StructField("size", T.IntegerType()),
                       T.StructField("prefixes", T.ArrayType(T.LongType())), T.StructField("near", T.ArrayType(T.BinaryType()))])
SETS = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("block", T.LongType()),
                     T.StructField("weight", T.LongType()), T.StructField("shingles", T.BinaryType())])
LINKS = "a binary, b binary, links long"


def prefix_length(similarity: float = SIMILARITY, tries: int = TRIES, recall: float = RECALL, longest: int = LONGEST) -> int:
    """Longest prefix at which a pair of the given similarity meets in some trie with the wanted recall.

    Where the audit begins: full prefixes are shortened until the expected
    share of such pairs that meet, 1 - (1 - s^k)^tries, is enough. Everything
    that meets at a longer prefix meets at this one too.
    """
    for k in range(longest, 0, -1):
        if 1 - (1 - similarity ** k) ** tries >= recall:
            return k
    raise ValueError("more tries are needed for this recall")


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2024)
    return (rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)), rng.integers(0, 1 << 32, count, dtype=np.uint32)


def prefix_hashes(sets: list[np.ndarray], tries: int, prefix: int) -> np.ndarray:
    """For each set, the hash of the first ``prefix`` MinHash values of every trie."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.concatenate(sets)
    low = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    factors, shifts = _permutations(tries * prefix)
    out = np.zeros((len(sets), tries), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(tries):
            key = np.full(len(sets), t + 1, np.uint64)
            for p in range(t * prefix, (t + 1) * prefix):
                values = low * factors[p]
                values += shifts[p]
                key = (key ^ np.minimum.reduceat(values, starts).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            out[:, t] = key
    return out.view(np.int64)


class Sample:
    """Shingle sets of the audit's documents, looked up by shingle."""

    def __init__(self, sets: dict[bytes, np.ndarray]):
        self.digests = sorted(sets)
        self.sizes = np.array([len(sets[d]) for d in self.digests], float)
        flat = np.concatenate([sets[d] for d in self.digests]) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(self.digests)), self.sizes.astype(int))
        order = np.argsort(flat, kind="stable")
        self._shingles, self._owner = flat[order], owner[order]

    def near(self, shingles: np.ndarray, digest: bytes, similarity: float) -> list[bytes]:
        """The sampled sets with a Jaccard similarity of at least ``similarity`` to another set."""
        if not len(self._shingles):
            return []
        low, high = (np.searchsorted(self._shingles, shingles, side) for side in ("left", "right"))
        n = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(self._owner[at], minlength=len(self.digests))
        hits = np.flatnonzero(common >= similarity * (self.sizes + len(shingles) - common) - 1e-6)
        return [self.digests[i] for i in hits if self.digests[i] != digest]


def audit_sample(documents: DataFrame, id_col: str, text_col: str, docs: int = AUDIT_DOCS) -> Sample:
    """About ``docs`` documents drawn by a hash of their id; their shingles reach the driver (2^14 of a text at most, longer texts are not drawn)."""
    n = documents.count()
    scale = 1 << 40
    drawn = documents.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(29)), F.lit(scale)) < F.lit(int(scale * min(1.0, docs / max(n, 1)))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in grouped_texts(batch.column(0)):
                sets = [s for s in shingle_sets(texts) if 0 < len(s) <= AUDIT_SHINGLES]
                yield pa.RecordBatch.from_arrays([pa.array([set_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 names=["digest", "shingles"])
    got = drawn.select(text_col).mapInArrow(read, "digest binary, shingles binary").limit(4 * docs).collect()
    return Sample({bytes(r.digest): np.frombuffer(bytes(r.shingles), np.uint64) for r in got})


def signatures(documents: DataFrame, id_col: str, text_col: str, tries: int, prefix: int, sample: Sample | None = None,
               similarity: float = SIMILARITY) -> DataFrame:
    """``SIGNED`` row of each document; digest and prefixes are null without words.

    ``near`` are the sampled sets that the document's set is linked with.
    """
    sample = sample or Sample({})

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.binary())]
        for batch in batches:
            for first, texts in grouped_texts(batch.column(2)):
                sets = shingle_sets(texts)
                some = [i for i, s in enumerate(sets) if len(s)]
                keys = dict(zip(some, prefix_hashes([sets[i] for i in some], tries, prefix).tolist())) if some else {}
                digests = [set_digest(s) if len(s) else None for s in sets]
                near = [sample.near(s, d, similarity) if d else [] for s, d in zip(sets, digests)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)),
                     pa.array(digests, types[2]), pa.array([len(s) for s in sets], types[3]),
                     pa.array([keys.get(i) for i in range(len(sets))], types[4]), pa.array(near, types[5])], names=SIGNED.names)
    return documents.select(F.col(id_col).cast("long"), F.xxhash64(text_col), F.col(text_col)).mapInArrow(sign, SIGNED)


def audited(signed: DataFrame) -> tuple[int, int]:
    """(true pairs of sampled with other sets, those of them that meet in some trie)."""
    pairs = signed.where(F.size("near") > 0).select("digest", "prefixes", F.explode("near").alias("sampled")).dropDuplicates(["digest", "sampled"])
    # At most four times ``AUDIT_DOCS`` sets.
    wanted = signed.select(F.col("digest").alias("sampled"), F.col("prefixes").alias("own")).join(
        F.broadcast(pairs.select("sampled").distinct()), "sampled", "left_semi").dropDuplicates(["sampled"])
    met = pairs.join(F.broadcast(wanted), "sampled").select(F.arrays_overlap("prefixes", "own").alias("met"))
    row = met.agg(F.count("*"), F.count_if("met")).first()
    return row[0], row[1]


def planted_forest(documents: DataFrame, similarity: float, tries: int, recall: float, id_col: str, text_col: str) -> DataFrame:
    """``SIGNED`` rows at the longest prefix that reaches ``recall``: expected at the threshold, and measured by the audit.

    While the audit misses pairs, prefixes are shortened by one value and
    documents signed again.
    """
    sample = audit_sample(documents, id_col, text_col)
    for prefix in range(prefix_length(similarity, tries, recall), 0, -1):
        signed = materialise(signatures(documents, id_col, text_col, tries, prefix, sample, similarity), "signatures")
        true, met = audited(signed)
        if met >= recall * true:
            break
    return signed


def _opaque(key: str):
    """A long key as an expression the planner takes for a new one, so that both sides of a join are shuffled and skew can be split."""
    return F.col(key).bitwiseXOR(F.lit(0).cast("long")).alias(key)


def met_blocks(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes that met another as members of blocks ``(digest, rep, weight, block)``, and the pairs ``(i, j)`` of blocks that met, i <= j.

    Classes that are reachable by meetings are cut into blocks of bounded
    size. A class is at home in the largest bucket (trie and prefix) it
    shares; small homes stay in one block, so that in a large loose component
    few pairs of blocks meet, and only those are compared. A large home is a
    dense group and spread evenly. A row is made per bucket and pair of
    blocks, never per pair of classes.
    """
    met = classes.select("digest", F.explode("prefixes").alias("bucket"))
    sizes = met.groupBy("bucket").agg(F.count("*").alias("n"), F.min("digest").alias("low")).where("n > 1").select(_opaque("bucket"), "n", "low")
    shared = materialise(met.join(sizes, "bucket"), "shared")
    home = shared.groupBy("digest").agg(F.max(F.struct("n", "bucket")).alias("home"))
    near = connected_components(shared.where("digest <> low").select(F.col("digest").alias("a"), F.col("low").alias("b")))
    members = (home.join(near, F.col("digest") == F.col("node")).drop("node")
               .join(classes.select(F.col("digest").alias("d"), "rep", "weight", "size"), F.col("digest") == F.col("d")).drop("d"))
    members = materialise(members, "members")
    blocks = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    blocks = blocks.select(reshuffled(F.col("component")).alias("component"), "blocks")
    spread = F.when(F.col("home.n") * 2 <= BLOCK_MEMBERS, F.xxhash64("home.bucket")).otherwise(F.xxhash64("digest"))
    placed = members.join(blocks, "component").select("digest", "rep", "weight", F.xxhash64("component", F.pmod(spread, F.col("blocks"))).alias("block"))
    placed = materialise(placed, "placed")
    seen = shared.select("digest", "bucket").join(placed.select(reshuffled(F.col("digest")).alias("digest"), "block"), "digest").select("bucket", "block").distinct()
    seen = materialise(seen, "met")
    other = seen.select(_opaque("bucket"), F.col("block").alias("j"))
    pairs = seen.withColumnRenamed("block", "i").join(other, "bucket").where("i <= j").select("i", "j").distinct()
    return placed, materialise(pairs, "block-pairs")


def _sets(documents: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``SETS`` rows of the wanted classes, their shingles read again from the document of the smallest id."""
    # The wanted classes grow with the corpus, so the join is planned as a shuffle at every size.
    reps = wanted.select(F.col("rep").alias("__rep"), "digest", "block", "weight").hint("merge")
    rows = documents.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")) \
        .join(reps, F.col("__id").eqNullSafe(F.col("__rep"))).select("__text", "digest", "block", "weight")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in grouped_texts(batch.column(0)):
                sets = shingle_sets(texts)
                part = batch.slice(first, len(texts))
                same = pa.array([set_digest(s) == d.as_py() for s, d in zip(sets, part.column(1))], pa.bool_())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array([s.tobytes() for s in sets], pa.binary())], names=SETS.names).filter(same)
    return rows.mapInArrow(read, SETS)


def common_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, as products of 0/1 matrices over the shingles several sets have."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    rank = np.cumsum(new) - 1
    shared = np.bincount(rank)[rank] > 1
    owner, rank = owner[shared], rank[shared]
    out = np.zeros((len(sets), len(sets)), np.float32)
    if len(rank):
        rank = np.cumsum(np.concatenate([[0], rank[1:] != rank[:-1]]))
        for at in range(0, int(rank[-1]) + 1, columns):
            lo, hi = np.searchsorted(rank, [at, at + columns])
            part = np.zeros((len(sets), columns), np.float32)
            part[owner[lo:hi], rank[lo:hi] - at] = 1
            out += part @ part.T
    return out


def _link_block(similarity: float):
    """Links inside one pair of blocks: a row per member with links, its parent in a spanning forest and its link weight."""
    def link(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        i, j = key
        frame = frame.drop_duplicates("digest").reset_index(drop=True)
        if len(frame) < 2:
            return pd.DataFrame({"a": [], "b": [], "links": []})
        sets = [np.frombuffer(b, np.uint64) for b in frame["shingles"]]
        sizes = np.array([len(s) for s in sets], dtype=float)
        common = common_counts(sets)
        linked = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-6
        np.fill_diagonal(linked, False)
        block = frame["block"].to_numpy()
        if i != j:
            linked &= block[:, None] != block[None, :]
        links = linked.astype(np.float64) @ frame["weight"].to_numpy(dtype=float)
        parent = forest(linked)
        some = np.flatnonzero(links > 0)
        digest = frame["digest"].to_numpy()
        return pd.DataFrame({"a": digest[some], "b": digest[parent[some]], "links": links[some].astype(np.int64)})
    return link


def jaccard_classes(documents: DataFrame, similarity: float = SIMILARITY, tries: int = TRIES, recall: float = RECALL,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text_hash, digest, class_digest, class_id, n_links)`` of every document.

    Two documents are linked when the Jaccard similarity of their distinct
    word shingles is at least ``similarity``; ``n_links`` counts the other
    documents linked directly, ``class_id`` is the smallest id reachable by
    links. Documents of equal shingle sets are one class from the start.
    Classes that share a trie prefix are compared exactly, block by block
    (see :func:`met_blocks`), each set moving once per pair of blocks that
    met; links are counted inside the task, so no row is made per pair. Texts
    without words link with nothing: ``class_id`` is their own id and digest
    is null. Repeated rows count as documents; null ids are larger than all
    others.
    """
    signed = planted_forest(documents, similarity, tries, recall, id_col, text_col)
    classes = materialise(signed.where("digest is not null").groupBy("digest").agg(
        F.min("id").alias("rep"), F.count("*").alias("weight"), F.first("size").alias("size"), F.first("prefixes").alias("prefixes")), "classes")
    placed, pairs = met_blocks(classes)
    sides = pairs.select(F.explode(F.array_distinct(F.array("i", "j"))).alias("block"), "i", "j")
    links = materialise(_sets(documents, placed, id_col, text_col).join(sides, "block")
                        .select("i", "j", "digest", "block", "weight", "shingles")
                        .groupBy("i", "j").applyInPandas(_link_block(similarity), LINKS), "links")
    grouped = connected_components(links.select("a", "b"))
    degree = links.groupBy("a").agg(F.sum("links").alias("links"))
    info = (classes.select("digest", "rep", "weight").join(grouped, F.col("digest") == F.col("node"), "left")
            .join(degree, F.col("digest") == F.col("a"), "left")
            .select("digest", "rep", F.coalesce("component", "digest").alias("class_digest"),
                    (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    info = materialise(info, "class-info")
    first = info.groupBy("class_digest").agg(F.min("rep").alias("class_id"))
    first = first.select(reshuffled(F.col("class_digest")).alias("class_digest"), "class_id")
    full = info.drop("rep").join(first, "class_digest")
    full = full.select(reshuffled(F.col("digest")).alias("digest"), "class_digest", "class_id", "n_links")
    out = signed.select("id", "text_hash", "digest").join(full, "digest", "left")
    return out.select("id", "text_hash", "digest", "class_digest",
                      F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of every class of :func:`jaccard_classes`: the smallest id, then the smallest text hash.

    Texts without words all stay; rows equal in id and text are one document.
    """
    found = materialise(jaccard_classes(documents, id_col=id_col, text_col=text_col, **options), "jaccard")
    best = found.where("digest is not null").groupBy("class_digest").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("best"))
    keep = best.select("best.id", "best.text_hash").union(found.where("digest is null").select("id", "text_hash").distinct())
    keep = keep.withColumnsRenamed({"id": "__id", "text_hash": "__hash"})
    text_hash = F.xxhash64(text_col)
    rows = documents.withColumn("__text_hash", text_hash)
    kept = rows.join(keep, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left_semi")
    return kept.dropDuplicates([id_col, "__text_hash"]).select(*documents.columns)


def op9_jaccard(documents: DataFrame) -> DataFrame:
    return jaccard_classes(documents).select(F.col("id").alias("doc_id"), "class_id", "n_links",
                                             F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


OP9_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\r\f\v]+'), lambda x: x <> '') AS ws FROM documents),
     n AS (SELECT doc_id, ws, len(ws) AS c FROM w WHERE len(ws) > 0),
     s AS (SELECT doc_id, list_distinct(CASE WHEN c < 5 THEN [array_to_string(ws, ' ')]
                  ELSE list_transform(range(1, c - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS ss FROM n),
     x AS (SELECT doc_id, len(ss) AS size, unnest(ss) AS sh FROM s),
     shared AS (SELECT a.doc_id AS a, b.doc_id AS b, a.size AS na, b.size AS nb, count(*) AS c
              FROM x a JOIN x b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
     e AS (SELECT a, b FROM shared WHERE c * 5 >= 4 * (na + nb - c)),
     reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT e.b AS d, reach.r FROM reach JOIN e ON e.a = reach.d),
     cls AS (SELECT d, min(r) AS class_id FROM reach GROUP BY d)
SELECT d AS doc_id, class_id, (SELECT count(*) FROM e WHERE e.a = cls.d) AS n_links, d = class_id AS kept FROM cls
"""
