"""Exact deduplication with a minimal perfect hash over historical digests."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from cityflow.llm.common import ASCII_SPACE, materialise

#: Digests per bucket on average, and wanted keys per part of a bucket.
BUCKET_KEYS = 16
PART_KEYS = 4
PART_MAX = 8

# Fixed values of the public XXH64 hash (as in Spark's xxhash64 of a long).
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                              0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def normalised(text: Column) -> Column:
    """Text without space and 0x09-0x0D; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), ASCII_SPACE, "")


def digest_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest, n_code_points)`` of every row; the text goes no further."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("id"), F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest"),
                     F.length(text).cast("long").alias("n_code_points"))


def _rank(n_code_points: Column, id_: Column) -> Column:
    """Greatest for the row that stays: most code points, then the smallest id; a null id loses to any other."""
    return F.struct(n_code_points.alias("n_code_points"), id_.isNotNull().alias("known"), F.bitwise_not(id_).alias("minus"))


def winners(rows: DataFrame) -> DataFrame:
    """Distinct digests with group size and the locator of the row that stays (see :func:`_rank`)."""
    out = rows.groupBy("digest").agg(F.max(_rank(F.col("n_code_points"), F.col("id"))).alias("best"), F.count("*").alias("group_size"))
    return out.select("digest", F.bitwise_not("best.minus").alias("keep_id"),
                      F.col("best.n_code_points").alias("keep_code_points"), "group_size")


def _key(digest: Column) -> Column:
    """The first 60 bits of a digest as a long."""
    return F.conv(F.substring(F.hex(digest), 1, 15), 16, 10).cast("long")


def _xxh64(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of one long with a running seed, on uint64 arrays."""
    def rot(x, r):
        return (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    h = seed + P5 + np.uint64(8)
    h = h ^ (rot(value * P2, 31) * P1)
    h = rot(h, 27) * P1 + P4
    h = h ^ (h >> np.uint64(33))
    h = h * P2
    h = h ^ (h >> np.uint64(29))
    h = h * P3
    return h ^ (h >> np.uint64(32))


def _seeded(keys: np.ndarray, seed) -> np.ndarray:
    """xxhash64(key, seed) as Spark computes it, signed."""
    seeds = np.asarray(seed, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return _xxh64(seeds, _xxh64(keys.astype(np.uint64), np.uint64(42))).astype(np.int64)


def place_bucket(keys: np.ndarray) -> tuple[int, list[int], list[int], np.ndarray]:
    """(split seed, part starts, part seeds, slot of each key): no two keys share a slot and no slot is free.

    Keys are split into parts of at most ``PART_MAX`` by a hash whose seed is
    tried upwards; for each part a seed is sought whose hash is a bijection.
    Keys equal in their 60 bits cannot be told apart; the caller keeps those
    out.
    """
    n, parts = len(keys), max(1, -(-len(keys) // PART_KEYS))
    split, part = 0, np.zeros(n, dtype=np.int64)
    while parts > 1:
        part = np.mod(_seeded(keys, split), parts)
        if np.bincount(part, minlength=parts).max() <= PART_MAX:
            break
        split += 1
    starts = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
    seeds, slots = [], np.empty(n, dtype=np.int64)
    for p in range(parts):
        own = np.flatnonzero(part == p)
        m, at, step = len(own), 0, 64
        while m:
            tries = np.arange(at, at + step, dtype=np.uint64)
            got = np.mod(_seeded(keys[own][:, None], tries[None, :]), m)
            good = np.flatnonzero((np.sort(got, axis=0) == np.arange(m)[:, None]).all(axis=0))
            if len(good):
                at += int(good[0])
                slots[own] = starts[p] + got[:, good[0]]
                break
            at, step = at + step, min(step * 2, 4096)
        seeds.append(at)
    return split, starts.tolist(), seeds, slots


PLACED = "split long, starts array<int>, seeds array<long>, slots array<int>"


def _place(keys: pd.Series) -> pd.DataFrame:
    out = [place_bucket(np.asarray(k, dtype=np.int64)) for k in keys]
    return pd.DataFrame({"split": [x[0] for x in out], "starts": [x[1] for x in out],
                         "seeds": [x[2] for x in out], "slots": [x[3].tolist() for x in out]})


def build_index(distinct: DataFrame) -> DataFrame:
    """One row per bucket of a minimal perfect hash over ``distinct`` (see :func:`winners`).

    ``slots`` holds, at a digest's slot, the full digest with its winner
    locator; ``split``, ``starts`` and ``seeds`` are the function. Bucket and
    part sizes do not depend on the number of digests, so a bucket is a small
    row at any scale. Digests whose first 60 bits occur twice go to
    ``overflow``, compared in full.
    """
    keyed = distinct.withColumn("key", _key(F.col("digest")))
    n = keyed.count()
    buckets = max(1, 1 << max(0, (n // BUCKET_KEYS).bit_length()))
    entry = F.struct("digest", "keep_id", "keep_code_points", "group_size")
    rows = (keyed.groupBy(F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"), "key")
            .agg(F.collect_list(entry).alias("e"))
            .groupBy("bucket").agg(F.collect_list(F.when(F.size("e") == 1, F.struct("key", F.col("e")[0].alias("e")))).alias("ones"),
                                   F.flatten(F.collect_list(F.when(F.size("e") > 1, F.col("e")))).alias("overflow")))
    placed = rows.withColumn("f", pandas_udf(_place, PLACED)(F.transform("ones", lambda x: x["key"])))
    at = F.arrays_zip(F.col("f.slots").alias("slot"), F.col("ones").alias("one"))
    ordered = F.array_sort(F.transform(at, lambda x: F.struct(x["slot"].alias("slot"), x["one"]["e"].alias("e"))),
                           lambda x, y: x["slot"] - y["slot"])
    return placed.select("bucket", F.lit(buckets).cast("long").alias("buckets"), F.col("f.split").alias("split"),
                         F.col("f.starts").alias("starts"), F.col("f.seeds").alias("seeds"),
                         F.transform(ordered, lambda x: x["e"]).alias("slots"), "overflow")


def lookup(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``rows`` with ``hit``: the index entry whose full digest is equal, or null.

    Rows meet their bucket by an equi join (AQE splits a hot bucket, whose
    own side is one row); slot arithmetic and byte check stay in the JVM.
    """
    first = index.select("buckets").first()
    buckets = first[0] if first else 1
    key = _key(F.col("digest"))
    keyed = rows.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
    joined = keyed.join(index.drop("buckets"), "bucket", "left")
    part = F.pmod(F.xxhash64(key, F.col("split")), F.size("seeds").cast("long")).cast("int")
    start, size = F.get("starts", part), F.get("starts", part + 1) - F.get("starts", part)
    slot = start + F.when(size > 0, F.pmod(F.xxhash64(key, F.get("seeds", part)), size.cast("long")).cast("int")).otherwise(0)
    candidate = F.get("slots", slot)
    late = F.when(F.size("overflow") > 0, F.get(F.filter("overflow", lambda x: x["digest"] == F.col("digest")), F.lit(0)))
    hit = F.coalesce(F.when(candidate["digest"] == F.col("digest"), candidate), late)
    return joined.select(*rows.columns, hit.alias("hit"))


def dedup(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Each row of ``rows`` (see :func:`digest_rows`) with its group.

    Rows whose digest is in the index follow the index's winner. The others
    are grouped among themselves by the rule of :func:`winners`. Repeated
    rows of the winning id are all kept, being the same document; a group of
    null ids only has ``keep_id`` null and keeps nothing else. An empty index
    or table works; null text equals empty text.
    """
    found = materialise(lookup(rows, index), "mphf-lookup")
    members = found.where("hit is not null").select(
        "id", "digest", F.col("hit.keep_id").alias("keep_id"), F.col("hit.group_size").alias("group_size"))
    rest = found.where("hit is null").drop("hit")
    own = winners(rest).select(F.substring("digest", 1, 64).alias("digest"), "keep_id", "group_size")
    return members.union(rest.join(own, "digest").select("id", "digest", "keep_id", "group_size")) \
        .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def dedup_with_past(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Each row of ``rows`` with its group over past and new rows together.

    ``rows`` has a column ``past``: the index was built of just these rows.
    Every row is looked up. Members, past rows and new ones whose digest the
    index has, take the better of the index's winner and the best new member;
    nonmembers are grouped apart. Otherwise as :func:`dedup`.
    """
    found = materialise(lookup(rows, index), "mphf-lookup")
    members = found.where("hit is not null")
    late = winners(members.where("not past")).select(
        F.substring("digest", 1, 64).alias("digest"), F.col("keep_id").alias("late_id"),
        F.col("keep_code_points").alias("late_code_points"), F.col("group_size").alias("late_size"))
    known, new = _rank(F.col("hit.keep_code_points"), F.col("hit.keep_id")), _rank(F.col("late_code_points"), F.col("late_id"))
    merged = members.join(late, "digest", "left").select(
        "id", "digest", F.when(F.coalesce(F.col("late_size"), F.lit(0)) == 0, F.col("hit.keep_id"))
        .when(new > known, F.col("late_id")).otherwise(F.col("hit.keep_id")).alias("keep_id"),
        (F.col("hit.group_size") + F.coalesce("late_size", F.lit(0))).alias("group_size"))
    rest = found.where("hit is null").drop("hit")
    own = winners(rest).select(F.substring("digest", 1, 64).alias("digest"), "keep_id", "group_size")
    return merged.union(rest.join(own, "digest").select("id", "digest", "keep_id", "group_size")) \
        .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def op6_exact_dedup(documents: DataFrame) -> DataFrame:
    """The contract's rows. Half of the ids (by a hash) are the history the index is built of; all rows are looked up in it."""
    past = F.pmod(F.xxhash64("id", F.lit(6)), F.lit(2)) == 0
    rows = materialise(digest_rows(documents).withColumn("past", past), "digests")
    index = materialise(build_index(winners(rows.where("past"))), "mphf")
    out = dedup_with_past(rows, index)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents),
     r AS (SELECT doc_id, sha256(n) AS text_sha256,
                  first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id,
                  count(*) OVER (PARTITION BY n) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
