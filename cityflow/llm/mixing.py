"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Mean of one Poisson draw at most; a larger rate is the sum of several draws.
PART_RATE = 500.0
#: A rate table of at most so many rows (each under 8 kB) is broadcast; a larger one is joined by shuffle.
BROADCAST_SOURCES = 1000
ADDED = ("part", "copy", "order_key")


def target_rates(documents: DataFrame, weights: dict | None = None, exponent: float = 0.5, source_col: str = "source") -> DataFrame:
    """``(source, rate)``: mean copies of a document so that sources reach their weights.

    Rate is weight share times rows over the source's rows, so the expected
    output has as many rows as the input. ``weights`` maps source (None for
    null) to weight, absent ones getting 0; by default a source weighs its
    rows to the power ``exponent``. Weights that are all zero give rates 0.
    """
    counts = documents.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow("n", F.lit(exponent)))
    else:
        named = {k: float(v) for k, v in weights.items() if k is not None}
        table = F.create_map(*[F.lit(x) for kv in named.items() for x in kv]) if named else F.create_map().cast("map<string,double>")
        value = F.when(F.col("source").isNull(), F.lit(float(weights.get(None, 0.0)))).otherwise(
            F.try_element_at(table, F.col("source").cast("string")))
        weighed = counts.withColumn("weight", F.coalesce(value, F.lit(0.0)))
    rows, weight = weighed.agg(F.sum("n"), F.sum("weight")).first()
    share = F.col("weight") / F.lit(float(weight)) if weight else F.lit(0.0)
    return weighed.select("source", (share * F.lit(float(rows or 0)) / F.col("n")).alias("rate"))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until the rest is below 2^-53; the rate is at most ``PART_RATE``."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all"))

    def add(state, k):
        p = state["p"] * rate / k
        c = state["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.array_append(state["all"], c).alias("all"))
    return F.aggregate(F.sequence(F.lit(1), last), start, add, lambda s: s["all"])


def _md5(*parts: Column) -> Column:
    return F.md5(F.encode(F.concat_ws(":", *[p.cast("string") for p in parts]), "UTF-8"))


def replicate(documents: DataFrame, rates: DataFrame, seed: int = 1, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Every document as often as its Poisson draw says, in a global random order.

    The draw inverts the Poisson distribution at a uniform number hashed from
    (id, seed, part), so it does not depend on partitions, order or retries;
    rows repeating an id draw alike. Copies get ``part``, ``copy`` (from 1)
    and ``order_key``, which deals and sorts the rows; columns of these names
    are replaced. Rates above ``PART_RATE`` are drawn in parts, each exploded
    by itself, so no array grows with the rate. Documents without a rate, or
    with rate 0, go. Null ids draw as ``null``; null sources match the null
    rate.
    """
    names = [c for c in documents.columns if c not in ADDED]
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_RATE)).cast("int")
    spec = (rates.where("rate > 0").withColumn("parts", parts)
            .select(F.col("source").alias("__source"), F.col("parts").alias("__parts"), poisson_cdf(F.col("rate") / F.col("parts")).alias("__cdf")))
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        spec = F.broadcast(spec)
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    drawn = documents.select(*names).join(spec, F.col(source_col).eqNullSafe(F.col("__source"))) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    uniform = (F.conv(F.substring(_md5(ident, F.lit(seed), F.col("part")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    drawn = drawn.withColumn("__u", uniform).withColumn("__n", F.size(F.filter("__cdf", lambda c: c < F.col("__u")))).where("__n > 0")
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    keyed = copies.select(*names, "part", "copy", _md5(ident, F.lit(seed), F.col("part"), F.col("copy")).alias("order_key"))
    return keyed.repartition(F.col("order_key")).sortWithinPartitions("order_key")


def op3_mixing(documents: DataFrame) -> DataFrame:
    return replicate(documents, target_rates(documents))


OP3_SQL = f"""
WITH RECURSIVE w AS (SELECT source, count(*) AS n, pow(count(*), 0.5) AS weight FROM documents GROUP BY source),
     rate AS (SELECT source, weight / (SELECT sum(weight) FROM w) * (SELECT sum(n) FROM w) / n AS rate FROM w),
     spec AS (SELECT source, greatest(1, ceil(rate / {PART_RATE}))::INTEGER AS parts, rate / greatest(1, ceil(rate / {PART_RATE})) AS l FROM rate WHERE rate > 0),
     cdf AS (SELECT source, parts, l, 0 AS k, exp(-l) AS p, exp(-l) AS c FROM spec
             UNION ALL
             SELECT source, parts, l, k + 1, p * l / (k + 1), c + p * l / (k + 1) FROM cdf WHERE k + 1 <= ceil(l + 12 * sqrt(l) + 20)),
     cdfs AS (SELECT source, any_value(parts) AS parts, list(c ORDER BY k) AS cs FROM cdf GROUP BY source),
     parted AS (SELECT d.*, cs, unnest(range(parts)) AS part FROM documents d JOIN cdfs ON d.source IS NOT DISTINCT FROM cdfs.source),
     u AS (SELECT *, (('0x' || substr(md5(doc_id || ':1:' || part), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM parted),
     n AS (SELECT *, len(list_filter(cs, lambda c: c < u)) AS cnt FROM u),
     copies AS (SELECT *, unnest(range(1, cnt + 1)) AS copy FROM n WHERE cnt > 0)
SELECT doc_id, text, lang, source, n_chars, part::INTEGER AS part, copy::INTEGER AS copy,
       md5(doc_id || ':1:' || part || ':' || copy) AS order_key FROM copies
"""
assert math.exp(-PART_RATE) > 0
