"""Dense row numbers in the order of a unique key, without a global sort or a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .fill import DEFAULT_BLOCK, FILE_ORDER, NAME_HEAD

#: Block numbers that share a window of the prefix sums.
GROUP_BITS = 16


def _offsets(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``counts`` (rows ``_n`` of each combination of the nested ``keys``) with ``_before``: the rows of all earlier ones.

    Sums are carried level by level: within the groups of all keys but the
    last, then over the groups, so a window holds one group's members only.
    """
    *up, key = keys
    before = Window.partitionBy(*up).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    local = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")))
    if not up:
        return local
    above = _offsets(counts.groupBy(*up).agg(F.sum("_n").alias("_n")), up).select(*up, F.col("_before").alias("_above"))
    return local.join(above, up).withColumn("_before", F.col("_before") + F.col("_above")).drop("_above")


def with_dense_number(df: DataFrame, order: str, name: str = "n", start: int = 0, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in ``order`` without gaps.

    ``order`` is a unique integer column or the key of
    ``with_file_order_key``; its values may have gaps and rows may have been
    filtered out. Rows are counted per block of the key (a range of the
    integer, or of a file's rows), the counts are summed up in levels, and
    each block is numbered by itself: rows are shuffled once, by block. The
    numbers follow from the key alone, so a retried task gives the same ones.
    Two rows of one key are numbered in no fixed order; null keys are an
    error.
    """
    kind = dict(df.dtypes).get(order)
    bits = max(1, (int(block) - 1).bit_length())
    keyed = lambda null, at: F.when(null, F.raise_error(F.lit("a row has no order key")).cast("long")).otherwise(at)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        at = keyed(F.col(order).isNull(), F.col(order).cast("long"))
        block_no = F.shiftright(at, bits)
        levels, left = [], 64 - bits
        while left > GROUP_BITS:
            levels.insert(0, F.shiftright(block_no, GROUP_BITS * (len(levels) + 1)))
            left -= GROUP_BITS
        place = {f"_n_up{i}": c for i, c in enumerate(levels)} | {"_n_block": block_no}
    elif kind == FILE_ORDER:
        at = keyed(F.col(order)["row"].isNull(), F.col(order)["row"])
        place = {"_n_folder": F.col(order)["folder"], "_n_head": F.left(F.col(order)["file"], F.lit(NAME_HEAD)),
                 "_n_file": F.col(order)["file"], "_n_block": F.shiftright(at, bits)}
    else:
        raise TypeError(f"order key {order!r} must be a unique integer column or a file-order key (got {kind})")
    keys = list(place)
    tagged = df.withColumns({"_n_at": at, **place})
    offsets = _offsets(tagged.groupBy(*keys).agg(F.count("*").alias("_n")), keys).select(*keys, "_before")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_n_at")) - 1 + F.lit(start)
    joined = tagged.withColumn("_n_own", number.cast("long")).join(offsets, keys)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != name], (F.col("_n_own") + F.col("_before")).alias(name))
