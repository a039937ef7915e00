"""Ordered fill over a whole table without a global sort.

A window ordered over the whole table runs in one task. Here the order key
is cut into blocks: fixed-width ranges of an integer key, or of the row
positions of a file. The key is unique, so a block never holds more than
``block`` rows, whatever the key distribution, and no block can become a hot
partition.

1. per (series, block): nearest non-null in the first direction (one window
   partitioned by series and block, one sort);
2. per (series, block): first and last non-null value (a hash aggregate with
   map-side combine; only one row per block and task is shuffled);
3. carry across blocks in levels: the block summaries are carried within
   groups (2^22 block numbers; or a file, files of a like name, a folder),
   the groups' summaries likewise one level up, until few are left;
4. join the carry back on (series, block) — only the summary side moves —
   and coalesce.

The summary holds about rows / block rows, one per row at most (very sparse keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin

DEFAULT_BLOCK = 1 << 20
FILE_ORDER = "struct<folder:string,file:string,row:bigint>"


def with_order_key(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Attach a unique increasing id in the current row order and pin it.

    ``monotonically_increasing_id`` depends on the partitioning of its input,
    so it is checkpointed once to the reliable checkpoint folder; recomputing
    it after a lost executor could give other ids.
    """
    return pin(df.withColumn(name, F.monotonically_increasing_id()))


def tag_file_order(df: DataFrame) -> DataFrame:
    """File path and row position of a direct file scan as columns, which survive a union of scans."""
    return df.withColumns({"_order_file": F.col("_metadata.file_path"), "_order_row": F.col("_metadata.row_index")})


def with_file_order_key(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique key in file order, recomputable without a checkpoint.

    The key is ``struct(folder, file, row)``, ordered by folder, file name
    and row position, from the scan's hidden ``_metadata`` columns; ``df``
    must be a direct file scan or a union of scans that went through
    :func:`tag_file_order`. Nothing is numbered, so there is no join and no
    limit on files or rows. A re-executed task reads the same file and row
    positions, so the keys never change.
    """
    path, row = "_order_file", "_order_row"
    tagged = df if path in df.columns else tag_file_order(df)
    file = F.substring_index(path, "/", -1)
    folder = F.left(F.col(path), F.length(path) - F.length(file))
    return tagged.withColumn(name, F.struct(folder.alias("folder"), file.alias("file"), F.col(row).alias("row"))).drop(path, row)


CARRY_BITS = 22
NAME_HEAD = 8  # leading characters of a file name that files of one group share


def _carry(summary: DataFrame, cols, by, keys, asc: bool) -> DataFrame:
    """Per summary row: ``_c_`` the nearest value of the rows before it, ``_s_`` the series' edge value.

    ``keys`` are nested, the widest first: rows are carried by the last key
    within the groups of the others, and the groups one level up.
    """
    near, far = ("_l_", "_f_") if asc else ("_f_", "_l_")
    *up, key = keys
    o = F.col(key).asc() if asc else F.col(key).desc()
    group = [*by, *up]
    before = Window.partitionBy(*group).orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
    if not up:
        whole = Window.partitionBy(*by).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return summary.select(*by, key, *[F.last(f"{near}{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in cols],
                              *[F.first(f"{far}{c}", ignorenulls=True).over(whole).alias(f"_s_{c}") for c in cols])
    local = summary.select(*group, key, *[F.last(f"{near}{c}", ignorenulls=True).over(before).alias(f"_b_{c}") for c in cols])
    above = _carry(_summary(summary, cols, group, key, lambda c: (f"_f_{c}", f"_l_{c}")), cols, by, up, asc)
    joined = local.join(above, group, "left")
    return joined.select(*group, key, *[F.coalesce(f"_b_{c}", f"_c_{c}").alias(f"_c_{c}") for c in cols], *[f"_s_{c}" for c in cols])


def _summary(df: DataFrame, cols, group, order: str, ends) -> DataFrame:
    """First and last non-null value of every group, in key order."""
    aggs = []
    for c in cols:
        first, last = ends(c)
        aggs += [F.min_by(first, F.when(F.col(first).isNotNull(), F.col(order))).alias(f"_f_{c}"),
                 F.max_by(last, F.when(F.col(last).isNotNull(), F.col(order))).alias(f"_l_{c}")]
    return df.groupBy(*group).agg(*aggs)


def fill_ordered(df: DataFrame, cols, order: str, by=(), directions=("backward", "forward"),
                 block: int = DEFAULT_BLOCK) -> DataFrame:
    """Fill nulls in ``cols`` from the next (``backward``) and/or previous
    (``forward``) non-null value in ``order``; the first direction wins.

    ``order`` must be a unique integral key (see :func:`with_order_key`) or
    the key of :func:`with_file_order_key`. ``by`` restricts the fill to each
    series (a null key is a series). ``block`` is rounded up to a power of two.
    """
    cols = list(cols)
    kind = dict(df.dtypes).get(order)
    blk, at = "_fill_blk", "_fill_at"
    # A struct is never null and equal to one with the same nulls, so plain
    # equality joins series and the rows keep the partitioning of their window.
    place = {"_fill_by": F.struct(*by)} if by else {}
    by = list(place)
    bits = max(1, (int(block) - 1).bit_length())
    if kind in ("tinyint", "smallint", "int", "bigint"):
        place[at] = F.col(order).cast("long")
        key = F.col(order)
        ups, left = {}, 64 - bits
        while left > CARRY_BITS:
            ups = {f"{blk}_{len(ups) + 1}": F.shiftright(blk, CARRY_BITS * (len(ups) + 1))} | ups
            left -= CARRY_BITS
        keys = [*ups, blk]
    elif kind == FILE_ORDER:
        folder, file, head = "_fill_folder", "_fill_file", "_fill_head"
        place |= {folder: F.col(order)["folder"], file: F.col(order)["file"], at: F.col(order)["row"]}
        key = F.struct(F.col(folder).alias("folder"), F.col(file).alias("file"), F.col(at).alias("row")).alias(order)
        ups, keys = {head: F.left(F.col(file), F.lit(NAME_HEAD))}, [folder, head, file, blk]
    else:
        raise TypeError(f"order key {order!r} must be a unique integer column or a file-order key (got {kind}); see with_order_key")
    part = by + [k for k in keys if k not in ups]
    tagged = df.withColumns(place).withColumn(blk, F.shiftright(at, bits))
    if kind == FILE_ORDER:
        tagged = tagged.drop(order)  # the shuffle carries the path once

    # The first direction is a growing frame (unbounded preceding .. current
    # row) in its own order — evaluated incrementally; "next" is the same
    # frame over the descending order. A frame ending at unbounded following
    # would be re-aggregated per row (quadratic in the block size). The
    # second direction only fills the edge gap the first leaves, where it
    # equals the series' first / last non-null value: no second sort.
    asc = directions[0] == "forward"
    o = F.col(at).asc() if asc else F.col(at).desc()
    w_local = Window.partitionBy(*part).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.withColumns({f"_p_{c}": F.last(c, ignorenulls=True).over(w_local) for c in cols})

    # From the tagged input, not the window output: a partial hash aggregate
    # per map task instead of re-running the sorted block windows.
    summary = _summary(tagged, cols, part, at, lambda c: (c, c))
    carry = _carry(summary.withColumns(ups), cols, by, keys, asc).drop(*ups)
    joined = local.join(carry, part, "left")

    def filled(c):
        parts = [F.col(f"_p_{c}"), F.col(f"_c_{c}")] + ([F.col(f"_s_{c}")] if len(directions) == 2 else [])
        return F.coalesce(*parts)

    out = joined.withColumns({c: filled(c) for c in cols})
    return out.select(*[key if c == order else c for c in df.columns])
