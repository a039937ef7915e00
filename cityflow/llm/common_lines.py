"""Lines of a text as an array, with some of them taken out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space inside a line.
LINE_SPACE = r"[ \t\r\f\x0b]+"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def without_lines(text: Column, dropped: Column) -> Column:
    """``text`` without the lines at the sorted positions ``dropped`` (null or empty: none).

    The stretches between dropped lines are cut out one by one, so the work
    is the length of the text however many lines go.
    """
    lines = lines_of(text)
    start = lambda k: F.when(k == 0, 0).otherwise(F.get(dropped, k - 1) + 1)
    stop = lambda k: F.coalesce(F.get(dropped, k), F.size(lines))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size(dropped)), lambda k: F.slice(lines, start(k) + 1, stop(k) - start(k))))
    return F.when(F.coalesce(F.size(dropped), F.lit(0)) <= 0, text).otherwise(F.array_join(kept, "\n"))
