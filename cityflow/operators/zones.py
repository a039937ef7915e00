"""Either-endpoint membership: a row belongs to every distinct series (borough)
that either of its endpoints maps to, once per series.

Replaces one filtered pass per borough (``pu in list or do in list``) with
one lookup join per endpoint and an explode; the fan-out write then becomes a
single partitioned write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assign_zones(df: DataFrame, lookup: DataFrame, endpoint_cols, out: str = "borough",
                 zone_col: str = "zone_id", label_col: str = "borough", drop_endpoints: bool = False) -> DataFrame:
    """One output row per (input row, distinct mapped label); unmapped -> no row.

    A zone may have several labels. The lookup becomes one row per zone with
    its label set, joined once per endpoint; the planner broadcasts it only
    when its measured size allows.
    """
    endpoint_cols = list(endpoint_cols)
    zones = lookup.where(F.col(zone_col).isNotNull()).groupBy(F.col(zone_col).alias("_zone")).agg(
        F.collect_set(label_col).alias("_labels"))
    none = F.array().cast("array<string>")
    sets = []
    for i, e in enumerate(endpoint_cols):
        side = zones.select(F.col("_zone").alias(f"_zone_{i}"), F.col("_labels").cast("array<string>").alias(f"_labels_{i}"))
        df = df.join(side, F.col(e) == F.col(f"_zone_{i}"), "left").drop(f"_zone_{i}")
        sets.append(F.coalesce(F.col(f"_labels_{i}"), none))
    out_df = df.withColumn(out, F.explode(F.array_distinct(F.flatten(F.array(*sets))))).drop(*[f"_labels_{i}" for i in range(len(sets))])
    return out_df.drop(*endpoint_cols) if drop_endpoints else out_df


def zone_table(spark, mapping: dict, zone_col: str = "zone_id", label_col: str = "borough") -> DataFrame:
    """Lookup DataFrame from ``{label: [zone ids]}`` supplied by the caller."""
    rows = [(int(z), label) for label, ids in mapping.items() for z in ids]
    return spark.createDataFrame(rows, f"{zone_col} int, {label_col} string")
