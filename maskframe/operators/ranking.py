"""Exact global ranks without a one-task window (SURVEY 4 "Global rank", 7.2-2).

``row_number() over (partition by g order by key)`` on a large table with few groups puts a whole group in one
task. Instead, when the leading part of the order is a uniformly distributed hex key (an md5), rows are ranked inside
``(g, key prefix)`` buckets and shifted by the number of rows in earlier buckets of the same group, taken from a count
table of at most ``groups x 16**prefix_len`` rows. Nothing is forced into a broadcast: Spark compares that table's size
with its own threshold and merges sorted sides beyond it. Null groups and null keys are values like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach(df: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the columns of ``side`` (one row per value of ``keys``), null keys matching null keys."""
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    right = side.select(*[F.col(k).alias(names[k]) if k in names else F.col(k) for k in side.columns])
    on = F.lit(True)
    for k, n in names.items():
        on = on & F.col(k).eqNullSafe(F.col(n))
    return df.join(right, on).drop(*names.values())


def bucket_rank(
    df: DataFrame,
    key: Column | str,
    tiebreak: Sequence[str],
    groups: Sequence[str] = (),
    prefix_len: int = 3,
    out: str = "rn",
) -> DataFrame:
    """Add ``out`` = 1-based ``row_number() over (partition by groups order by key, *tiebreak)``; every row keeps its
    place, rows with a null key come first.

    ``key`` must be a string whose first ``prefix_len`` characters order the buckets (an md5 hex digest, optionally
    behind a fixed-width leading flag)."""
    k = F.col(key) if isinstance(key, str) else key
    g = list(groups)
    x = df.withColumn("_rk", k).withColumn("_bk", F.substring("_rk", 1, prefix_len))
    counts = x.groupBy(*g, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    wo = Window.partitionBy(*g).orderBy("_bk") if g else Window.orderBy("_bk")
    offsets = counts.select(
        *g, "_bk",
        F.coalesce(F.sum("_n").over(wo.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
    )
    w = Window.partitionBy(*g, "_bk").orderBy("_rk", *tiebreak)
    j = attach(x.withColumn("_in", F.row_number().over(w)), offsets, [*g, "_bk"])
    return j.withColumn(out, (F.col("_off") + F.col("_in")).cast("bigint")).drop("_rk", "_bk", "_off", "_in")


def group_counts(df: DataFrame, groups: Sequence[str], out: str = "n") -> DataFrame:
    """Tiny per-group count table (partial aggregation, then one row per group)."""
    return df.groupBy(*groups).agg(F.count(F.lit(1)).cast("bigint").alias(out))
