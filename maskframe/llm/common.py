"""Helpers shared by the operators: table access, written intermediate tables, order keys that never need one task per
group, and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from maskframe.operators.graph import connected_components
from maskframe.session import checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def ready(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Python workers can import this package."""
    ship_package(df.sparkSession)
    return df


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for ``name`` in this application's part of the folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/maskframe-{spark.sparkContext.applicationId}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder named by ``spark.checkpoint.dir``: later jobs read the
    table, whatever executors are lost. The folder is the application's own; it may be removed when that has ended."""
    spark = df.sparkSession
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """A column name like each of ``wanted`` that no column of ``taken`` has (Spark compares names without case)."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        new = f"_{name}"
        while new.lower() in used:
            new = f"_{new}"
        used.add(new.lower())
        out.append(new)
    return out


def same(a: DataFrame, b: DataFrame, cols: list[str]) -> Column:
    """Null-safe equality of ``cols`` of two frames."""
    out = F.lit(True)
    for c in cols:
        out = out & a[c].eqNullSafe(b[c])
    return out


def running(df: DataFrame, groups: list[str], order: list[str], value: Column, out: str, buckets: int = 1024) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same group that come before the row (from 0).

    The order is total and repeatable: hash bucket of ``order``, then ``order``. No group meets in one task: sums run
    inside ``(group, bucket)``, and a table of at most ``groups x buckets`` bucket sums shifts them. Null groups are a
    group like any other.
    """
    bucket, own, total, start, place, *copies = free_names([*df.columns, out], "bucket", "own", "total", "start", "place", *[f"key{i}" for i in range(len(groups) + 1)])
    keyed = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")).withColumn(own, value.cast("long"))
    keys = [*groups, bucket]
    sums = keyed.groupBy(*keys).agg(F.sum(own).alias(total))
    before = W.partitionBy(*groups).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(*[F.col(k).alias(c) for k, c in zip(keys, copies, strict=True)], F.coalesce(F.sum(total).over(before), F.lit(0)).alias(start))
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    ranked = keyed.withColumn(place, F.coalesce(F.sum(own).over(inside), F.lit(0)))
    on = F.lit(True)
    for k, c in zip(keys, copies, strict=True):
        on = on & F.col(k).eqNullSafe(F.col(c))
    return ranked.join(starts, on).withColumn(out, F.col(start) + F.col(place)).drop(bucket, own, place, start, *copies)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of the undirected ``edges``: one row (``node``, ``root``) per node that has a link to another
    one, ``root`` the smallest node that links reach (see ``maskframe.operators.graph``: hubs are met by broadcast of a
    bounded table, so that no task holds a neighbourhood)."""
    return connected_components(edges, a, b)
