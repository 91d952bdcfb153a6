"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every record draws one pseudorandom number per shard from (key, shard); the shard with the best weighted draw wins. The
draws of the old shards do not change when a shard is added, so records only ever move *into* the new shard, and removing
one moves only its own records.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskframe.llm.common import running


def rendezvous(keys: list[str], weights: Mapping[int, float]) -> Column:
    """The shard of a record: the smallest ``-ln(u) / weight`` over the shards, ``u`` uniform in (0, 1) from a 64-bit hash
    of the keys and the shard number; ties go to the smaller shard. Shards of weight 0 or less take nothing. Null keys are
    a key like any other (all records whose keys are null share a shard)."""
    live = {int(s): float(w) for s, w in weights.items() if w > 0}
    if not live:
        raise ValueError("no shard has a positive weight")
    draws = []
    for s, w in sorted(live.items()):
        u = (F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys], F.lit(s)), 11) + F.lit(0.5)) / F.lit(float(2**53))
        draws.append(F.struct((-F.log(u) / F.lit(w)).alias("d"), F.lit(s).alias("s")))
    return (F.array_min(F.array(*draws)) if len(draws) > 1 else draws[0])["s"].cast("int")


def assign(df: DataFrame, keys: list[str], weights: Mapping[int, float], out: str = "shard") -> DataFrame:
    """``df`` with the shard of every row. Rows that repeat a key go to the same shard; null, empty or extra columns do
    not matter; an empty table stays empty. No shuffle."""
    return df.withColumn(out, rendezvous(keys, weights))


def with_slots(df: DataFrame, keys: list[str], ties: list[str], shard: str = "shard", out: str = "slot") -> DataFrame:
    """Adds the row's place in its shard, gapless from 0, in an order fixed by ``keys`` and ``ties`` (rows equal in both
    are interchangeable). A shard is numbered by many tasks."""
    return running(df, [shard], [*keys, *ties], F.lit(1), out)


def write_shards(df: DataFrame, keys: list[str], weights: Mapping[int, float], path: str, files: int = 16) -> None:
    """Writes one folder ``shard=N`` per shard, each by ``files`` tasks."""
    placed = assign(df, keys, weights, "shard")
    placed.repartition("shard", F.pmod(F.xxhash64(*keys), F.lit(files))).write.partitionBy("shard").parquet(path)


def moved(df: DataFrame, keys: list[str], before: Mapping[int, float], after: Mapping[int, float]) -> DataFrame:
    """Rows by (old shard, new shard): what a change of the shard table moves."""
    return df.select(rendezvous(keys, before).alias("old_shard"), rendezvous(keys, after).alias("new_shard")).groupBy("old_shard", "new_shard").count()
