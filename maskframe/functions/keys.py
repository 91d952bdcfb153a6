"""Deterministic order keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(seed, *parts) -> Column:
    """``md5(concat(seed, ':', part1[, ':', part2...]))`` as hex string; a total order once tied by id."""
    cols = [F.lit(str(seed))]
    for p in parts:
        cols += [F.lit(":"), (F.col(p) if isinstance(p, str) else p).cast("string")]
    return F.md5(F.concat(*cols))


def md5_unit(seed, *parts) -> Column:
    """A uniform draw in [0, 1) from the first 8 hex digits of ``md5_key`` (same value in SQL via ``conv``)."""
    h = F.substring(md5_key(seed, *parts), 1, 8)
    return F.conv(h, 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)
