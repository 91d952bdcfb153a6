"""Sample and shard names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_name(image_id, suffix) -> Column:
    """Strip the 4-character extension and append a suffix (``_a``, ``_b``, ``_f``, ``_5``, ``_4_<tile>``)."""
    i = F.col(image_id) if isinstance(image_id, str) else image_id
    s = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(i.substr(F.lit(1), F.length(i) - 4), s)


def shard_name(split, shard_id, num_shards) -> Column:
    """``%s-%05d-of-%05d``."""
    sp = F.col(split) if isinstance(split, str) else split
    sh = F.col(shard_id) if isinstance(shard_id, str) else shard_id
    n = F.lit(num_shards) if isinstance(num_shards, int) else num_shards
    return F.format_string("%s-%05d-of-%05d", sp, sh, n)
