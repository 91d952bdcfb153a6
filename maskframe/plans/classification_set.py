"""Composition: annotations -> records of the classification training set.

Annotation rows ordered by the null flag lose their first ``drop_n`` rows; images are binned by area share (0 empty, 1 large
enough, 2 too small to be used); a stratified share goes to validation; in each split class 1 is paired with an equal sample
of class 0 (both are cut to the smaller one), and pairs are dealt to the shards in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.functions import classes as C
from maskframe.operators import sampling as S
from maskframe.plans.training_set import ranked_rows, sound_images
from maskframe.session import cut_lineage


def make_classification_set(ann: DataFrame, seed, drop_n: int, val_frac: float = 0.05, num_shards: int = 2) -> DataFrame:
    """Records ``(split, shard_id, seq, ImageId, label)``; ``seq`` is the write order inside the split (image with a ship,
    image without, and so on)."""
    kept = S.drop_first(ranked_rows(ann, seed), drop_n)
    img = sound_images(kept).select("ImageId", C.pretrain_class(F.col("area")).alias("class"))
    sp = cut_lineage(S.stratified_split(img, val_frac, seed), eager=False)
    out = None
    for split in ("train", "val"):
        own = sp.filter(F.col("split") == split)
        pairs = S.balance_pair(own.filter("class = 1").select("ImageId"), own.filter("class = 0").select("ImageId"), seed)
        most = pairs.agg(F.max("rn").alias("_m"))
        ship = F.col("list") == "a"
        recs = pairs.crossJoin(F.broadcast(most)).select(
            F.lit(split).alias("split"),
            F.floor((F.col("rn") - 1) / F.ceil(F.col("_m") / F.lit(num_shards))).cast("int").alias("shard_id"),
            ((F.col("rn") - 1) * 2 + F.when(ship, 0).otherwise(1)).cast("bigint").alias("seq"),
            "ImageId", F.when(ship, 1).otherwise(0).alias("label"))
        out = recs if out is None else out.unionByName(recs)
    return out
