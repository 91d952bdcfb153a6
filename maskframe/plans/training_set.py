"""Annotations -> balanced, augmented, sharded training records, as one lineage.

S1 -> P1 -> P2 -> R4 (null rows first, drop the first ``drop_n`` rows) -> P4 -> A1 -> P5 -> R1 (stratified validation
split) -> lists (validation: ships against empty images; training: R6 many-ship against few-ship) -> R2 (both
lists cut to the smaller) -> W3 (training: four variants of positive i then negative i; validation: positive i then
negative i) -> W2 (contiguous shards of ceil(pairs / shards) pairs).

Shuffles: the ranked drop (bucketed rank), the per-image rollup, the class counts of the split (tiny), the ranks of
the lists. The per-image split table is checkpointed (reliably, under ``spark.checkpoint.dir``) because five branches
read it. Image bytes are not carried through any of it; records are joined to images only at write time (S9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.functions import classes as C
from maskframe.functions.keys import md5_key
from maskframe.functions.names import sample_name
from maskframe.operators import annotations as A
from maskframe.operators import sampling as S
from maskframe.operators.ranking import bucket_rank
from maskframe.session import cut_lineage

# fixed values: augmentation suffixes in write order (original, rotated 180, rotated 90, flipped up-down)
VARIANTS = ("", "_a", "_b", "_f")


def ranked_rows(ann: DataFrame, seed) -> DataFrame:
    """O1: annotation rows ordered by the null flag (descending), then ``md5(seed:id:text)``; ``rn`` is 1-based."""
    a = A.with_area(A.null_flag(A.drop_blocked(ann)))
    key = F.concat((F.lit(1) - F.col("isnan")).cast("string"),
                   md5_key(seed, "ImageId", F.coalesce(F.col("EncodedPixels"), F.lit(""))))
    # the key stands for the text and the area is what is used of it: the text stays where it is
    thin = a.select("ImageId", "isnan", "area", "valid", key.alias("_key"))
    return bucket_rank(thin, "_key", ["ImageId"], prefix_len=4).drop("_key")


def sound_images(kept: DataFrame) -> DataFrame:
    """Images of the ranked rows with their area. An image with a broken text is left out as a whole
    (``annotations.usable_images`` reports its rows): it is not an image without ships."""
    img = kept.groupBy("ImageId").agg(F.sum(F.when(F.col("valid"), F.col("area"))).cast("bigint").alias("area"), F.min("valid").alias("_sound"))
    return img.filter("_sound").drop("_sound")


def images_of(kept: DataFrame, split_bins) -> DataFrame:
    """Images of the ranked rows with their area, class and the class that the split goes by."""
    img = sound_images(kept)
    return img.withColumn("class", C.area_class(F.col("area"), C.MAIN_BINS)).withColumn("sclass", C.area_class(F.col("area"), split_bins))


def _pairs_to_records(bal: DataFrame, split: str, per_pair: int, num_shards: int) -> DataFrame:
    m = bal.agg(F.max("rn").alias("_m"))
    spark = bal.sparkSession
    if per_pair == 5:
        v = spark.createDataFrame([(k, s) for k, s in enumerate(VARIANTS)], "k int, suffix string")
        pos = bal.filter(F.col("list") == "a").crossJoin(F.broadcast(v))
        pos = pos.select("rn", (F.col("k")).alias("k"), sample_name("ImageId", F.col("suffix")).alias("sample"))
        neg = bal.filter(F.col("list") == "b").select("rn", F.lit(4).alias("k"), sample_name("ImageId", "").alias("sample"))
    else:
        pos = bal.filter(F.col("list") == "a").select("rn", F.lit(0).alias("k"), sample_name("ImageId", "").alias("sample"))
        neg = bal.filter(F.col("list") == "b").select("rn", F.lit(1).alias("k"), sample_name("ImageId", "").alias("sample"))
    recs = pos.unionByName(neg).crossJoin(F.broadcast(m))
    per = F.ceil(F.col("_m") / F.lit(num_shards))
    return recs.select(
        F.lit(split).alias("split"),
        F.floor((F.col("rn") - 1) / per).cast("int").alias("shard_id"),
        ((F.col("rn") - 1) * per_pair + F.col("k")).cast("bigint").alias("seq"),
        "sample",
    )


def make_training_set(ann: DataFrame, seed, drop_n: int, val_frac: float = 0.01, num_shards: int = 4,
                      split_bins=C.MAIN_BINS[:4]) -> DataFrame:
    """Records ``(split, shard_id, seq, sample)``; ``seq`` is the write order inside the split."""
    kept = S.drop_first(ranked_rows(ann, seed), drop_n)
    img = images_of(kept, split_bins)
    sp = S.stratified_split(img.select("ImageId", "class", "sclass"), val_frac, seed, class_col="sclass")
    # one row per image, read by every list below: cut the lineage once (reliable checkpoint in the shared folder)
    # instead of re-running parse, rank and rollup for each branch
    sp = cut_lineage(sp.select("ImageId", "class", "split"), eager=False)
    val = sp.filter(F.col("split") == "val")
    train = sp.filter(F.col("split") == "train")
    val_bal = S.balance_pair(val.filter(F.col("class") > 0).select("ImageId"),
                             val.filter(F.col("class") == 0).select("ImageId"), seed)
    lists = S.ship_class_lists(train, seed)
    train_bal = S.balance_pair(lists.filter(F.col("list") == "lot").select("ImageId"),
                               lists.filter(F.col("list") == "few").select("ImageId"), seed)
    return _pairs_to_records(val_bal, "val", 2, num_shards).unionByName(
        _pairs_to_records(train_bal, "train", 5, num_shards))
