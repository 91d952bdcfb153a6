"""Split / sample invariants: quotas exact, no leakage, same answer under any partitioning."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from maskframe.operators import sampling as S
from maskframe.operators.ranking import bucket_rank


def test_bucket_rank_equals_row_number(spark):
    df = spark.range(5000).select(F.concat(F.col("id").cast("string"), F.lit(".jpg")).alias("ImageId"),
                                  (F.col("id") % 3).alias("g"))
    key = S.shuffle_key(42)
    a = bucket_rank(df, key, ["ImageId"], groups=["g"], prefix_len=2)
    b = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy(key, "ImageId")))
    j = a.join(b, ["ImageId", "g"])
    assert j.filter(F.col("rn") != F.col("rn2")).count() == 0
    assert j.count() == 5000


def test_stratified_split_quota_and_partition_invariance(spark):
    base = spark.range(2000).select(F.concat(F.col("id").cast("string"), F.lit(".jpg")).alias("ImageId"),
                                    (F.col("id") % 4).cast("int").alias("class"))
    outs = []
    for n in (1, 4, 17):
        s = S.stratified_split(base.repartition(n), 0.05, 42)
        outs.append(sorted((r["ImageId"], r["split"]) for r in s.collect()))
    assert outs[0] == outs[1] == outs[2]
    val = [i for i, sp in outs[0] if sp == "val"]
    assert len(val) == 100


def test_sample_n_too_large_fails(spark):
    import pytest

    ids = spark.range(10).select(F.col("id").cast("string").alias("ImageId"))
    with pytest.raises(Exception):
        S.sample_n(ids, 11, 1).collect()
    assert S.sample_n(ids, 4, 1).count() == 4


def test_leakage_empty_after_anti(spark):
    rows = spark.createDataFrame([("a", "1 1"), ("a", "2 1"), ("b", "1 1"), ("c", None)], "ImageId string, EncodedPixels string")
    val_ids = spark.createDataFrame([("a",)], "ImageId string")
    val = S.semi(rows, val_ids)
    train = S.anti(rows, val)
    assert S.split_leakage(train, val).count() == 0
    assert val.count() == 2 and train.count() == 2
