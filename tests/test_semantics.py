"""Small documented semantics: tile centres, split errors, positional negative dropping."""

import pytest
from pyspark.sql import functions as F

from maskframe.operators import sampling as S
from maskframe.operators.tiles import tile_centers


def test_tile_centres_stride_128():
    assert tile_centers(512, 3) == [128, 256, 384]
    assert tile_centers(768, 5) == [128, 256, 384, 512, 640]
    assert tile_centers(1024, 7) == [128, 256, 384, 512, 640, 768, 896]


def test_split_fails_on_single_member_class(spark):
    df = spark.createDataFrame([(f"{i}.jpg", 0 if i < 20 else 1) for i in range(21)], "ImageId string, class int")
    with pytest.raises(Exception):
        S.stratified_split(df, 0.1, 1).collect()


def test_drop_first_negatives_takes_positives_when_short(spark):
    rows = [("a.jpg", 1), ("b.jpg", 1)] + [(f"p{i}.jpg", 0) for i in range(5)]
    df = spark.createDataFrame(rows, "ImageId string, isnan int")
    kept = S.drop_first_negatives(df, 4, seed=3)
    got = kept.collect()
    assert len(got) == 3 and all(r["isnan"] == 0 for r in got)  # both negatives and two positives dropped
