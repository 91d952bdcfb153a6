"""Whole masks in one pass: the same results as by pieces, from one sweep that shuffles nothing behind it."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from maskframe.functions import rle_batch as B
from maskframe.operators import components as K
from maskframe.operators import coverage as V
from maskframe.operators import runs as R
from maskframe.operators import tiles as T
from maskframe.plans import fixtures as X
from maskframe.plans.ensemble import ensemble

H, W = 7, 9
SCHEMA = "ImageId string, EncodedPixels string"


def source(spark, seed, n=120):
    r = random.Random(seed)

    def text():
        kind = r.random()
        if kind < 0.25:
            return r.choice([None, "", "1 x", "0 1", " 3  2 ", "5 2 9"])
        return " ".join(f"{r.randint(1, H * W)} {r.randint(1, 9)}" for _ in range(r.randint(1, 4)))

    rows = [(r.choice([None, "empty", *"abcdefgh"]), text()) for _ in range(n)]
    return spark.createDataFrame([(i, None if i == "empty" else t) for i, t in rows], SCHEMA).repartition(5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def two(spark):
    return source(spark, 1), source(spark, 2)


def union(df):
    return V.packed_masks(df, lambda c, by: c >= 1, H, W)


def pieces(df):
    return V.select_mask(V.coverage_segments(df, H, W), F.col("c") >= 1)


def test_encoding_selection_and_components_as_by_pieces(spark, two):
    a, b = two
    ids = V.image_ids(a)
    assert rows(V.encode_masks(union(a))) == rows(V.encode_pieces(pieces(a), H, ids=ids))
    assert rows(V.encode_masks(R.flipped_masks(union(a), H, W))) == rows(V.encode_pieces(R.flip_updown(pieces(a), H), H, ids=ids))
    for t in (4, 7, 13):
        small = T.resize_nearest_pieces(pieces(a), t, H, W)
        assert rows(V.encode_masks(T.resized_masks(union(a), t, H, W))) == rows(V.encode_pieces(small, t, ids=ids))
    assert rows(K.multi_rle_masks(union(a), H, W)) == rows(K.multi_rle(pieces(a), ids, H, W).select("ImageId", "instance_id", "EncodedPixels"))
    assert rows(K.instances_of_masks(union(a), H, W)) == rows(K.instances_per_image(pieces(a), ids, H, W))
    seg, both = V.coverage_segments([a, b], H, W), V.ids_of([a, b], "ImageId")
    for op, keep in (("union", "c > 0"), ("intersect", "c0 > 0 AND c1 > 0"), ("difference", "c0 > 0 AND c1 = 0")):
        assert rows(V.mask_setop(a, b, op, H, W)) == rows(V.mask_per_image(seg, F.expr(keep), both, H))
    assert rows(V.vote([a, b], 2, H, W)) == rows(V.mask_per_image(seg, F.col("c") >= 2, both, H))
    assert rows(ensemble([a, b], 2, H, W)) == rows(K.multi_rle(V.select_mask(seg, F.col("c") >= 2), both, H, W).select("ImageId", "EncodedPixels"))


def test_turned_masks_as_by_pieces(spark, two):
    for df, centre in ((two[0], (4, 3)), (two[1], (2, 5))):
        want = V.encode_pieces(R.rotate_90(pieces(df), H, W, centre=centre), H, ids=V.image_ids(df))
        assert rows(V.encode_masks(R.rotated_masks(union(df), H, W, centre=centre))) == rows(want)
    plan = E.queries()["rotate_90"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the bridge's narrow columns, nothing behind the sweep


def test_pixel_sums_are_the_pixels_added_up(spark, two):
    long = spark.createDataFrame([("long", "1 200000 300000 70000"), ("long", "1 589824"), ("z", "0 2"), ("z", "589820 900")], SCHEMA)
    for df, h, w in ((two[0], H, W), (two[1], H, W), (long, 768, 768), (two[0].limit(0), H, W)):
        px = R.rle_pixels(R.rle_runs(df, h, w), h)
        want = px.groupBy("ImageId").agg(F.count("*").alias("pixels"), F.sum("row").alias("sum_row"), F.sum("col").alias("sum_col"))
        assert rows(R.rle_pixel_sums(df, h, w)) == rows(want)
    plan = E.queries()["rle_pixels"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_pixel_counts_are_the_segments_added_up(spark, two, monkeypatch):
    seg = V._segments(list(two), H, W, "ImageId")
    keys = ["ImageId", "c", "c0", "c1"]
    want = rows(seg.groupBy(*keys).agg(F.sum(F.col("r1") - F.col("r0"))))
    assert rows(V.pixel_counts(two, H, W).groupBy(*keys).agg(F.sum("pixels"))) == want
    assert rows(V.coverage_histogram(V.pixel_counts(two, H, W))) == rows(V.coverage_histogram(V.coverage_segments(two, H, W)))
    many = spark.createDataFrame([("a", "1 2")] * 3000 + [("b", "2 3")] * 1200 + [("c", None)], SCHEMA).coalesce(1)  # counts beyond a table of all
    want = rows(V._segments([many, many, many], H, W, "ImageId").groupBy(*keys, "c2").agg(F.sum(F.col("r1") - F.col("r0"))))
    assert rows(V.pixel_counts([many] * 3, H, W).groupBy(*keys, "c2").agg(F.sum("pixels"))) == want


def test_an_empty_table_gives_no_image(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert V.encode_masks(union(none)).collect() == [] and V.pixel_counts(none, H, W).collect() == []


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_masks_and_texts_are_not_shuffled_behind_the_sweep(spark, two):
    a, b = (x.repartition(6, "ImageId") for x in two)
    assert exchanges(V.encode_masks(union(a))) == 1
    assert exchanges(V.vote([a, b], 2, H, W)) == 2
    assert exchanges(V.mask_setop(a, b, "intersect", H, W)) == 2
    assert exchanges(ensemble([a, b], 2, H, W)) == 2
    assert exchanges(K.instances_of_masks(union(a), H, W)) == 1


def test_rectangle_texts_without_lambdas(spark):
    some = [(x, y, w, h) for x in (None, -700, 0, 5, 718, 767, 768) for y in (None, -3, 0, 99) for w in (None, -2, 0, 1, 2, 50) for h in (None, -1, 0, 7)]
    df = spark.createDataFrame(some, "x0 long, y0 long, w long, h long")
    cols = [F.col(c) for c in ("x0", "y0", "w", "h")]
    for last in (768, 6):
        both = df.select(X.rect_rle(*cols, max_col=last).alias("a"), X.rect_rle_columns(*cols, max_col=last).alias("b"))
        assert all(a == b for a, b in both.collect())
    assert not df.select(X.rect_rle(*cols).alias("t")).schema["t"].nullable  # so a test for null builds no text


def test_tokens_of_all_lengths():
    texts = ["7", "12345678 123456789", "000000000012 999999999999", "", "1234567890123 4", "5\t6\n7", "8x 9", "42"]
    counts, values, plain = B.tokens(B._plain(pa.array([None, *texts])))
    assert counts.tolist() == [0, 1, 2, 2, 0, 0, 3, 0, 1] and plain.tolist() == [True, True, True, True, True, False, True, False, True]
    assert values.tolist() == [7, 12345678, 123456789, 12, 999999999999, 5, 6, 7, 42]
    r = random.Random(3)
    nums = [[r.randrange(10 ** r.randint(1, 12)) for _ in range(r.randint(0, 9))] for _ in range(500)]
    _, values, _ = B.tokens(B._plain(pa.array([" ".join(map(str, x)) for x in nums])))
    assert np.array_equal(values, [x for row in nums for x in row])
