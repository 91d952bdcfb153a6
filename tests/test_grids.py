"""Images with one and three channels against NumPy, row preservation of ranks, and the multi-view scorer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskframe.operators import grids as G
from maskframe.operators import model as ML
from maskframe.operators import sampling as S
from maskframe.operators.ranking import bucket_rank


def images(spark, shapes, extra=()):
    rng = np.random.default_rng(5)
    arrays = [rng.integers(0, 256, s).astype(float) for s in shapes]
    rows = [(i, *a.shape, a.ravel().tolist(), a[:, :, 0].ravel().tolist()) for i, a in enumerate(arrays)]
    return arrays, spark.createDataFrame([*rows, *extra], "image_id long, h int, w int, c int, data array<double>, label_data array<double>")


def back(df, c=None):
    return {r["image_id"]: np.array(r["data"]).reshape(r["h"], r["w"], -1) for r in df.collect() if r["data"] is not None}


def test_channels_stay_together(spark):
    arrays, d = images(spark, [(2, 2, 3), (3, 4, 1)], extra=[(9, 2, 2, 1, None, None)])
    flipped = back(G.flip(d, 1, prob=1.0))
    assert all(np.array_equal(flipped[i], a[:, ::-1]) for i, a in enumerate(arrays))
    assert G.flip(d, 1).count() == 3
    cut = back(G.crop(d, 1, 0, 1, 2))
    assert all(np.array_equal(cut[i], a[1:2, :2]) for i, a in enumerate(arrays))
    pooled = {r["image_id"]: r["pooled"] for r in G.global_pool(d).collect()}
    assert all(np.allclose(pooled[i], a.mean((0, 1))) for i, a in enumerate(arrays))
    with pytest.raises(Exception, match="larger than image"):
        G.crop(d, 0, 0, 3, 3).collect()


def test_image_and_label_share_window_and_size(spark):
    arrays, d = images(spark, [(6, 7, 3), (5, 5, 3)])
    got = G.random_crop(d, 3, 4, 4, label="label_data").collect()
    for r in got:
        assert np.array_equal(np.array(r["data"]).reshape(4, 4, 3)[:, :, 0].ravel(), r["label_data"])
    with pytest.raises(Exception, match="differ in size"):
        G.random_crop(d.withColumn("label_data", F.slice("label_data", 1, 3)), 3, 4, 4, label="label_data").collect()


def test_evaluation_pads_and_resizes_to_the_crop(spark):
    arrays, d = images(spark, [(3, 3, 3), (9, 5, 3)])
    out = G.preprocess(d, 1, 5, 5, is_training=False, variant="resnet_v1_50").collect()
    small = np.array(next(r for r in out if r["image_id"] == 0)["data"]).reshape(5, 5, 3)
    assert np.array_equal(small[:3, :3], arrays[0]) and np.allclose(small[4, 4], G.MEAN_RGB)
    tall = np.array(next(r for r in out if r["image_id"] == 1)["data"]).reshape(5, 5, 3)
    assert np.allclose(tall, arrays[1][::2])


def test_resize_to_range_and_sizes(spark):
    arrays, d = images(spark, [(8, 6, 3), (4, 12, 1)])
    for r in G.resize_to_range(d, 12, 21, 4, label="label_data").collect():
        assert (r["h"] - 1) % 4 == (r["w"] - 1) % 4 == 0 and len(r["data"]) == r["h"] * r["w"] * r["c"]
        assert len(r["label_data"]) == r["h"] * r["w"] and set(r["label_data"]) <= set(arrays[r["image_id"]][:, :, 0].ravel())


def test_variants():
    assert G.mean_pixel("resnet_v1_101") == G.mean_pixel(None) == G.MEAN_RGB
    assert G.mean_pixel("xception_65") == (127.5,) * 3 and len(G.VARIANT_INPUT) == 8
    with pytest.raises(ValueError):
        G.input_kind("other")


def test_views_there_and_back(spark):
    y, x = np.mgrid[0:8, 0:8]
    a = np.stack([y + x, 2.0 * y - x, 0 * x + 3.0], axis=2)  # planes survive bilinear sampling
    d = spark.createDataFrame([(1, 8, 8, 3, a.ravel().tolist())], "image_id long, h int, w int, c int, data array<double>")
    v = G.cross_views(d)
    assert v.count() == 9
    for r in G.views_back(v).collect():
        assert np.allclose(np.array(r["data"]).reshape(8, 8, 3), a)


def test_multi_view_masks(spark):
    rng = np.random.default_rng(1)
    a = np.kron(rng.integers(0, 2, (4, 4)) * 200.0, np.ones((6, 6)))[:, :, None]
    d = spark.createDataFrame([(1, 24, 24, 1, a.ravel().tolist())], "image_id long, h int, w int, c int, data array<double>")
    one = np.array(ML.score_masks(d).first()["data"]).reshape(24, 24)
    many = np.array(ML.multi_view_masks(d).first()["data"]).reshape(24, 24)
    assert np.array_equal(one, a[:, :, 0] > 128) and (one == many).mean() > 0.9
    model, total = ML.BrightPixels(), 0
    for s in G.EVAL_SCALES:
        small = G.bilinear(a, int(24 * s), int(24 * s))
        for turn in (lambda z: z, np.fliplr, np.flipud):
            z = G.bilinear(np.ascontiguousarray(turn(model(turn(small)))), 24, 24)
            total = total + 1 / (1 + np.exp(z[:, :, 0] - z[:, :, 1]))
    assert np.array_equal(many, total / 9 > 0.5)


def test_null_keys_keep_their_rows(spark):
    rows = [(f"{i}.jpg" if i % 5 else None, i % 3 if i % 4 else None, i) for i in range(60)]
    d = spark.createDataFrame(rows, "ImageId string, class int, n int")
    assert S.shuffled(d, 1).count() == 60
    assert sorted(r["rn"] for r in S.shuffled(d, 1).collect()) == list(range(1, 61))
    split = S.stratified_split(d, 0.2, 1)
    assert split.count() == 60 and split.filter("split = 'val'").count() == 12
    g = bucket_rank(d, S.shuffle_key(1), ["n"], groups=["class"]).collect()
    for c in (None, 0, 1, 2):
        own = sorted(r["rn"] for r in g if r["class"] == c)
        assert own == list(range(1, len(own) + 1))
    assert S.sample_n(d, 5, 1, groups=["class"]).count() == 20
    assert S.shard_assign(S.shuffled(d, 1), 4).count() == 60


def test_drop_first_negatives_beyond_the_flagged(spark):
    rows = [(f"{i}.jpg", None if i < 10 else "1 2", int(i < 10)) for i in range(40)]
    d = spark.createDataFrame(rows, "ImageId string, EncodedPixels string, isnan int")
    assert S.drop_first_negatives(d, 4, 1).filter("isnan = 1").count() == 6 and S.drop_first_negatives(d, 4, 1).count() == 36
    left = {r["ImageId"] for r in S.drop_first_negatives(d, 17, 1).collect()}
    rank = {r["ImageId"]: r["rn"] for r in S.nulls_first_rank(d, 1).collect()}
    assert left == {k for k, v in rank.items() if v > 17}


def test_resize_to_range_by_layer(spark):
    """A label of several layers, stored one after the other, is resized layer by layer; none is an empty label."""
    rng = np.random.default_rng(8)
    rows = []
    for i, (h, w, k) in enumerate([(4, 6, 3), (9, 5, 1), (3, 3, 0), (2, 7, 5)]):
        rows.append((i, h, w, 1, rng.random(h * w).tolist(), rng.integers(0, 9, k * h * w).astype(float).tolist(), k))
    df = spark.createDataFrame(rows, "image_id long, h int, w int, c int, data array<double>, label_data array<double>, k int")
    out = {r["image_id"]: r for r in G.resize_to_range(df, 8, 20, None, "label_data", "k").collect()}
    for i, h, w, _, _, label, k in rows:
        r = out[i]
        assert len(r["data"]) == r["h"] * r["w"] and (min(r["h"], r["w"]) == 8 or max(r["h"], r["w"]) == 20)
        got = np.array(r["label_data"]).reshape(k, r["h"], r["w"])
        for own, layer in zip(got, np.array(label).reshape(k, h, w), strict=True):
            at = lambda n, m: [int(np.floor(j * (n - 1) / (m - 1) + 0.5 + 1e-9)) for j in range(m)]
            assert own.tolist() == layer[np.ix_(at(h, r["h"]), at(w, r["w"]))].tolist()
