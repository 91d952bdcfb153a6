"""Connected components against a brute-force pixel flood fill (8-connectivity, raster-order numbering)."""

import numpy as np
from pyspark.sql import functions as F

from maskframe.operators import coverage as V
from maskframe.operators.components import label_pieces, label_pieces_batch, multi_rle


def flood(mask):
    h, w = mask.shape
    lab = np.zeros_like(mask, dtype=int)
    n = 0
    for r in range(h):  # raster order
        for c in range(w):
            if mask[r, c] and not lab[r, c]:
                n += 1
                stack = [(r, c)]
                lab[r, c] = n
                while stack:
                    y, x = stack.pop()
                    for dy in (-1, 0, 1):
                        for dx in (-1, 0, 1):
                            yy, xx = y + dy, x + dx
                            if 0 <= yy < h and 0 <= xx < w and mask[yy, xx] and not lab[yy, xx]:
                                lab[yy, xx] = n
                                stack.append((yy, xx))
    return lab


def pieces_of(mask):
    cols, r0s, r1s = [], [], []
    h, w = mask.shape
    for c in range(w):
        r = 0
        while r < h:
            if mask[r, c]:
                s = r
                while r < h and mask[r, c]:
                    r += 1
                cols.append(c); r0s.append(s); r1s.append(r)
            else:
                r += 1
    return np.array(cols), np.array(r0s), np.array(r1s)


def test_label_pieces_random_masks():
    rng = np.random.default_rng(7)
    for trial in range(60):
        h, w = rng.integers(3, 14, size=2)
        mask = rng.random((h, w)) < rng.uniform(0.2, 0.6)
        want = flood(mask)
        c, a, b, inst = label_pieces(*pieces_of(mask), int(h), int(w))
        got = np.zeros_like(want)
        for ci, ai, bi, k in zip(c, a, b, inst):
            got[ai:bi, ci] = k
        np.testing.assert_array_equal(got, want)


def test_label_pieces_batch_random_masks():
    rng = np.random.default_rng(9)
    for trial in range(60):
        h, w = (int(x) for x in rng.integers(3, 14, size=2))
        masks = [rng.random((h, w)) < rng.uniform(0.1, 0.7) for _ in range(4)]
        parts = [pieces_of(m) for m in masks]
        img = np.concatenate([np.full(len(p[0]), i) for i, p in enumerate(parts)]).astype(int)
        im, c, a, b, inst = label_pieces_batch(img, *(np.concatenate([p[k] for p in parts]).astype(int) for k in range(3)), h, w)
        for i, m in enumerate(masks):
            got = np.zeros((h, w), int)
            for x, y0, y1, k in zip(c[im == i], a[im == i], b[im == i], inst[im == i]):
                got[y0:y1, x] = k
            np.testing.assert_array_equal(got, flood(m))


def test_column_wrap_is_not_adjacent(spark):
    # "4 2" on a 4x4 canvas covers (3,0) and (0,1): same run, different components
    df = spark.createDataFrame([("a", "4 2")], "ImageId string, EncodedPixels string")
    seg = V.coverage_segments(df, 4, 4)
    out = multi_rle(V.select_mask(seg, F.col("c") >= 1), V.image_ids(df), 4, 4).collect()
    assert sorted(r["EncodedPixels"] for r in out) == ["4 1", "5 1"]


def test_diagonal_touch_and_empty(spark):
    df = spark.createDataFrame([("a", "1 1 6 1"), ("b", None)], "ImageId string, EncodedPixels string")
    seg = V.coverage_segments(df, 4, 4)
    out = {r["ImageId"]: r["EncodedPixels"] for r in multi_rle(V.select_mask(seg, F.col("c") >= 1), V.image_ids(df), 4, 4).collect()}
    assert out == {"a": "1 1 6 1", "b": None}


def test_batched_equals_grouped_on_fixture(spark):
    from maskframe.operators.components import multi_rle_grouped
    from maskframe.plans import fixtures as X

    ann = X.annotations(spark, "/root/testdata/sf0.001")
    pieces = V.select_mask(V.coverage_segments(ann), F.col("c") >= 1)
    ids = V.image_ids(ann)
    a = multi_rle(pieces, ids).select("ImageId", "EncodedPixels")
    b = multi_rle_grouped(pieces, ids).select("ImageId", "EncodedPixels")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() > 1500
