"""Pixel-wise evaluation and boxes as data against plain pixels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from maskframe.operators import pixel_eval as PE
from maskframe.operators import runs as R
from maskframe.operators import tiles as T

H, W = 24, 18


def text(mask):
    flat = np.flatnonzero(mask.T.ravel())
    return " ".join(f"{p + 1} 1" for p in flat) or None


def raster(enc):
    m = np.zeros(H * W, np.int64)
    t = (enc or "").split()
    for s, n in zip(t[::2], t[1::2]):
        m[int(s) - 1:int(s) - 1 + int(n)] = 1
    return m.reshape(W, H).T


def random_rows(rng, images, classes):
    rows = []
    for i in images:
        for _ in range(rng.integers(0, 5)):
            s = rng.integers(1, H * W, 6)
            rows.append((i, " ".join(f"{a} {rng.integers(1, 60)}" for a in s), int(rng.integers(1, classes))))
        rows.append((i, None, 1))
    return rows


def brute(truth, pred, classes, ignore):
    ids = {r[0] for r in truth} | {r[0] for r in pred}
    out = {}
    for i in ids:
        t, p = np.zeros((H, W), np.int64), np.zeros((H, W), np.int64)
        for r in truth:
            if r[0] == i:
                t += r[2] * raster(r[1])
        for r in pred:
            if r[0] == i:
                p = np.maximum(p, r[2] * raster(r[1]))
        ok = (t < classes) & (t != ignore)
        for a in range(classes):
            for b in range(classes):
                n = int(((t == a) & (p == b) & ok).sum())
                if n:
                    out[i, a, b] = n
    return out


@pytest.mark.parametrize("classes,ignore", [(2, 2), (3, None), (4, 2)])
def test_pairs_equal_pixels(spark, classes, ignore):
    rng = np.random.default_rng(classes)
    schema = "ImageId string, EncodedPixels string, value int"
    truth, pred = random_rows(rng, ["a", "b", "c", "d"], classes), random_rows(rng, ["b", "c", "d", "only"], classes)
    truth += [truth[0]] * 40  # one image repeated: labels far outside the classes
    how = dict(num_classes=classes, ignore_label=ignore, height=H, width=W, value_col="value")
    pairs = PE.pixel_pairs(spark.createDataFrame(truth, schema), spark.createDataFrame(pred, schema), **how)
    want = brute(truth, pred, classes, ignore)
    per = {(r["ImageId"], r["label"], r["pred"]): r["n"] for r in PE.pixel_confusion(pairs, by=["ImageId"]).collect()}
    assert per == want
    total = {(r["label"], r["pred"]): r["n"] for r in PE.pixel_confusion(pairs).collect()}
    assert total == {(a, b): sum(n for (_, x, y), n in want.items() if (x, y) == (a, b)) for _, a, b in want}
    iou = []
    for c in range(classes):
        tp, den = total.get((c, c), 0), sum(n for (a, b), n in total.items() if c in (a, b))
        iou += [tp / den] if den else []
    got = PE.pixel_mean_iou(spark.createDataFrame(truth, schema), spark.createDataFrame(pred, schema), **how).first()["miou"]
    assert abs(got - sum(iou) / len(iou)) < 1e-12


def test_broken_text_takes_its_image_out(spark):
    truth = spark.createDataFrame([("good", "1 5"), ("bad", "1 5"), ("bad", "1 x"), ("late", None)], "ImageId string, EncodedPixels string")
    pred = spark.createDataFrame([("good", "3 5"), ("bad", "1 5"), ("late", "7 y 9")], "ImageId string, EncodedPixels string")
    got = {(r["ImageId"], r["label"], r["pred"]): r["n"] for r in PE.pixel_confusion(PE.pixel_pairs(truth, pred, height=4, width=5), by=["ImageId"]).collect()}
    # "7 y 9": the third token has no partner, so "7 y" is used and is not valid
    assert got == {("good", 0, 0): 13, ("good", 0, 1): 2, ("good", 1, 0): 2, ("good", 1, 1): 3}
    none = truth.limit(0)
    assert PE.pixel_confusion(PE.pixel_pairs(none, none)).count() == 0
    full = spark.createDataFrame([("f", "1 20")], "ImageId string, EncodedPixels string")
    assert [tuple(r) for r in PE.pixel_confusion(PE.pixel_pairs(full, full, height=4, width=5)).collect()] == [(1, 1, 20)]


def test_one_sweep_no_second_read(spark):
    df = spark.createDataFrame([("a", "1 5")], "ImageId string, EncodedPixels string")
    plan = PE.pixel_confusion(PE.pixel_pairs(df, df))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 3


@pytest.mark.parametrize("bin_size", [4, 128])
def test_boxes_from_a_table(spark, bin_size):
    rng = np.random.default_rng(9)
    rows = random_rows(rng, ["a", "b", "c"], 3) * 2  # rows overlap and repeat: masses add up
    ann = spark.createDataFrame(rows, "ImageId string, EncodedPixels string, value int")
    boxes = [(i, n, int(x), int(y), int(x + w), int(y + h)) for n, (i, x, y, w, h) in enumerate(zip(rng.choice(["a", "b", "c", "none"], 80), rng.integers(-5, W, 80), rng.integers(-5, H, 80), rng.integers(0, 30, 80), rng.integers(0, 30, 80)))]
    boxes += [("a", 900, -1000, -1000, 5000, 5000), ("a", 901, 3, None, 9, 9), (None, 902, 0, 0, 9, 9), ("b", 903, 5, 5, 5, 9)]
    b = spark.createDataFrame(boxes, "ImageId string, box int, x0 int, y0 int, x1 int, y1 int")
    pieces = R.run_pieces(R.rle_runs(ann, H, W, keep=("value",)), H, keep=("value",))
    got = {(r["ImageId"], r["box"]): r["mask_area"] for r in T.box_overlap(pieces, b, bin_size, value_col="value").collect()}
    mass = {}
    for i, e, v in rows:
        mass[i] = mass.get(i, 0) + v * raster(e)
    want = {}
    for i, n, x0, y0, x1, y1 in boxes:
        if i in mass and None not in (x0, y0, x1, y1):
            a = int(mass[i][max(y0, 0):max(y1, 0), max(x0, 0):max(x1, 0)].sum())
            if a:
                want[i, n] = a
    assert got == want
    assert T.box_overlap(pieces, b.limit(0)).count() == T.box_overlap(pieces.limit(0), b).count() == 0
    plan = T.box_overlap(pieces, b)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_boxes_meet_texts(spark, batch):
    """The sums of boxes from texts: images in few and in many batches, painted ones, boxes that repeat, odd texts and nulls."""
    rng = np.random.default_rng(12)
    rows = [(i, e) for i, e, _ in random_rows(rng, ["a", "b", "c"], 3) * 2] + [("hot", e) for _, e, _ in random_rows(rng, ["x"], 60)] + [("b", None), ("c", "1 x"), (None, "1 9"), ("d", None), ("b", "9 4 2 3 1 9")]
    ann = spark.createDataFrame(rows, "ImageId string, EncodedPixels string").repartition(5)
    boxes = [(i, None if n == 7 else n % 40, int(x), int(y), int(x + w), int(y + h)) for n, (i, x, y, w, h) in enumerate(zip(rng.choice(["a", "b", "c", "hot", "none"], 150), rng.integers(-5, W, 150), rng.integers(-5, H, 150), rng.integers(0, 30, 150), rng.integers(0, 30, 150)))]
    boxes += [("a", 900, -1000, -1000, 5000, 5000), ("a", 901, 3, None, 9, 9), (None, 902, 0, 0, 9, 9), ("b", 903, 5, 5, 5, 9), ("hot", 904, 0, 0, 5000, 9), ("d", 905, 0, 0, 9, 9)]
    b = spark.createDataFrame(boxes, "ImageId string, box int, x0 long, y0 long, x1 long, y1 long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = T.box_masses(ann, b, H, W)
        want = T.box_overlap(R.run_pieces(R.rle_runs(ann, H, W), H), b)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got.schema.simpleString() == want.schema.simpleString()
        assert T.box_masses(ann, b.limit(0), H, W).count() == T.box_masses(ann.limit(0), b, H, W).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_boxes_shuffle_no_piece(spark):
    """A row that is shuffled is an image's packed runs or a box."""
    plan = E.queries()["box_overlap"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_tiles_are_boxes(spark):
    """The fixed grids of the tiled build are a special case."""
    ann = spark.createDataFrame([("a", "1 700 60000 900 200000 50"), ("b", None)], "ImageId string, EncodedPixels string")
    pieces = R.run_pieces(R.rle_runs(ann))
    grid = T.tile_grid(spark, 768, 5).select(F.lit("a").alias("ImageId"), F.col("tile").alias("box"), "x0", "y0", "x1", "y1")
    a = {(r[0], r[1]): r[2] for r in T.box_overlap(pieces, grid).collect()}
    assert a == {(r["ImageId"], r["tile"]): r["mask_area"] for r in T.tile_overlap(pieces, 768, 5, value_col=None).collect()}
