"""The tiled build on a small table against plain pixels, its shards, and builds from tables with broken texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskframe.functions.rle import rle_valid
from maskframe.operators import annotations as A
from maskframe.operators import grids as G
from maskframe.operators import runs as R
from maskframe.plans import tiled_set as TS
from maskframe.plans.classification_set import make_classification_set
from maskframe.plans.training_set import make_training_set

ANN = "ImageId string, EncodedPixels string"


def rect(x0, y0, w, h):
    return " ".join(f"{(x0 + i) * 768 + y0 + 1} {h}" for i in range(w))


def table(n=160):
    rng = np.random.default_rng(12)
    rows = []
    for k in range(n):
        if k % 4 == 0:
            rows.append((f"{k:04d}.jpg", None))
        for _ in range(int(rng.integers(1, 4)) if k % 4 else 0):
            w, h = int(rng.integers(1, 120)), int(rng.integers(1, 120))
            rows.append((f"{k:04d}.jpg", rect(int(rng.integers(0, 768 - w)), int(rng.integers(0, 768 - h)), w, h)))
    return rows


def raster(texts):
    m = np.zeros(768 * 768, np.int64)
    for t in texts:
        p = t.split()
        for s, n in zip(p[::2], p[1::2]):
            m[int(s) - 1:int(s) - 1 + int(n)] += 1
    return m.reshape(768, 768).T


def test_tiles_of_three_canvases_equal_pixels(spark):
    rows = table(24)
    got = {(r["ImageId"], r["cohort"], r["tile"]): r["mask_area"] for r in TS.canvas_tiles(R.run_pieces(R.rle_runs(spark.createDataFrame(rows, ANN)))).collect()}
    want = {}
    for i in {r[0] for r in rows}:
        m = raster([e for x, e in rows if x == i and e])
        for cohort, t, n, _, _ in TS.CANVASES:
            at = np.arange(t) * 768 // t
            small = m[np.ix_(at, at)]
            for iy in range(n):
                for ix in range(n):
                    v = int(small[128 * iy:128 * iy + 256, 128 * ix:128 * ix + 256].sum())
                    if v:
                        want[i, cohort, iy * n + ix] = v
    assert got == want


@pytest.mark.parametrize("batch", ["10000", "2"])
def test_fullest_tiles_are_chosen_where_they_are_measured(spark, batch):
    rows = table(40) + [("0001.jpg", "1 x"), (None, rect(5, 5, 90, 90)), ("0002.jpg", rect(100, 100, 60, 60))] + [("hot.jpg", rect(8 * k, 9 * k, 40, 30)) for k in range(60)]
    df = spark.createDataFrame(rows, ANN).repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        for least in (64, 2000):
            want = TS.tile_names(TS.annotated_tiles(df), min_area=least)
            assert sorted(map(str, TS.fullest_tiles(df, min_area=least).collect())) == sorted(map(str, want.collect()))
        assert TS.fullest_tiles(df.limit(0)).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sound_texts_in_batches(spark):
    texts = [None, "", "  ", "1 3", "1 x", "1 3 x", "7", "x", "1 5000 x 4", "1\t3\n9 2", "1 1234567890123456789", "1 99999999999999999999", "99999999999999999999 1", "1 \u0663", " 4 4 "]
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], ANN)
    out = A.sound_texts(df).withColumn("want", rle_valid(F.col("EncodedPixels")))
    assert all(r["_sound"] == r["want"] for r in out.collect())
    assert "ArrowEvalPython" in A.usable_images(df)[1].select("reason")._jdf.queryExecution().executedPlan().toString()


def test_build_is_whole_and_sound(spark, tmp_path):
    rows = table()
    rows += [("broken.jpg", "x 3"), ("broken.jpg", rect(5, 5, 90, 90)), ("broken2.jpg", "1 5000 x 4")]
    rec = TS.make_tiled_set(spark.createDataFrame(rows, ANN).repartition(6), 7, last_negatives=20)
    out = rec.collect()
    samples = [(r["split"], r["sample"]) for r in out]
    assert len(set(samples)) == len(samples) and not any("broken" in r["ImageId"] for r in out)
    images = {s: {r["ImageId"] for r in out if r["split"] == s} for s in TS.SHARDS}
    assert images["val"] and not images["val"] & (images["train"] | images["train-5"] | images["train-1"])
    empty = {i for i, e in rows if e is None}
    assert images["train-1"] <= empty and len(images["train-1"]) == 20
    areas = {}
    for i, e in rows:
        if e and "broken" not in i:
            areas.setdefault(i, []).append(sum(map(int, e.split()[1::2])) / 768**2)
    train = set(areas) - images["val"]
    assert images["train-5"] == {i for i in train if max(areas[i]) >= 0.001}
    tiles = {c[4]: {r["ImageId"] for r in out if r["split"] == "train" and c[4] in r["sample"]} for c in TS.CANVASES}
    assert tiles["_4_"] <= {i for i in train if max(areas[i]) >= 0.0002} and tiles["_3_"] and tiles["_2_"]
    for s, k in TS.SHARDS.items():
        own = sorted((r["seq"], r["shard_id"]) for r in out if r["split"] == s)
        per = -(-len(own) // k) if s != "val" else 2 * -(-(len(own) // 2) // k)
        assert [q for q, _ in own] == list(range(len(own))) and [x for _, x in own] == [q // per for q, _ in own]
    again = TS.make_tiled_set(spark.createDataFrame(rows[::-1], ANN).repartition(3), 7, last_negatives=20).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    manifest = TS.write_tiled_set(rec, str(tmp_path / "set")).collect()
    assert len(manifest) == sum(TS.SHARDS.values()) and sum(r["n"] for r in manifest) == len(out)
    assert {r["shard_name"] for r in manifest if r["split"] == "train-1"} == {"train-1-00000-of-00001"}
    assert [r["n"] for r in manifest if r["n"] == 0]  # lists too short for their shards say so


def test_broken_text_is_never_an_empty_image(spark):
    rows = table() + [("bad.jpg", "1 x"), ("worse.jpg", "1 5000 x 4"), ("worse.jpg", rect(1, 1, 9, 9))]
    df = spark.createDataFrame(rows, ANN)
    used, reported = A.usable_images(df)
    assert used.count() + reported.count() == len(rows)
    assert sorted((r["ImageId"], r["reason"]) for r in reported.collect()) == [("bad.jpg", "non_numeric_token"), ("worse.jpg", "image_has_broken_row"), ("worse.jpg", "non_numeric_token")]
    assert not make_classification_set(df, 3, 0, 0.3).filter(F.col("ImageId").isin("bad.jpg", "worse.jpg")).count()
    assert not make_training_set(df, 3, 0, 0.3, split_bins=(0.5,)).filter("sample LIKE 'bad%' OR sample LIKE 'worse%'").count()


def test_image_and_mask_turn_together(spark):
    """One point of rotation: the mask's image turned is the turned image's mask, edges and all, at full size."""
    rng = np.random.default_rng(1)
    m = raster([rect(int(x), int(y), 30, 20) for x, y in rng.integers(0, 738, (6, 2))] + [rect(0, 0, 40, 3), rect(740, 700, 28, 68)])
    m = (m > 0).astype(float)
    g = spark.createDataFrame([("i", 768, 768, 1, m.ravel().tolist(), m.ravel().tolist())], "image_id string, h int, w int, c int, data array<double>, label array<double>")
    img = {r["suffix"]: r for r in G.augment(g, "label").collect()}
    text = " ".join(f"{s + 1} 1" for s in np.flatnonzero(m.T.ravel()))
    pieces = R.run_pieces(R.rle_runs(spark.createDataFrame([("i", text)], ANN)))
    out = {s: np.zeros((768, 768)) for s in ("", "_a", "_b", "_f")}
    for r in R.augmented(pieces).collect():
        out[r["suffix"]][r["r0"]:r["r1"], r["col"]] += 1
    for s, want in out.items():
        assert (img[s]["h"], img[s]["w"]) == (768, 768)
        assert np.array_equal(np.array(img[s]["data"]).reshape(768, 768), want) and img[s]["data"] == img[s]["label"]
    assert not out["_a"][0].any() and not out["_a"][:, 0].any() and not out["_b"][0].any()
