"""Tile masses: the arithmetic path for evenly spaced grids equals the literal-range path and a pixel count."""

import numpy as np
from pyspark.sql import functions as F

from maskframe.operators import runs as R
from maskframe.operators import tiles as T


def test_tile_paths_agree_with_pixels(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(20):
        runs = []
        for _ in range(6):
            s = int(rng.integers(1, 768 * 768 - 2000))
            runs.append(f"{s} {int(rng.integers(1, 1500))}")
        rows.append((f"{k}.jpg", " ".join(runs)))
    df = spark.createDataFrame(rows, "ImageId string, EncodedPixels string")
    pieces = R.run_pieces(R.rle_runs(df))
    a = {(r[0], r[1]): r[2] for r in T.tile_overlap(pieces, 768, 5, value_col=None).collect()}
    b = {(r[0], r[1]): r[2] for r in T.tile_overlap(pieces, 768, 5, value_col=None, force_literal=True).collect()}
    assert a == b
    # brute force on pixels
    want = {}
    for img, enc in rows:
        mask = np.zeros(768 * 768, dtype=np.int64)
        t = enc.split()
        for s, l in zip(t[::2], t[1::2]):
            mask[int(s) - 1:int(s) - 1 + int(l)] = 1
        m = mask.reshape(768, 768).T  # rows x cols
        for iy in range(5):
            for ix in range(5):
                v = int(m[128 * iy:128 * iy + 256, 128 * ix:128 * ix + 256].sum())
                if v:
                    want[(img, iy * 5 + ix)] = v
    assert a == want


def test_tile_masses_from_texts(spark, tmp_path):
    """The sums of the texts are those of the pieces, on every canvas, for odd rows too, and no run or piece is a row."""
    from maskframe.plans import catalog as Q
    from maskframe.plans import tiled_set as TS
    from tests.test_image_batches import ODD, noise

    big = [(f"b{k % 3}", " ".join(f"{1 + (k * 7919 + j * 31013) % 580000} {1 + (k * j * 97) % 1800}" for j in range(12))) for k in range(9)]
    rows = [(f"o{k % 4}", t) for k, t in enumerate(ODD)] + noise(3, 40) + big + [(None, "700 300"), ("none", None)]
    df = spark.createDataFrame(rows, "ImageId string, EncodedPixels string").repartition(3)
    pieces = R.run_pieces(R.rle_runs(df))
    want = sorted(map(str, TS.canvas_tiles(pieces).select("ImageId", "cohort", "tile", "mask_area").collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert sorted(map(str, TS.annotated_tiles(df).select("ImageId", "cohort", "tile", "mask_area").collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # boxes of uneven stride and boxes with gaps between them
    for side, n, size in ((700, 4, 130), (768, 2, 100), (256, 1, 256)):
        seg = T.resize_nearest_pieces(pieces, side)
        plain = {(r[0], r[1]): r[2] for r in T.tile_overlap(seg, side, n, size, value_col=None, force_literal=True).collect()}
        assert {(r["ImageId"], r["tile"]): r["mask_area"] for r in T.tile_masses(df, [("x", side, n)], size).collect()} == plain
    spark.range(4).withColumnRenamed("id", "o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    line = "id AS l_orderkey, 50 * id AS l_partkey, id AS l_suppkey, CAST(1 AS INT) AS l_linenumber, CAST(9 AS DOUBLE) AS l_quantity"
    spark.range(3).selectExpr(*line.split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    for key in ("topk_tiles", "tile_select", "tile_select_768"):
        assert "Generate" not in Q.QUERIES[key](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
