"""Properties of SURVEY 5 on many random masks in one job: canonical encoding round trip, coverage-weighted area,
vote monotonicity."""

from itertools import groupby

import numpy as np
from pyspark.sql import functions as F

from maskframe.functions.rle import rle_area
from maskframe.operators import coverage as V


def np_encode(flat):
    """Start and length of every group of consecutive set positions."""
    groups = groupby(enumerate(np.flatnonzero(flat).tolist()), key=lambda x: x[1] - x[0])
    runs = [[p for _, p in own] for _, own in groups]
    return " ".join(f"{r[0] + 1} {len(r)}" for r in runs)


def test_round_trip_area_and_vote(spark):
    rng = np.random.default_rng(11)
    h, w = 9, 7
    rows, union, cover = [], {}, {}
    for k in range(40):
        img = f"{k}.jpg"
        cov = np.zeros(h * w, dtype=int)
        for _ in range(int(rng.integers(1, 4))):
            flat = (rng.random(h * w) < rng.uniform(0.05, 0.5)).astype(int)
            rows.append((img, np_encode(flat) if flat.any() else None))
            cov += flat
        union[img] = np_encode(cov > 0) if (cov > 0).any() else None
        cover[img] = cov
    df = spark.createDataFrame(rows, "ImageId string, EncodedPixels string")
    seg = V.coverage_segments(df, h, w)
    ids = V.image_ids(df)
    enc = {r["ImageId"]: r["EncodedPixels"] for r in V.mask_per_image(seg, F.col("c") >= 1, ids, h).collect()}
    assert enc == union  # canonical: equal to the NumPy encoder on the union mask
    # re-encoding the canonical text is idempotent
    again = spark.createDataFrame([(k, v) for k, v in enc.items()], "ImageId string, EncodedPixels string")
    seg2 = V.coverage_segments(again, h, w)
    enc2 = {r["ImageId"]: r["EncodedPixels"] for r in V.mask_per_image(seg2, F.col("c") >= 1, V.image_ids(again), h).collect()}
    assert enc2 == enc
    # sum of text areas == coverage-weighted area of the segments (no clipping or overlap inside one row here)
    text_area = df.select(F.sum(rle_area("EncodedPixels"))).first()[0]
    seg_area = seg.select(F.sum((F.col("r1") - F.col("r0")) * F.col("c"))).first()[0]
    assert text_area == seg_area == int(sum(c.sum() for c in cover.values()))
    # vote(2) is inside vote(1)
    v2 = V.select_mask(seg, F.col("c") >= 2)
    v1 = V.select_mask(seg, F.col("c") >= 1)
    px = lambda p: p.select("ImageId", F.explode(F.sequence(F.col("col") * h + F.col("r0"), F.col("col") * h + F.col("r1") - 1)).alias("p"))
    assert px(v2).exceptAll(px(v1)).count() == 0
    assert px(v2).count() == int(sum((c >= 2).sum() for c in cover.values()))
