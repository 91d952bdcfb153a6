"""Images in Arrow batches: the text parser against the column expressions, and streams that cut images between batches."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from maskframe.functions import rle
from maskframe.functions import rle_batch as B
from maskframe.operators import annotations as A
from maskframe.operators import components as CC
from maskframe.operators import coverage as V
from maskframe.operators import pixel_eval as PE

ODD = [None, "", "  ", "7", "1 2 9", "15 5", "0 1", "0 30", "5 2 1 2", "1 4 3 4", "1 2 3 2", "1 x", "1 2 x", "x 1", "1\t2\n3 1", " 2 2 ",
       "1 0 4 1", "99999999999999999999 1", "1234567890123 2", "-1 2", "1 2 3 1", "1 2 1 2 1 2", "20 1", "21 4"]


def noise(seed, n):
    r = random.Random(seed)
    return [(f"i{r.randrange(n // 5)}", " ".join(f"{r.randrange(1, 64)} {r.randrange(1, 9)}" for _ in range(r.randrange(5)))) for _ in range(n)]


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_parser_reads_what_the_expressions_read(spark):
    texts = ODD + [t for _, t in noise(1, 60)]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, e string")
    got = df.select("n", "e", B.mask_runs(F.col("e"), 4, 5).alias("r"), rle.checked_mask_runs("e", 4, 5).alias("want")).collect()
    assert [(r["n"], r["r"]) for r in got] == [(r["n"], r["want"]) for r in got]
    a = A.with_area(df, "e").select("n", "area", "valid", rle.rle_area("e").alias("a"), rle.rle_valid("e").alias("v")).collect()
    assert [(r["n"], r["area"], r["valid"]) for r in a] == [(r["n"], r["a"], r["v"]) for r in a]


def test_packed_runs_come_back_whole():
    import numpy as np

    counts = np.array([0, 2, 0, 3, 1])
    a, b = np.array([3, 9, 0, 5, 8, 2]), np.array([4, 12, 5, 6, 20, 3])
    for wide in (False, True):
        row, x, y = B.unpack(B.pack(counts, a, b, wide), wide)
        assert row.tolist() == [1, 1, 3, 3, 3, 4] and x.tolist() == a.tolist() and y.tolist() == b.tolist()


def test_images_cut_between_batches(spark, small_batches):
    rows = noise(2, 200) + [("hot", f"{1 + k % 60} {1 + k % 4}") for k in range(50)] + [("none", None), (None, "1 3")]
    df = spark.createDataFrame(rows, "ImageId string, EncodedPixels string").coalesce(1)
    h = w = 8
    want = {}
    for i, t in rows:
        for p in {p for x in rle_pairs(t) for p in range(x[0] - 1, min(x[0] - 1 + x[1], 64))}:
            want[(i, p)] = want.get((i, p), 0) + 1
    seg = V.coverage_segments(df, h, w)
    got = {}
    for s in seg.collect():
        for r in range(s["r0"], s["r1"]):
            assert (s["ImageId"], s["col"] * h + r) not in got
            got[(s["ImageId"], s["col"] * h + r)] = s["c"]
    assert got == want
    enc = {r["ImageId"]: r["EncodedPixels"] for r in V.mask_per_image(seg, F.col("c") >= 1, V.image_ids(df), h).collect()}
    assert set(enc) == {i for i, _ in rows} and enc["none"] is None and enc[None] is None
    for i in {i for i, _ in rows if i}:
        assert {p for s, n in rle_pairs(enc[i]) for p in range(s - 1, s - 1 + n)} == {p for j, p in want if j == i}
    parts = CC.multi_rle(V.select_mask(seg, F.col("c") >= 1), V.image_ids(df), h, w).collect()
    assert {r["ImageId"] for r in parts} == set(enc) and sum(n for r in parts for _, n in rle_pairs(r["EncodedPixels"])) == sum(1 for j, _ in want if j)
    st = CC.component_stats(V.select_mask(seg, F.col("c") >= 1), h, w)
    assert st.agg(F.sum("pixels")).first()[0] == len(want)
    n = PE.pixel_confusion(PE.pixel_pairs(df, df.limit(0), height=h, width=w), by=["ImageId"]).filter("ImageId = 'none'").collect()
    assert [(r["label"], r["pred"], r["n"]) for r in n] == [(0, 0, 64)]


def rle_pairs(text):
    v = [int(x) for x in (text or "").split()]
    return list(zip(v[0::2], v[1::2]))


def test_partitioned_rows_are_not_moved_again(spark):
    df = spark.createDataFrame([("a", "1 5"), ("b", None)], "ImageId string, EncodedPixels string").repartition(4, "ImageId")
    plan = V.coverage_segments([df, df])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2  # the caller's own, one a source; none of run ends
    plan = V.encode_pieces(V.coverage_segments(df), ids=V.image_ids(df))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan  # no text is shuffled to meet its id


def test_augmented_masks_are_the_augmented_pieces(spark, small_batches):
    """The packed variants hold the pixels of the variants by piece, for images cut between batches, lost pixels and odd texts, and
    the plan moves no piece."""
    from maskframe.operators import runs as R

    h = w = 8
    rows = noise(4, 120) + [("hot", f"{1 + k % 60} {1 + k % 4}") for k in range(40)] + [("edge", "1 8"), ("none", None), (None, "1 3"), ("x", "1 y")]
    df = spark.createDataFrame(rows, "ImageId string, EncodedPixels string").repartition(2, "ImageId")
    masks = V.packed_segments(df, h, w)

    def pixels(found):
        return sorted((str(i), s, c, p) for i, s, c, p in found)

    want = []
    for r in R.augmented(V.coverage_segments(df, h, w).select("ImageId", "col", "r0", "r1", "c"), h, w, keep=("c",), centre=(4, 4)).collect():
        want += [(r["ImageId"], r["suffix"], r["c"], r["col"] * h + x) for x in range(r["r0"], r["r1"])]
    got, sums = [], {}
    all_ = R.augmented_masks(masks, h, w, keep=("c",), centre=(4, 4))
    plan = all_._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan  # the caller's own
    for r in all_.collect():
        _, a, b = B.unpack(pa.array([r["_runs"]]), r["_wide"])
        assert (a[1:] >= b[:-1]).all() and r["pixels"] == int((b - a).sum())
        got += [(r["ImageId"], r["suffix"], r["c"], int(p)) for x, y in zip(a, b) for p in range(x, y)]
        sums[(r["ImageId"], r["suffix"])] = sums.get((r["ImageId"], r["suffix"]), 0) + r["pixels"]
    assert pixels(got) == pixels(want)
    ids = {i for i, _ in V.coverage_segments(df, h, w).select("ImageId", "c").collect()}
    assert set(sums) == {(i, s) for i in ids for s in ("", "_a", "_b", "_f")} and sums[("edge", "_a")] == 0
