"""Components of edge tables and of masks as tables; table functions in SQL."""

import numpy as np
from pyspark.sql import functions as F

from maskframe.functions.table_functions import register_table_functions
from maskframe.operators import components as K
from maskframe.operators import coverage as V
from maskframe.operators import graph
from maskframe.operators import runs as R


def brute(edges):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {x: top(x) for x in up}


def test_components_of_edges(spark, monkeypatch):
    rng = np.random.default_rng(0)
    cases = {
        "random": [tuple(map(int, x)) for x in rng.integers(0, 300, (220, 2))],
        "chain": [(i, i + 1) for i in rng.permutation(200).tolist()],
        "star": [(500, i) for i in range(300)] + [(7, 1000), (1000, 2000)],
        "odd": [(1, 1), (None, 3), (4, None), (5, 6), (6, 5), (5, 6)],
        "none": [],
    }
    for edges, names in ((graph.HUB_EDGES, cases), (3, ["random", "star"])):  # with 3, most nodes are hubs
        monkeypatch.setattr(graph, "HUB_EDGES", edges)
        for name in names:
            e = cases[name]
            got = {r["node"]: r["root"] for r in graph.connected_components(spark.createDataFrame(e, "a long, b long")).collect()}
            assert got == brute(e), (name, edges)
    # nodes that are structs, with a null inside
    df = spark.createDataFrame([(None, 2, 1), ("x", 1, 2), (None, 3, 2)], "id string, a int, b int")
    out = graph.connected_components(df.select(F.struct("id", "a").alias("a"), F.struct("id", F.col("b").alias("a")).alias("b"))).collect()
    assert {(r["node"]["id"], r["node"]["a"]): r["root"]["a"] for r in out} == {(None, 1): 1, (None, 2): 1, (None, 3): 1, ("x", 1): 1, ("x", 2): 1}


def test_tables_equal_the_numpy_form(spark):
    rng = np.random.default_rng(3)
    rows = []
    for img in ("a", "b", "c", None):
        m = rng.random((40, 30)) < (0.45 if img != "b" else 0.2)
        for col in range(30):
            edge = np.diff(np.r_[0, m[:, col].astype(int), 0])
            rows += [(img, col, int(a), int(b)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
    rows += [("touch", 3, 0, 5), ("touch", 3, 5, 9), ("touch", 4, 9, 10), ("touch", 6, 9, 10)]  # touching pieces, a corner, a gap
    pieces = spark.createDataFrame(rows, "ImageId string, col long, r0 long, r1 long")
    want = sorted(map(str, K.connected_components(pieces.filter("ImageId IS NOT NULL"), 40, 30).collect()))
    for strip, row_bin, band in ((64, 512, 64), (7, 4, 3), (1, 512, 64)):
        got = K.connected_components_tables(pieces, 40, strip=strip, row_bin=row_bin, band=band).collect()
        assert sorted(str(r) for r in got if r["ImageId"] is not None) == want
        assert sum(r["ImageId"] is None for r in got) == sum(r[0] is None for r in rows)
    assert K.connected_components_tables(pieces.limit(0)).count() == 0


def test_strips_of_texts_equal_pieces(spark):
    """Masks packed by strip where they are swept: the same components, and a component's pieces travel in one row."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"{int(s)} {int(n)}" for s, n in zip(np.sort(rng.choice(40 * 30, 60, False)) + 1, rng.integers(1, 25, 60)))) for i in ("a", "b", None) for _ in range(2)]
    ann = spark.createDataFrame([*rows, ("c", None), ("b", "1 x")], "ImageId string, EncodedPixels string")
    pieces = V.select_mask(V.coverage_segments(ann, 40, 30), "c >= 2")
    for strip in (64, 7, 1):
        strips = V.packed_strips(ann, lambda c, by: c >= 2, strip, 40, 30)
        got = K.connected_components_strips(strips, 40, strip=strip, row_bin=4, band=3)
        assert sorted(map(str, got.collect())) == sorted(map(str, K.connected_components_tables(pieces, 40, strip=strip, row_bin=4, band=3).collect()))
        out = K.strip_components(strips, 40, strip)
        assert out.count() == out.select("root").distinct().count()
        assert strips.select("ImageId", "_strip").distinct().count() == strips.count()


def test_a_canvas_of_100000_columns(spark):
    """One image, long horizontal ships: no task holds the image, and a ship's columns all get its number."""
    ships = [(0, 30_000, 10), (40_000, 99_999, 10), (20_000, 45_000, 500), (5, 6, 11)]
    df = spark.createDataFrame([(a, b, r) for a, b, r in ships], "a long, b long, r long")
    pieces = df.select(F.lit("wide").alias("ImageId"), F.explode(F.sequence("a", "b")).alias("col"), F.col("r").alias("r0"), (F.col("r") + 1).alias("r1"))
    out = K.connected_components_tables(pieces)
    got = sorted(tuple(r) for r in out.groupBy("instance_id").agg(F.count(F.lit(1)), F.min("col"), F.max("col")).collect())
    # the two pixels below the first ship touch it: columns 5 and 6 merge with it
    assert got == [(1, 30_001, 0, 30_000), (2, 60_000, 40_000, 99_999), (3, 25_001, 20_000, 45_000)]


def test_table_functions(spark):
    rows = [("a", "1 3 2 5"), ("a", "1 3"), ("b", None), ("c", ""), ("d", "0 2"), ("e", "589820 900"), ("f", "1 2 x 3"), ("g", "4 2 77"), ("h", "  7   1 "), ("i", "5"), ("j", "0 600000"), ("k", "99999999999999999999 1")]
    df = spark.createDataFrame(rows, "ImageId string, EncodedPixels string")
    want = sorted(map(tuple, R.rle_pixels(R.rle_runs(df)).collect()))
    register_table_functions(spark)
    lateral = spark.sql("SELECT a.ImageId, p.row, p.col FROM {df} a, LATERAL rle_pixels(a.EncodedPixels, 768, 768) p", df=df)
    assert sorted(map(tuple, lateral.collect())) == want
    assert "Python" not in lateral._jdf.queryExecution().executedPlan().toString()
    table = spark.sql("SELECT * FROM mask_pixels(TABLE(SELECT ImageId, EncodedPixels FROM {df}) PARTITION BY ImageId)", df=df)
    assert sorted(map(tuple, table.collect())) == want
