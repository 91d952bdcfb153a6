import hashlib
import math

import numpy as np
import pytest

from maskframe.llm import centroids
from maskframe.llm import queries as Q

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<float>, label int, cluster string, block string, id string, x int, n string"


def brute(rows, k=8, rounds=10, scale=1024, dim=64, salt="3"):
    """Lloyd's rounds in Python integers over (id, vector)."""
    part = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(y is not None and math.isfinite(y) for y in v):
            part.append((i, [math.floor(scale * float(y)) for y in v]))
    order = sorted((hashlib.sha256(f"{salt}:{i}".encode()).hexdigest(), v) for i, v in part if i is not None)
    c = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in part]
        for j in range(len(c)):
            group = [v for (_, v), o in zip(part, own, strict=True) if o == j]
            if group:
                c[j] = [sum(x) // len(group) for x in zip(*group, strict=True)]
    last = [nearest(v) for _, v in part]
    sums = [sum(d for d, o in last if o == j) for j in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted((-1 if i is None else i, j, d, sums[j], sum(sums), sha[j]) for (i, _), (d, j) in zip(part, last, strict=True))


def got(df):
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", "b", "i", 1, "n") for i, v in rows], VEC).repartition(5)


@pytest.mark.parametrize("block", [7, 4096])
def test_odd_rows(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 0.3, (150, 6)).astype("float32"))]
    rows += [(200 + i, rows[3][1]) for i in range(80)]  # copies: a third of all rows
    rows += [(1, rows[1][1]), (1, rows[2][1]), (None, rows[4][1]), (None, rows[4][1])]  # repeated and null ids
    rows += [(300 + i, [float(i % 2), 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(6)] + [(310, [0.5] + [0.0] * 5)]  # ties
    rows += [(400, None), (401, []), (402, [1.0] * 5), (403, [1.0] * 7), (404, [None] + [0.0] * 5), (405, [math.nan] * 6), (406, [math.inf] + [0.0] * 5), (407, [0.0] * 6), (408, [-3.0e3] * 6)]
    for k in (1, 5, 8):
        assert got(centroids.clusters(frame(spark, rows), k=k, dim=6, block=block)) == brute(rows, k=k, dim=6)
    # too large for a squared distance in a long: not kept
    assert got(centroids.clusters(frame(spark, [*rows, (500, [3e38] + [0.0] * 5), (501, [-3e38] * 6)]), k=5, dim=6, block=block)) == brute(rows, k=5, dim=6)


def test_few_and_no_rows(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-1.0, 0.0])]
    assert got(centroids.clusters(frame(spark, rows), dim=2)) == brute(rows, dim=2)  # fewer rows than clusters; equal centroids
    assert centroids.clusters(frame(spark, []), dim=2).count() == 0
    assert centroids.clusters(frame(spark, [(None, [1.0, 2.0]), (4, None)]), dim=2).count() == 0  # nobody to open a cluster


def test_bounds_spare_comparisons(spark):
    """Well-separated groups settle: later rounds look at few vectors, and the result stays exact."""
    rng = np.random.default_rng(3)
    heart = rng.normal(0, 1, (6, 6))
    rows = [(i, v.tolist()) for i, v in enumerate((heart[rng.integers(0, 6, 1200)] + rng.normal(0, 0.15, (1200, 6))).astype("float32"))]
    seen = []
    out = centroids.clusters(frame(spark, rows), k=6, dim=6, block=100, audit=lambda r, compared, n: seen.append((compared, n)))
    assert got(out) == brute(rows, k=6, dim=6)
    assert seen[0] == (1200, 1200) and all(n == 1200 for _, n in seen)
    assert sum(c for c, _ in seen[1:]) < 0.5 * 1200 * len(seen[1:])


def test_heap_pops_exactly_what_expired():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 50):
        g = np.sort(rng.random(n))
        for d in (-1.0, 0.3, 2.0):
            assert sorted(centroids.popped(g, d).tolist()) == np.nonzero(g <= d)[0].tolist()


def test_large_components_are_exact():
    rng = np.random.default_rng(5)
    x, c = rng.integers(-(2**27) + 1, 2**27, (20, 64)), rng.integers(-(2**27) + 1, 2**27, (3, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, m, strict=True)) for m in c] for v in x]
    assert centroids.distances(x, c).tolist() == want


def test_query_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(Q.op12_centroids(spark, SF)) == brute(rows)
