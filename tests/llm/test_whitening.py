import math
from fractions import Fraction

import numpy as np
import pytest

from maskframe.llm import queries as Q
from maskframe.llm import whitening

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<float>, label int, component string, n string, id string, absent int, x int"


def symmetric(values, seed=1):
    """(matrix, eigenvectors) with the given eigenvalues, to extended precision."""
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q @ (1.5 * np.eye(n, dtype=np.longdouble) - 0.5 * (q.T @ q))
    return (q * np.array(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize(
    "values",
    [
        [10.0, 5.0, 2.0, 1.0, 0.5],
        [3.0] * 6,
        [1.0, 1 + 1e-6, 1 + 1e-8, 1 + 1e-11, 0.25, 0.25, 0.25 + 1e-9],
        [1e6, 1e6 + 1e-4, 1.0, 1 + 1e-10, 1e-4],
        [1.0, 0.0, 0.0, 0.0],
        list(np.linspace(1, 2, 40)),
        [1 + i * 1e-7 for i in range(30)],
    ],
)
def test_eigenpairs_beyond_double(values):
    a, q = symmetric(values)
    value, x = whitening.eigenpairs(a)
    n, size = len(values), max(values)
    assert np.allclose(value.astype(float), sorted(values, reverse=True), rtol=0, atol=4e-16 * size)
    assert np.abs(x.T @ x - np.eye(n)).max() < 1e-16
    assert np.abs(a @ x - x * value).max() < 1e-16 * n * size
    # each column lies in the span of the true vectors of (nearly) its value: 1e-17 / gap is left of the others
    order = np.argsort(-np.array(values), kind="stable")
    for i in range(n):
        for j in range(n):
            gap = abs(values[order[i]] - values[order[j]]) / size
            if gap > 1e-13:
                assert abs(float(q[:, order[j]] @ x[:, i])) < 1e-17 * n / gap + 1e-17


def test_float32_start_alone_would_not_do():
    a, _ = symmetric([1.0, 1 + 1e-9, 0.5, 0.25])
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    assert np.abs(x.T @ x - np.eye(4)).max() > 1e-9
    assert len(whitening.clustered(*whitening.refined(a, x)[1:])) == 1


def valid(v):
    return bool(v) and all(y is not None and math.isfinite(y) for y in v)


def check(got, rows, components=16, scale=64, shift=1_000_000):
    part = [(i, [math.floor(scale * float(y)) + shift for y in v]) for i, v in rows if valid(v)]
    fit = sorted({tuple(x) for _, x in part})
    n, d = len(fit), len(fit[0])
    s = [sum(c) for c in zip(*fit, strict=True)]
    dev = [[n * a - b for a, b in zip(x, s, strict=True)] for x in fit]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in dev), n**3)) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, d)
    name = lambda i: -1 if i is None else i
    by = {}
    for r in got:
        by.setdefault((name(r["vec_id"]), r["deviation"]), []).append(r)
    assert sum(map(len, by.values())) == len(part) * k
    sign = np.ones(k)
    for t, (i, x) in enumerate(part):
        far = [n * a - b for a, b in zip(x, s, strict=True)]
        mine = by[name(i), sum(f * f for f in far)]
        assert {r["component"] for r in mine} == set(range(1, k + 1))
        w = (np.array([f / n for f in far]) @ u[:, :k]) / np.sqrt(e[:k])
        own = np.array([next(r["whitened"] for r in mine if r["component"] == c + 1) for c in range(k)])
        if t == 0:
            sign = np.where(np.sign(w) == np.sign(own), 1, -1)
        assert np.allclose(own, sign * w, atol=1e-7)
    for r in got:
        assert r["n"] == n and abs(r["explained"] / (e[r["component"] - 1] / e.sum()) - 1) < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", "n", "i", 1, 2) for i, v in rows], VEC).repartition(4)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate((rng.normal(size=(90, 5)) * [3, 2, 1, 0.7, 0.5]).astype("float32"))]
    rows += [(200 + i, rows[7][1]) for i in range(60)]  # copies weigh once
    rows += [(1, rows[1][1]), (1, rows[2][1]), (None, rows[3][1]), (None, rows[3][1]), (2**60 + 1, rows[4][1])]
    odd = [(300, None), (301, []), (302, [None] + [0.0] * 4), (303, [math.nan] * 5), (304, [math.inf] * 5)]
    got = whitening.whiten(frame(spark, rows + odd + [(305, [1.0, 2.0]), (306, [3e38] * 5), (307, [-3e38] * 5)]))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), rows)
    check(whitening.whiten(frame(spark, rows), components=2).collect(), rows, components=2)
    far = [(i, [1e9 * y for y in v]) for i, v in rows]  # moments and deviations beyond a long
    out = whitening.whiten(frame(spark, [(i, np.float32(v).tolist()) for i, v in far])).collect()
    assert len(out) == len(rows) * 5 and all(r["deviation"] is None or r["deviation"] >= 0 for r in out) and out[0]["identity_error"] < 1e-9


def test_no_variance(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).count() == 0
    assert whitening.whiten(frame(spark, [(4, None)])).count() == 0
    flat = whitening.whiten(frame(spark, [(i, [float(i), 7.0, 2.0 * i]) for i in range(9)])).collect()  # one direction only
    assert len(flat) == 9 and {r["component"] for r in flat} == {1} and abs(flat[0]["explained"] - 1) < 1e-12


def test_query_on_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(Q.op11_whitening(spark, SF).collect(), rows)
