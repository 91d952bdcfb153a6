import math

import numpy as np

from maskframe.llm import hnsw, topk
from maskframe.llm import queries as Q

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<float>, label int, rank string, shard string"


def odd_rows():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(120, 6)).astype("float32")
    rows = [(i, x.tolist(), 0, "r", "s") for i, x in enumerate(v)]
    rows += [(200 + i, (v[7] * (i + 1)).tolist(), 1, None, None) for i in range(40)]  # one direction, many lengths
    rows += [(300 + i, v[9].tolist(), 1, None, None) for i in range(30)]  # equal vectors
    rows += [(400, None, 0, "", ""), (401, [], 0, "", ""), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0, "", ""), (403, [math.nan] * 6, 0, "", ""), (404, [math.inf] + [0.0] * 5, 0, "", ""), (405, [0.0] * 6, 0, "", "")]
    return [*rows, (None, v[3].tolist(), 0, "", ""), (5, v[5].tolist(), 0, "again", ""), (50, v[50].tolist(), 0, "again", ""), (406, [1.0, 2.0], 0, "", "")]


def valid(x, zero=True):
    return bool(x) and all(y is not None and math.isfinite(y) for y in x) and (zero or any(x))


def brute_top(rows, asks, k):
    part = {(r[0], tuple(math.floor(256 * float(y)) for y in r[1])) for r in rows if r[0] is not None and valid(r[1])}
    out = []
    for i, q in sorted(x for x in part if x[0] in asks):
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in part if j != i and len(v) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return out


def test_top_k_odd_rows(spark):
    rows = odd_rows()
    d = spark.createDataFrame(rows, VEC)
    for k, shards in ((5, 3), (300, 2)):
        got = topk.top_k(d, d.filter("vec_id % 50 = 0"), k=k, least_shards=shards)
        assert sorted(map(tuple, got.collect())) == brute_top(rows, {r[0] for r in rows if r[0] is not None and r[0] % 50 == 0}, k)
    assert topk.top_k(d.limit(0), d).count() == topk.top_k(d, d.limit(0)).count() == 0


def test_shard_search_is_exact():
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (2000, 16))
    x[:500] = rng.integers(-2, 3, (500, 16))
    s = topk.Shard(np.arange(2000), x)
    for i in range(0, 2000, 97):
        ids, scores = s.search(i, x[i], 5)
        want = sorted((-int(x[i] @ x[j]), j) for j in range(2000) if j != i)[:5]
        assert [(-a, b) for a, b in zip(scores.tolist(), ids.tolist(), strict=True)] == want


def test_op1_and_op5_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, Q.op1_maxscore(spark, SF).collect())) == brute_top(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in Q.op5_near_vectors(spark, SF).collect()}
    assert got == brute_links(rows)


def brute_links(rows, least=0.95):
    ids = [i for i, v in rows if i is not None and valid(v, False)]
    vs = [np.asarray(v, float) / np.linalg.norm(np.asarray(v, float)) for i, v in rows if i is not None and valid(v, False)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    n = dict.fromkeys(range(len(ids)), 0)
    for a in range(len(ids)):
        for b in range(a):
            if len(vs[a]) == len(vs[b]) and vs[a] @ vs[b] >= least:
                n[a] += 1
                n[b] += 1
                x, y = top(ids[a]), top(ids[b])
                up[max(x, y)] = min(x, y)
    links = {}
    for a, i in enumerate(ids):
        links[i] = max(links.get(i, 0), n[a])
    return {i: (links.get(i, 0), top(i), top(i) == i) for i, _ in rows if i is not None}


def test_near_vectors_odd_rows(spark):
    rows = odd_rows()
    d = spark.createDataFrame(rows, VEC)
    out = hnsw.near_duplicates(d).collect()
    assert len(out) == len(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out if r["vec_id"] is not None}
    assert got == brute_links([r[:2] for r in rows])
    none = next(r for r in out if r["vec_id"] is None)
    assert (none["n_links"], none["component_id"], none["kept"]) == (0, None, None)
    assert hnsw.near_duplicates(d.limit(0)).count() == 0


def test_near_vectors_chains_in_few_shards(spark):
    """Neighbours on a chain link, others do not: every single link holds its component together."""
    rng = np.random.default_rng(7)
    v = []
    for _ in range(20):
        a, b = np.linalg.qr(rng.normal(size=(48, 2)))[0].T
        v += [math.cos(t * math.acos(0.97)) * a + math.sin(t * math.acos(0.97)) * b for t in range(12)]
    rows = [(int(i), x.tolist(), 0, "r", "s") for i, x in zip(rng.permutation(len(v)), v, strict=True)]
    want = brute_links([r[:2] for r in rows])
    assert len({c for _, c, _ in want.values()}) == 20
    for shards in (1, 3):
        got = hnsw.near_duplicates(spark.createDataFrame(rows, VEC), least_shards=shards).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == want


def test_graph_recall():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 24))
    x[1000:1400] = x[0] + 0.05 * rng.normal(size=(400, 24))  # one large group
    x[2000:2600:2] = x[2001:2601:2] + 0.1 * rng.normal(size=(300, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = hnsw.Graph(x)
    ids = np.arange(len(x))
    ef = hnsw.audited_beam(g, x, ids, x[::20], ids[::20], 0.95, 0.99, 16)
    r, c = g.within(x.astype(np.float32), 0.95 - 1e-6, ef)
    want = set(map(tuple, np.argwhere(x @ x.T >= 0.95).tolist()))
    assert len(want & set(zip(r.tolist(), c.tolist(), strict=True))) >= 0.99 * len(want)


def test_audit_sees_lone_pairs_beside_large_groups():
    rng = np.random.default_rng(1)
    one = rng.normal(size=(200, 64))
    x = np.concatenate([np.repeat(rng.normal(size=(30, 64)), 150, 0) + 0.12 * rng.normal(size=(4500, 64)), one, one + 0.12 * rng.normal(size=(200, 64))])
    x = x[rng.permutation(len(x))]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, some = np.arange(len(x)), rng.permutation(len(x))[:2048]
    g = hnsw.Graph(x)
    ef = hnsw.audited_beam(g, x, ids, x[some], some, 0.95, 0.99, 24)
    r, c = hnsw.above(x, x, 0.95)
    r, c = r[r != c], c[r != c]
    lone = np.nonzero(np.bincount(r, minlength=len(x)) == 1)[0]
    assert len(lone) == 400
    a, b = g.within(x[lone].astype(np.float32), 0.95 - 1e-6, ef)
    want = set(zip(r[np.isin(r, lone)].tolist(), c[np.isin(r, lone)].tolist(), strict=True))
    assert len(want & set(zip(lone[a].tolist(), b.tolist(), strict=True))) >= 0.99 * len(want)


def test_audit_without_links_and_with_the_whole_graph():
    x = np.eye(40)
    g, ids = hnsw.Graph(x), np.arange(40)
    assert hnsw.audited_beam(g, x, ids, x, ids, 0.95, 0.99, 24) == 24  # a row's link to itself is none
    assert hnsw.audited_beam(g, x, ids, x[:0], ids[:0], 0.95, 0.99, 64) == 40
    r, c = g.within(x.astype(np.float32), 0.95, 40)
    assert r.tolist() == c.tolist() == ids.tolist()
