import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from maskframe.llm import common, mixing, sharding
from maskframe.llm import queries as Q

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_op9_slots_bytes_and_growth(spark):
    rows = Q.op9_sharding(spark, SF).collect()
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(text)
    slots = defaultdict(list)
    for r in rows:
        body = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(body) + 8, zlib.crc32(body), "key")
        assert r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_odd_rows(spark):
    d = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (None, None, 1), (None, "x", 2)], "doc_id long, text string, shard int")
    out = sharding.with_slots(sharding.assign(d, ["doc_id"], {0: 1.0, 1: 1.0, 2: 0.0}, "s"), ["doc_id"], ["text"], "s").collect()
    assert len(out) == 4 and {r["s"] for r in out} <= {0, 1}
    assert len({r["s"] for r in out if r["doc_id"] == 1}) == len({r["s"] for r in out if r["doc_id"] is None}) == 1
    assert sharding.assign(d.limit(0), ["doc_id"], {0: 1.0}).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(["doc_id"], {0: 0.0})


def test_weights_and_removal(spark):
    d = spark.range(20_000).withColumnRenamed("id", "doc_id")
    n = {r["s"]: r["count"] for r in sharding.assign(d, ["doc_id"], {0: 1.0, 1: 3.0}, "s").groupBy("s").count().collect()}
    assert abs(n[1] / 20_000 - 0.75) < 0.02
    moves = sharding.moved(d, ["doc_id"], dict.fromkeys(range(5), 1.0), dict.fromkeys(range(4), 1.0)).collect()
    assert all(r["old_shard"] == 4 or r["old_shard"] == r["new_shard"] for r in moves)


def test_write_shards(spark, tmp_path):
    d = spark.range(100).withColumnRenamed("id", "doc_id")
    sharding.write_shards(d, ["doc_id"], {0: 1.0, 1: 1.0}, str(tmp_path / "out"), files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1}


def test_running_sums_any_partitioning(spark):
    d = spark.createDataFrame([(g, i, i % 4) for g in ("a", None) for i in range(300)], "g string, i long, v long")
    got = [sorted((str(r["g"]), r["i"], r["s"]) for r in common.running(d.repartition(n), ["g"], ["i"], d["v"] if False else common.F.col("v"), "s", 16).collect()) for n in (1, 7)]
    assert got[0] == got[1]
    for g in ("a", "None"):
        own = sorted((s, i % 4) for h, i, s in got[0] if h == g)
        total = 0
        ends = sorted(s + v for s, v in own)
        assert own[0][0] == total and ends[-1] == sum(i % 4 for i in range(300))


def test_components_against_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for a, b in edges if a != b for x in (a, b)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def water(sizes, weights, repeat):
    """Targets by the wording: share by weight, stop at the limit, share the excess again, until none is above."""
    total, out, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if share[i] > repeat * sizes[i]]
        for i in over:
            out[i] = repeat * sizes[i]
            open_.remove(i)
        if not over:
            for i in open_:
                out[i] = share[i]
            break
    return out


def test_targets_follow_the_wording():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 9))
        sizes, weights = rng.integers(0, 100, n).tolist(), [1 + i % 3 for i in range(n)]
        assert np.allclose(mixing.targets(sizes, weights, 3), water(sizes, weights, 3))


def test_permutation():
    for n in (1, 2, 3, 17, 1000):
        p = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 5))
        assert sorted(p.tolist()) == list(range(n))


def test_op7_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in Q.op7_mixing(spark, SF).collect()}
    again = {r["doc_id"]: r for r in Q.op7_mixing(spark, SF).collect()}
    assert rows == again and len(rows) == len(docs)
    size = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")) for d in docs}
    sources = sorted({d["source"] for d in docs}, key=lambda s: (s is None, (s or "").encode()))
    sums, taken = Counter(), Counter()
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["size"] == size[d["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"]
        sums[d["source"]] += r["size"]
        taken[d["source"]] += r["taken"]
    want = water([sums[s] for s in sources], [1 + i % 3 for i in range(len(sources))], 3)
    for s, t in zip(sources, want, strict=True):
        own = [r for r in rows.values() if r["source"] == s]
        assert all(r["source_size"] == sums[s] and math.isclose(r["target"], t, rel_tol=1e-9) for r in own)
        assert abs(taken[s] - t) < 1


def test_mixing_odd_rows(spark):
    rows = [(1, "a b c d", "en", "x", 1), (1, "a b c d", "en", "x", 1), (None, None, None, None, None), (3, "", "en", "y", 0), (4, "one two " * 300, None, None, 7)]
    d = spark.createDataFrame([(*r, 9, "z") for r in rows], DOCS + ", size long, taken string")
    got = mixing.taken(*mixing.mix(d, block=8, per_shard=4)).collect()
    assert len(got) == 5 and all(r["taken"] <= 3 * r["size"] for r in got)
    by = Counter()
    for r in got:
        by[r["source"]] += r["taken"]
    t = {r["source"]: r["target"] for r in got}
    assert all(abs(by[s] - t[s]) < 1 for s in t)
    mixed = mixing.mixed_documents(d, block=8, per_shard=4)
    assert mixed.columns == d.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += len(r["text"].split())
    assert all(words[s] == by[s] for s in t)
    empty = mixing.mix(d.limit(0))
    assert mixing.taken(*empty).count() == 0 and mixing.mixed_documents(d.limit(0)).count() == 0
