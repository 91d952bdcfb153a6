"""Exact centroid clustering (Lloyd's rounds) with heap-ordered bounds.

Vectors become integers and are laid once into blocks of bounded size, in a table bucketed by block. Every cluster of a
block keeps a heap of its vectors' gaps (a lower bound of the distance to any other centroid less an upper bound of the
distance to the own one). When centroids move, no gap is touched: the cluster adds up how much a gap may have shrunk, and a
gap is stored offset by that drift at the time of its entry. Only vectors at the top of a heap whose gap has expired are
popped, compared with all centroids exactly and pushed into the heap of the nearest one; the sums of the clusters change
by the vectors that moved. A round reads the blocks beside their heaps (same buckets: no shuffle of vectors), and its heaps
are the next round's table. Distances and sums are integers, so bounds only decide what is looked at, never a result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskframe.llm.common import ready, shared_path, written
from maskframe.llm.topk import usable

#: components from here on (in absolute value) could push a squared distance of 64 components out of a long
LARGEST = 1 << 27

BLOCKS = "block long, n int, ids binary, absent binary, x binary"
HEAPS = "block long, gaps array<binary>, rows array<binary>, moved array<long>, counts array<long>, compared long"


def scaled(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows ``x`` to integer centroids ``c``."""
    if not len(x):
        return np.zeros((0, len(c)), np.int64)
    top = max(int(np.abs(x).max()), int(np.abs(c).max()), 1)
    if 4 * x.shape[1] * top * top < 1 << 53:  # every partial sum is an integer that a double holds
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - y) ** 2).sum(1) for y in c], axis=1)


def by_label(x: np.ndarray, label: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the rows of ``x`` by label 0 to k - 1."""
    sums = np.zeros((k, x.shape[1]), np.int64)
    for j in np.unique(label).tolist():
        sums[j] = x[label == j].sum(0)
    return sums, np.bincount(label, minlength=k).astype(np.int64)


def gaps_of(squared: np.ndarray, own: np.ndarray, drift: np.ndarray) -> np.ndarray:
    """Distance to the next best centroid less the distance to the own one, offset by the own cluster's drift so far; a
    margin for rounding is taken off."""
    d = np.sqrt(squared.astype(np.float64))
    rows = np.arange(len(d))
    mine = d[rows, own]
    d[rows, own] = np.inf
    other = np.minimum(d.min(1), 1e300)
    return other - mine + drift[own] - 1e-9 * (1 + other + drift[own])


def popped(gaps: np.ndarray, drift: float) -> np.ndarray:
    """Places of the heap (children of i: 2i+1, 2i+2, none less than i) whose gap is not above ``drift``, found from the root
    down through expired places only."""
    front, out = np.zeros(1 if len(gaps) else 0, np.int64), []
    while len(front):
        front = front[gaps[front] <= drift]
        out.append(front)
        front = np.concatenate([2 * front + 1, 2 * front + 2])
        front = front[front < len(gaps)]
    return np.concatenate(out) if out else front


class Block:
    """The vectors of one block and, by cluster, the heap of their gaps."""

    def __init__(self, x: np.ndarray, heaps: list[tuple[np.ndarray, np.ndarray]]):
        self.x, self.heaps = x, heaps

    def start(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """First assignment: every vector is compared with every centroid."""
        self.heaps = [(np.zeros(0), np.zeros(0, np.int32)) for _ in c]
        return self._settle(np.arange(len(self.x), dtype=np.int32), np.full(len(self.x), -1), c, np.zeros(len(c)))

    def advance(self, c: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Pops what has expired at the clusters' total ``drift`` and settles it anew: (change of the clusters' sums, change
        of their counts, vectors compared)."""
        rows, was = [], []
        for k, (gaps, members) in enumerate(self.heaps):
            out = popped(gaps, drift[k])
            if len(out):
                stay = np.ones(len(gaps), bool)
                stay[out] = False
                rows.append(members[out])
                was.append(np.full(len(out), k))
                self.heaps[k] = gaps[stay], members[stay]
        if not rows:
            return np.zeros((len(c), self.x.shape[1]), np.int64), np.zeros(len(c), np.int64), 0
        return self._settle(np.concatenate(rows), np.concatenate(was), c, drift)

    def _settle(self, rows: np.ndarray, was: np.ndarray, c: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        x = self.x[rows].astype(np.int64)
        squared = distances(x, c)
        own = squared.argmin(1)  # the first of equals: ties go to the smaller number
        gaps = gaps_of(squared, own, drift)
        changed = own != was
        left = changed & (was >= 0)
        into, n_into = by_label(x[changed], own[changed], len(c))
        out, n_out = by_label(x[left], was[left], len(c))
        touched = np.union1d(own, was[was >= 0])
        for k in touched.tolist():
            new = own == k
            g, r = np.concatenate([self.heaps[k][0], gaps[new]]), np.concatenate([self.heaps[k][1], rows[new]])
            order = np.argsort(g, kind="stable")  # ascending order is heap order
            self.heaps[k] = g[order], r[order].astype(np.int32)
        return into - out, n_into - n_out, len(rows)


def blocks_of(rows: DataFrame, size: int) -> DataFrame:
    """(block, n, ids, absent, x): the vectors ``x`` (array<long>, one length) of (id, x) in blocks of at most ``size``."""

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, number, held, waiting = TaskContext.get().partitionId(), 0, [], 0

        def block(d: pd.DataFrame) -> pd.DataFrame:
            nonlocal number
            number += 1
            ids, absent = d["id"].to_numpy(np.int64), d["absent"].to_numpy()
            x = np.stack(d["x"].to_numpy()).astype(np.int32)
            return pd.DataFrame({"block": [(part << 32) + number], "n": [len(d)], "ids": [ids.tobytes()], "absent": [absent.astype(np.uint8).tobytes()], "x": [x.tobytes()]})

        for b in batches:
            for lo in range(0, len(b), size):
                held.append(b.iloc[lo : lo + size])
                waiting += len(held[-1])
                if waiting >= size:
                    together = pd.concat(held)
                    yield block(together.iloc[:size])
                    held, waiting = [together.iloc[size:]], waiting - size
        if waiting:
            yield block(pd.concat(held))

    plain = rows.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("absent"), "x")
    return plain.mapInPandas(lay, BLOCKS)


class Buckets:
    """Tables bucketed by block in the shared folder, so that a round's join shuffles neither side; the names live in the
    session's catalog until ``close``."""

    def __init__(self, spark, number: int):
        self.spark, self.number, self.names = spark, number, []

    def put(self, df: DataFrame, name: str) -> DataFrame:
        table = f"centroids_{name}_{uuid.uuid4().hex}"
        laid = df.repartition(self.number, "block").write.format("parquet").bucketBy(self.number, "block").sortBy("block")
        laid.option("path", shared_path(self.spark, table)).saveAsTable(table)
        self.names.append(table)
        return self.spark.table(table)

    def close(self) -> None:
        for n in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {n}")


def first_centroids(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors of the ``k`` rows with the smallest SHA-256 of ``salt``:id; of equal ids the smaller vector; rows without
    an id open no cluster."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")).cast("binary"), 256)
    got = rows.filter("id IS NOT NULL").select(order.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in got], np.int64)


def totals(heaps: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums over the blocks of a round's changes: k x dim and k numbers, whatever the number of blocks."""
    both = heaps.select(F.posexplode(F.concat("moved", "counts", F.array("compared"))).alias("place", "v"))
    out = np.zeros(k * dim + k + 1, dtype=object)
    for r in both.groupBy("place").agg(F.sum("v").alias("v")).collect():
        out[r["place"]] = int(r["v"])
    return out[: k * dim].reshape(k, dim), out[k * dim : -1], int(out[-1])


def clustering(rows: DataFrame, k: int = 8, rounds: int = 10, scale: int = 1024, dim: int = 64, salt: str = "3", block: int = 4096, bucket_blocks: int = 32, key: str = "vec_id", vector: str = "embedding", audit: Callable[[int, int, int], None] | None = None) -> tuple[DataFrame, np.ndarray]:
    """(assignment, centroids): one row (id, cluster, distance) per kept row, and the final centroids.

    Kept are rows whose vector has exactly ``dim`` components, none null or non-finite; components become
    floor(``scale`` * x) (at ``LARGEST`` or more in absolute value, a distance might not fit a long: such vectors are
    not kept). Rows that repeat an id, or have none, are vectors like any other. The centroids start as the first ``k``
    kept vectors by hash (fewer, if there are fewer); ties go to the smaller number; empty clusters stay where they are.
    ``audit`` hears (round, vectors compared, vectors) after every assignment.
    """
    spark = rows.sparkSession
    x = scaled(F.col(vector), scale)
    kept = ready(rows).filter(usable(F.col(vector)) & (F.size(F.col(vector)) == dim)).select(F.col(key).cast("long").alias("id"), x.alias("x"))
    kept = kept.filter(~F.exists("x", lambda v: (v >= LARGEST) | (v <= -LARGEST)))
    c = first_centroids(kept, k, salt)
    if not len(c):
        return spark.createDataFrame([], "id long, cluster int, distance long"), c
    k, number = len(c), rows.count()
    buckets = Buckets(spark, max(8, -(-number // (block * bucket_blocks))))
    try:
        # an order that a repeated task finds again, so that its blocks are the same
        vectors = buckets.put(blocks_of(kept.sortWithinPartitions("id", "x"), block), "vectors")
        heaps = buckets.put(vectors.mapInPandas(assigner(c, None, dim), HEAPS), "heaps")
        sums, counts, compared = totals(heaps, k, dim)
        drift = np.zeros(k)
        if audit:
            audit(0, compared, int(counts.sum()))
        for r in range(1, rounds + 1):
            new = np.array([s // n if n else old for s, n, old in zip(sums, counts, c.astype(object), strict=True)], np.int64)
            if (new == c).all():
                break  # nothing moves any more
            drift, c = drift + shrinkage(c, new), new
            heaps = buckets.put(vectors.join(heaps, "block").mapInPandas(assigner(c, drift, dim), HEAPS), "heaps")
            change, shift, compared = totals(heaps, k, dim)
            sums, counts = sums + change, counts + shift
            if audit:
                audit(r, compared, int(counts.sum()))
        out = written(vectors.join(heaps, "block").mapInPandas(answers(c, dim), "id long, cluster int, distance long"), "clusters")
    finally:
        buckets.close()
    return out, c


def shrinkage(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """By cluster: how much a gap of its vectors may shrink when the centroids move, its own step and the longest other."""
    step = np.sqrt(((new - old).astype(np.float64) ** 2).sum(1))
    other = np.array([np.delete(step, i).max(initial=0) for i in range(len(step))])
    return (step + other) * (1 + 1e-9)


def opened(d: pd.DataFrame, dim: int) -> Iterator[tuple[int, Block, pd.Series]]:
    for r in d.to_dict("records"):
        heaps = [(np.frombuffer(g, np.float64), np.frombuffer(m, np.int32)) for g, m in zip(r.get("gaps", ()), r.get("rows", ()), strict=True)]
        yield r["block"], Block(np.frombuffer(r["x"], np.int32).reshape(r["n"], dim), heaps), r


def assigner(c: np.ndarray, drift: np.ndarray | None, dim: int) -> Callable:
    """The blocks' heaps after an assignment to ``c``, and how it changed the clusters; the first one where ``drift`` is None."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            out = []
            for name, own, _ in opened(d, dim):
                sums, counts, compared = own.start(c) if drift is None else own.advance(c, drift)
                out.append((name, [g.tobytes() for g, _ in own.heaps], [m.tobytes() for _, m in own.heaps], sums.ravel(), counts, compared))
            yield pd.DataFrame(out, columns=["block", "gaps", "rows", "moved", "counts", "compared"])

    return step


def answers(c: np.ndarray, dim: int) -> Callable:
    """(id, cluster, distance) of every vector; the distance is computed exactly from the final centroids."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            for _, own, r in opened(d, dim):
                cluster = np.zeros(r["n"], np.int32)
                far = np.zeros(r["n"], np.int64)
                for j, (_, members) in enumerate(own.heaps):
                    cluster[members] = j
                    far[members] = distances(own.x[members].astype(np.int64), c[j : j + 1])[:, 0]
                ids = pd.array(np.frombuffer(r["ids"], np.int64), dtype="Int64")
                ids[np.frombuffer(r["absent"], np.uint8).astype(bool)] = pd.NA
                yield pd.DataFrame({"id": ids, "cluster": cluster, "distance": far})

    return step


def clusters(rows: DataFrame, key: str = "vec_id", **how) -> DataFrame:
    """(``key``, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per kept row (see ``clustering``): the
    squared distance to the final centroid, its sums over the cluster and over all (null beyond a long), and the lowercase
    hex SHA-256 of the centroid's components as decimal integers joined by commas. An empty table gives no row."""
    spark = rows.sparkSession
    out, c = clustering(rows, key=key, **how)
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}

    def fits(v: int) -> int | None:
        return v if v < 1 << 63 else None

    table = [(j, fits(sums.get(j, 0)), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest()) for j, v in enumerate(c)]
    side = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(side), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
