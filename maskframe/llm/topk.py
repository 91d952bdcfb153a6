"""Exact top-k inner-product search by MaxScore over sharded impact postings.

A vector's terms are its components. Within a shard of bounded size, every term has its postings (all rows of the shard,
in blocks with the block's smallest and largest impact), so the most that a term can add to a row's score is known before
the row is looked at. For a query the terms are ordered by the spread of their bounds. The terms with the largest bounds are
essential: their postings are traversed for all rows of the shard. The others are probed, one after the other, only for rows
whose score so far plus the best that the unread terms can add still reaches the k-th best score known. Blocks whose bound
falls short are skipped whole. Scores are integers, so the result is exact, ties included. Shards are searched apart and
their k best rows per query merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from maskframe.llm.common import ready

BLOCK = 256


class Shard:
    """The rows of one shard as postings by term: ``x[term, row]``, and bounds by block of rows."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        # rows of like direction stand together, so that block bounds are tight
        order = np.lexsort((ids, x @ np.sign(x.sum(0)) if len(x) else ids))
        self.ids, self.x = ids[order], np.ascontiguousarray(x[order].T)
        starts = np.arange(0, max(len(ids), 1), BLOCK)
        self.block = np.arange(len(ids)) // BLOCK
        if len(ids):
            self.low, self.high = np.minimum.reduceat(self.x, starts, axis=1), np.maximum.reduceat(self.x, starts, axis=1)

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``k`` best rows other than those of ``query_id``, best first, ties to smaller ids."""
        if not len(self.ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # the most each term adds in each block, and over the shard
        best = np.maximum(q[:, None] * self.low, q[:, None] * self.high)
        least = np.minimum(q[:, None] * self.low, q[:, None] * self.high)
        spread = best.max(1) - least.min(1)
        terms = np.argsort(-spread, kind="stable")
        cut = int(np.searchsorted(np.cumsum(spread[terms]), 0.5 * spread.sum())) + 1
        rest = np.concatenate([np.cumsum(best[terms][::-1], axis=0)[::-1], np.zeros((1, best.shape[1]), np.int64)])
        others = self.ids != query_id
        # essential postings: all rows
        score = q[terms[:cut]] @ self.x[terms[:cut]]
        score = np.where(others, score, np.iinfo(np.int64).min // 2)
        # a first threshold: the full scores of the rows that look best so far
        n = int(others.sum())
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        look = np.argpartition(-score, min(4 * k, len(score)) - 1)[: 4 * k]
        look = look[others[look]]
        full = q @ self.x[:, look]
        floor = np.partition(full, len(full) - k)[len(full) - k] if len(full) >= k else np.iinfo(np.int64).min // 2
        rows = np.nonzero(others & (score + rest[cut][self.block] >= floor))[0]
        s = score[rows]
        for i in range(cut, len(terms)):  # probe while competitive
            if len(rows) <= 4 * k:
                t = terms[i:]
                s = s + q[t] @ self.x[t][:, rows]
                break
            s = s + q[terms[i]] * self.x[terms[i], rows]
            keep = s + rest[i + 1][self.block[rows]] >= floor
            rows, s = rows[keep], s[keep]
        order = np.lexsort((self.ids[rows], -s))[:k]
        return self.ids[rows[order]], s[order]


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def impacts(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, shard_rows: int = 50_000, least_shards: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each of ``queries`` its ``k`` rows of the highest inner product of the vectors
    floor(scale * x), ties to smaller ids; all, if there are fewer.

    Both frames have ``key`` and ``vector``; other columns are ignored. A row never answers a query of the same id. Null
    ids, null or empty vectors and vectors with null or non-finite components take no part; vectors of another length than
    the query's do not meet it; rows equal in id and vector count once, and so do such queries (an id with several vectors
    asks with each). Shards hold about ``shard_rows`` rows, and there are at least ``least_shards`` of them.
    """

    def taking_part(d: DataFrame) -> DataFrame:
        return d.filter(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), impacts(F.col(vector), scale).alias("v"))

    cand = taking_part(ready(rows))
    shards = max(least_shards, -(-rows.filter(F.col(key).isNotNull()).count() // shard_rows))
    cand = cand.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.size("v").alias("dim"), F.lit(0).alias("kind"), "id", "v")
    ask = taking_part(queries).distinct().select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.size("v").alias("dim"), F.lit(1).alias("kind"), "id", "v")

    def search(batches):
        at, ids, vectors, shard = None, [], [], None
        for b in batches:
            out = []
            for s, d, kind, i, v in zip(b["shard"], b["dim"], b["kind"], b["id"], b["v"], strict=True):
                if at != (s, d):
                    at, ids, vectors, shard = (s, d), [], [], None
                if kind == 0:
                    ids.append(i)
                    vectors.append(v)
                    continue
                if shard is None:
                    x = np.array(vectors, np.int64).reshape(len(vectors), d)
                    both = np.unique(np.column_stack([np.array(ids, np.int64), x]), axis=0) if len(ids) else np.zeros((0, d + 1), np.int64)
                    shard, ids, vectors = Shard(both[:, 0], both[:, 1:]), [], []
                q = np.asarray(v, np.int64)
                found, scores = shard.search(i, q, k)
                if len(found):
                    out.append(pd.DataFrame({"query_id": i, "q": [q] * len(found), "vec_id": found, "score": scores}))
            if out:
                yield pd.concat(out)

    # by range into more parts than shards: each shard is a part of its own, where hashes would put several into one
    each = cand.unionByName(ask).repartitionByRange(4 * shards, "shard", "dim").sortWithinPartitions("shard", "dim", "kind", "id")
    best = each.mapInPandas(search, "query_id long, q array<long>, vec_id long, score long")
    w = W.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
