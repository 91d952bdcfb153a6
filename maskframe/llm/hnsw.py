"""Near-duplicate vectors through hierarchical navigable small-world graphs, one per shard.

Equal vectors are one node. Each shard of bounded size builds its graph: a vector enters on a random level, is linked to its
nearest nodes on every level from there down, and links are thinned so that they lead in different directions. Every shard
answers every vector: greedy descent through the upper levels, a beam on the lowest, then a walk over the links between the
rows found, so that large groups come back whole. Before it answers, a shard audits itself against brute force on a sample
of its queries and widens the beam until the recall asked for is reached; a beam as wide as the shard compares all its rows.
Cosines are verified in double precision; links become components: a shard unites the rows that one vector links as it
answers, so a vector leaves with one edge and a row with one to its group, and together they span every link found.

The audit asks rows of the whole table, leaves out a row's pair with itself, and counts per asked row. Rows with one link, two,
up to four, up to eight and so on are judged apart, so large groups cannot outvote lone pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.llm.common import components, ready, written
from maskframe.llm.topk import usable


class Graph:
    """One shard's graph over unit vectors ``x`` (rows). Searches advance many queries at once, step by step."""

    def __init__(self, x: np.ndarray, m: int = 12, ef: int = 32, seed: int = 1, batch: int = 256):
        self.x, self.m = x.astype(np.float32), m
        n = len(x)
        rng = np.random.Generator(np.random.PCG64(seed))
        self.level = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(m)).astype(int), 8) if n else np.zeros(0, int)
        order = np.argsort(-self.level, kind="stable")
        self.top = int(self.level.max()) if n else 0
        self.entry = int(order[0]) if n else -1
        self.links = [np.full((n, (2 if lv == 0 else 1) * m), -1, np.int32) for lv in range(self.top + 1)]
        # nodes enter in batches, upper levels first; a batch also sees itself
        done = np.zeros(0, np.int64)
        while len(done) < n:
            new = order[len(done) : len(done) + max(1, min(batch, max(len(done), 1)))]
            self._insert(new, done, ef)
            done = order[: len(done) + len(new)]
        # the lowest level's links in both directions, for walks
        src, dst = np.repeat(np.arange(n), self.links[0].shape[1]), self.links[0].ravel().astype(np.int64)
        src, dst = src[dst >= 0], dst[dst >= 0]
        pairs = np.unique(np.concatenate([src * n + dst, dst * n + src])) if n else np.zeros(0, np.int64)
        self.walk_to = pairs % max(n, 1)
        self.walk_at = np.searchsorted(pairs, np.arange(n + 1) * n)

    def _insert(self, new: np.ndarray, done: np.ndarray, ef: int) -> None:
        near = self.x[new] @ self.x[new].T
        np.fill_diagonal(near, -2)
        for lv in range(min(self.top, int(self.level[new].max())), -1, -1):
            own = np.nonzero(self.level[new] >= lv)[0]
            if len(done):
                ids, sims = self.beam(self.x[new[own]], ef, lv)
            else:
                ids, sims = np.full((len(own), 1), -1, np.int64), np.full((len(own), 1), -2, np.float32)
            # the batch's own members are candidates too, each only with those before it, so links exist both ways
            other = np.where((np.arange(len(new))[None, :] < own[:, None]) & (self.level[new] >= lv)[None, :], near[own], -2)
            some = min(self.m, len(new))
            part = np.argpartition(-other, some - 1, axis=1)[:, :some]
            ids = np.concatenate([ids, new[part]], axis=1)
            sims = np.concatenate([sims, np.take_along_axis(other, part, 1)], axis=1)
            ids[sims <= -1.5] = -1
            chosen = self._thin(ids, sims, self.m)
            self.links[lv][new[own], : self.m] = chosen
            self._back(new[own], chosen, lv)

    def _thin(self, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
        """Of each row's candidates up to ``keep``: best first, those nearer to a chosen one than to the row wait; places
        left over go to the best that waited."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        out = np.full((len(ids), keep), -1, np.int64)
        wait = np.zeros(ids.shape, bool)
        count = np.zeros(len(ids), int)
        rows = np.arange(len(ids))
        for c in range(ids.shape[1]):
            ok = (ids[:, c] >= 0) & (count < keep)
            if not ok.any():
                continue
            v = self.x[np.maximum(ids[:, c], 0)]
            got = np.einsum("rkd,rd->rk", self.x[np.maximum(out, 0)], v)
            got[out < 0] = -2
            far = ok & (got.max(1) <= sims[:, c])
            wait[:, c] = ok & ~far
            out[rows[far], count[far]] = ids[far, c]
            count[far] += 1
        for c in range(ids.shape[1]):
            put = wait[:, c] & (count < keep)
            out[rows[put], count[put]] = ids[put, c]
            count[put] += 1
        return out

    def _back(self, new: np.ndarray, chosen: np.ndarray, lv: int) -> None:
        links = self.links[lv]
        src, dst = np.repeat(new, chosen.shape[1]), chosen.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        nodes, start, number = np.unique(dst, return_index=True, return_counts=True)
        used = (links[nodes] >= 0).sum(1)
        fits = used + number <= links.shape[1]
        for t, a, k, u in zip(nodes[fits], start[fits], number[fits], used[fits], strict=True):
            links[t, u : u + k] = src[a : a + k]
        full = np.nonzero(~fits)[0]
        for lo in range(0, len(full), 256):
            part = full[lo : lo + 256]
            width = links.shape[1] + int(number[part].max())
            ids = np.full((len(part), width), -1, np.int64)
            ids[:, : links.shape[1]] = links[nodes[part]]
            for r, p in enumerate(part):
                ids[r, links.shape[1] : links.shape[1] + number[p]] = src[start[p] : start[p] + number[p]]
            sims = np.einsum("rkd,rd->rk", self.x[np.maximum(ids, 0)], self.x[nodes[part]])
            sims[ids < 0] = -2
            links[nodes[part]] = self._thin(ids, sims, links.shape[1])

    def beam(self, q: np.ndarray, ef: int, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the ``ef`` best rows found for each query on ``level``; -1 where there are fewer."""
        n = len(q)
        at = np.full(n, self.entry, np.int64)
        sim = q @ self.x[self.entry]
        for lv in range(self.top, level, -1):  # greedy descent
            moving = np.arange(n)
            while len(moving):
                nb = self.links[lv][at[moving]]
                s = np.einsum("rkd,rd->rk", self.x[np.maximum(nb, 0)], q[moving])
                s[nb < 0] = -2
                j = s.argmax(1)
                v = s[np.arange(len(moving)), j]
                up = v > sim[moving]
                at[moving[up]], sim[moving[up]] = nb[np.arange(len(moving)), j][up], v[up]
                moving = moving[up]
        ids = np.full((n, ef), -1, np.int64)
        sims = np.full((n, ef), -2, np.float32)
        open_ = np.zeros((n, ef), bool)
        ids[:, 0], sims[:, 0], open_[:, 0] = at, sim, True
        seen = np.zeros((n, len(self.x)), bool)
        seen[np.arange(n), at] = True
        links = self.links[level]
        live = np.arange(n)
        while len(live):
            o = np.where(open_[live], sims[live], -3)
            # a few of the best open rows at once
            pick = np.argpartition(-o, min(2, ef) - 1, axis=1)[:, : min(2, ef)]
            ok = np.take_along_axis(o, pick, 1) > -3
            go = ok.any(1)
            live, pick, ok = live[go], pick[go], ok[go]
            if not len(live):
                break
            open_[live[:, None], pick] = False
            nb = links[np.maximum(ids[live[:, None], pick], 0)].astype(np.int64)
            nb[~ok] = -1
            nb = nb.reshape(len(live), -1)
            new = (nb >= 0) & ~seen[live[:, None], np.maximum(nb, 0)]
            r, c = np.nonzero(new)
            v = nb[r, c]
            flat = np.unique(r * len(self.x) + v)  # two picked rows may share a neighbour
            r, v = flat // len(self.x), flat % len(self.x)
            seen[live[r], v] = True
            if not len(r):
                continue
            s = np.einsum("ij,ij->i", self.x[v], q[live[r]])
            good = s > sims[live[r]].min(1)
            r, v, s = r[good], v[good], s[good]
            if not len(r):
                continue
            width = int(np.bincount(r).max())
            first = np.r_[0, np.nonzero(r[1:] != r[:-1])[0] + 1]
            place = np.arange(len(r)) - np.repeat(first, np.diff(np.r_[first, len(r)]))
            hit = np.unique(r)
            row = np.searchsorted(hit, r)
            ai = np.full((len(hit), ef + width), -1, np.int64)
            as_ = np.full((len(hit), ef + width), -2, np.float32)
            ao = np.zeros((len(hit), ef + width), bool)
            ai[:, :ef], as_[:, :ef], ao[:, :ef] = ids[live[hit]], sims[live[hit]], open_[live[hit]]
            ai[row, ef + place], as_[row, ef + place], ao[row, ef + place] = v, s, True
            best = np.argpartition(-as_, ef - 1, axis=1)[:, :ef]
            ids[live[hit]], sims[live[hit]], open_[live[hit]] = np.take_along_axis(ai, best, 1), np.take_along_axis(as_, best, 1), np.take_along_axis(ao, best, 1)
        return ids, sims

    def within(self, q: np.ndarray, least: float, ef: int, slack: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) index pairs whose cosine is ``least`` or more, as far as a beam of ``ef`` and a walk from its
        finds through rows of ``least - slack`` or more reach; all of them if the beam is as wide as the graph."""
        if ef >= len(self.x):
            return above(q, self.x, least)
        ids, sims = self.beam(q, min(ef, len(self.x)))
        r, c = np.nonzero((ids >= 0) & (sims >= least - slack))
        if not len(r):
            return r, r
        n = len(self.x)
        known = np.unique(r * n + ids[r, c])
        front = known
        while len(front):
            r, v = front // n, front % n
            width = self.walk_at[v + 1] - self.walk_at[v]
            at = np.repeat(self.walk_at[v] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
            flat = np.setdiff1d(np.repeat(r, width) * n + self.walk_to[at], known)
            good = []
            for lo in range(0, len(flat), 1 << 16):
                part = flat[lo : lo + (1 << 16)]
                s = np.einsum("ij,ij->i", self.x[part % n], q[part // n])
                good.append(part[s >= least - slack])
            front = np.concatenate(good) if good else flat
            known = np.union1d(known, front)
        return known // n, known % n


def above(q: np.ndarray, x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) index pairs whose cosine is ``least`` or more, from blocks of all products."""
    step = max(1, (1 << 24) // max(len(x), 1))
    parts = [np.nonzero(q[lo : lo + step] @ x.T >= least) for lo in range(0, len(q), step)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([r + k * step for k, (r, _) in enumerate(parts)]), np.concatenate([c for _, c in parts])


def audited_beam(g: Graph, x: np.ndarray, ids: np.ndarray, q: np.ndarray, names: np.ndarray, least: float, recall: float, start: int, rows: int = 128) -> int:
    """The beam at which the graph ``g`` over the vectors ``x`` with ids ``ids`` finds ``recall`` of the links that brute
    force finds for the sample ``q`` with ids ``names``.

    A row's link to itself is none. Rows are judged by their number of links (1, 2, 3-4, 5-8, ...), up to ``rows`` of each
    class: in every class the mean of the rows' recalls, less its standard error, must reach ``recall``. Without any link in
    the sample the beam starts where it is told to; it never passes the size of the shard, where ``within`` is exact."""
    r, c = above(q, x, least)
    own = names[r] == ids[c]
    r, c = r[~own], c[~own]
    links = np.bincount(r, minlength=len(q))
    class_ = np.ceil(np.log2(np.maximum(links, 1))).astype(int)
    asked = np.concatenate([np.zeros(0, int), *(np.nonzero((links > 0) & (class_ == k))[0][:rows] for k in np.unique(class_[links > 0]))])
    if not len(asked):
        return min(start, len(x))
    want = np.unique((r * len(x) + c)[np.isin(r, asked)])
    ef = start
    while ef < len(x):
        a, v = g.within(q[asked].astype(np.float32), least - 1e-6, ef)
        got = want[np.isin(want, asked[a] * len(x) + v)]
        share = (np.bincount(got // len(x), minlength=len(q)) / np.maximum(links, 1))[asked]
        of = class_[asked]
        if all((s := share[of == k]).mean() - s.std() / np.sqrt(len(s)) >= recall for k in np.unique(of)):
            return ef
        ef *= 2
    return len(x)


def united(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``up`` (by member, the smallest member of its group) after the links ``a``-``b``."""
    while True:
        x, y = up[a], up[b]
        far = x != y
        if not far.any():
            return up
        a, b, x, y = a[far], b[far], x[far], y[far]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up[up] != up).any():
            up = up[up]


def links_of(rows: DataFrame, least: float = 0.95, recall: float = 0.99, audit: int = 2048, shard_rows: int = 50_000, least_shards: int = 6, beam: int = 24, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, links, members). nodes: node, copies, one row per distinct vector, ``node`` the smallest id with it.
    links: node, others (rows of other vectors linked directly), to (a node of the same component); the edges node-to span
    the components of all links found, at most one per node and shard and one more per node. members: id, node. About ``audit``
    rows of the table, chosen by a hash, are every shard's sample of queries for its audit."""
    good = F.col(key).isNotNull() & usable(F.col(vector)) & F.exists(F.col(vector), lambda x: x != 0)
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    part = ready(rows).filter(good).select(F.col(key).cast("long").alias("id"), v.alias("v"))
    part = part.withColumn("h0", F.xxhash64("v")).withColumn("h1", F.xxhash64(F.lit("second"), "v"))
    nodes = written(part.groupBy("h0", "h1").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")), "vectors")
    members = part.select("id", "h0", "h1").join(nodes.select("h0", "h1", "node"), ["h0", "h1"]).select("id", "node")
    count = nodes.count()
    shards = max(least_shards, -(-count // shard_rows))
    own = nodes.select(F.pmod(F.col("h0"), F.lit(shards)).cast("int").alias("shard"), F.size("v").alias("dim"), F.lit(0).alias("kind"), "node", "copies", "v")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    ask = nodes.select(everywhere, F.size("v").alias("dim"), F.lit(2).alias("kind"), "node", "copies", "v")
    sampled = F.pmod(F.xxhash64("h0", "h1", F.lit("audit")), F.lit(1 << 30)) < int(min(1.0, audit / max(count, 1)) * (1 << 30))
    trial = nodes.filter(sampled).select(everywhere, F.size("v").alias("dim"), F.lit(1).alias("kind"), "node", "copies", "v")

    def units(g):
        x = np.stack(g["v"].to_numpy()).astype(np.float64)
        x = x / np.abs(x).max(1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def search(batches):
        at, held, asked, graph, unit, up = None, [], [], None, None, np.zeros(0, np.int64)
        ids = up
        ef = beam

        def groups():
            far = np.nonzero(up != np.arange(len(up)))[0]
            return pd.DataFrame({"node": ids[far], "others": np.zeros(len(far), np.int64), "to": ids[up[far]]})

        for b in batches:
            for (s, d, kind), g in b.groupby(["shard", "dim", "kind"], sort=True):
                if at != (s, d):
                    yield groups()
                    at, held, asked, graph, up = (s, d), [], [], None, np.zeros(0, np.int64)
                if kind < 2:
                    (asked if kind else held).append(g)
                    continue
                if not held:
                    continue
                if graph is None:
                    all_ = pd.concat(held)
                    unit = units(all_)
                    ids, copies = all_["node"].to_numpy(), all_["copies"].to_numpy()
                    graph, up = Graph(unit), np.arange(len(unit))
                    sample = pd.concat(asked or held)
                    ef = audited_beam(graph, unit, ids, units(sample), sample["node"].to_numpy(), least, recall, beam)
                for lo in range(0, len(g), 512):
                    own = g.iloc[lo : lo + 512]
                    q = units(own)
                    r, c = graph.within(q.astype(np.float32), least - 1e-6, ef)
                    name = own["node"].to_numpy()
                    ok = name[r] != ids[c]
                    r, c = r[ok], c[ok]
                    exact = np.zeros(len(r), bool)
                    for a in range(0, len(r), 1 << 16):
                        exact[a : a + (1 << 16)] = np.einsum("ij,ij->i", q[r[a : a + (1 << 16)]], unit[c[a : a + (1 << 16)]]) >= least
                    r, c = r[exact], c[exact]
                    if len(r):
                        hit, first, of = np.unique(r, return_index=True, return_inverse=True)
                        up = united(up, c[first][of], c)
                        yield pd.DataFrame({"node": name[hit], "others": np.bincount(r, copies[c], len(own))[hit].astype(np.int64), "to": np.minimum.reduceat(ids[c], first)})
        yield groups()

    # by range into more parts than shards: each shard is a part of its own, where hashes would put several into one
    each = own.unionByName(trial).unionByName(ask).repartitionByRange(4 * shards, "shard", "dim").sortWithinPartitions("shard", "dim", "kind", "node")
    found = written(each.mapInPandas(search, "node long, others long, to long"), "vector-links")
    return nodes.select("node", "copies"), found, members


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", **how) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``rows``.

    Rows link when their cosine is 0.95 (``least``) or more; ``n_links`` counts the other rows linked directly, equal
    vectors included. A null, empty or zero vector, or one with null or non-finite components, links with nothing; vectors
    of different lengths do not link; a null id gives null, 0, null, null. Other columns are ignored; rows that repeat an id
    and vector count as copies; an empty table gives no row.
    """
    nodes, found, members = links_of(rows, key=key, vector=vector, **how)
    sums = found.groupBy("node").agg(F.sum("others").alias("others"))
    comp = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    side = nodes.join(sums, "node", "left").join(comp, "node", "left")
    of = members.join(side, "node").select(F.col("id").alias("_id"), F.coalesce("root", "node").alias("_root"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("_n"))
    of = of.groupBy("_id").agg(F.min("_root").alias("_root"), F.max("_n").alias("_n"))
    out = rows.select(F.col(key).cast("long").alias("vec_id")).join(of, F.col("vec_id") == F.col("_id"), "left")
    root = F.coalesce("_root", "vec_id")
    return out.select("vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"), (F.col("vec_id") == root).alias("kept"))
