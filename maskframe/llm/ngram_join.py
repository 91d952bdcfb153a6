"""N-gram Jaccard join: which texts share at least a given part of their word n-grams.

Texts with the same n-gram set are one class, represented by its smallest document. MinHash signatures of the classes are
cut into bands; band and row counts are chosen for a target recall at the threshold. Classes that agree on a band meet in
the shuffle on its hash, and every pair found is verified on the full n-gram sets. No pair is ever a row: a bucket is split
into tiles of a bounded number of members, pairs of tiles are compared as matrices, and what leaves them is one row per
member (its links and one edge towards its group). A pair that agrees on several bands is counted in the first of them only.
"""

from __future__ import annotations

import re
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.llm.common import components, free_names, ready, written

WORD = re.compile(r"\w+")


def bands_for(threshold: float, recall: float, most: int = 160) -> tuple[int, int]:
    """(bands, rows): the most selective banding (most rows) of at most ``most`` hashes that finds a pair at the threshold
    with probability ``recall`` at least."""
    for rows in range(16, 0, -1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding reaches that recall")


class Words(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class Shingler:
    """N-gram sets as sorted arrays of 64-bit hashes, and their signatures."""

    def __init__(self, n: int, bands: int, rows: int, memory: int = 500_000):
        self.n, self.bands, self.rows, self.memory, self.words = n, bands, rows, memory, Words()
        g = np.random.Generator(np.random.PCG64(20240229))
        self.mul = g.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.add = g.integers(0, 2**32, bands * rows, dtype=np.uint32)

    def grams(self, text: str | None) -> np.ndarray:
        """The set of hashes of the runs of ``n`` words (lower case, letters, digits and underscore); a text of fewer words
        is one n-gram, a text without a word none."""
        words = WORD.findall(text.lower()) if text else []
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.words) > self.memory:
            self.words.clear()
        w = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        k = min(self.n, len(w))
        h = np.full(len(w) - k + 1, k, np.uint64)
        for i in range(k):
            h = (h ^ w[i : len(w) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h = h ^ (h >> np.uint64(29))
        h.sort()
        return h[np.r_[True, h[1:] != h[:-1]]]

    def signature(self, grams: np.ndarray) -> np.ndarray:
        """One 64-bit hash per band, from the smallest of 32-bit hashes of the n-grams."""
        low = np.full(self.bands * self.rows, np.iinfo(np.uint32).max, np.uint32)
        half = (grams >> np.uint64(32)).astype(np.uint32)[:, None]
        for at in range(0, len(grams), 256):
            np.minimum(low, (half[at : at + 256] * self.mul + self.add).min(0), out=low)
        h = np.zeros(self.bands, np.uint64)
        for i in range(self.rows):
            h = (h ^ low[i :: self.rows].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = h ^ (h >> np.uint64(31))
        return h


def classes(docs: DataFrame, shingler: Shingler) -> DataFrame:
    """(doc_id, h, k0, k1, grams, bands) of every row with an id: ``h`` a hash of the text, ``k0, k1`` 128 bits of the
    n-gram set, ``bands`` empty for a text without a word."""

    def sign(batches):
        import xxhash

        for b in batches:
            rows = []
            for doc, h, text in zip(b["doc_id"], b["h"], b["text"], strict=True):
                g = shingler.grams(text)
                d = xxhash.xxh3_128_intdigest(g.tobytes())
                rows.append((doc, h, (d >> 64) - 2**63, (d & (2**64 - 1)) - 2**63, len(g), shingler.signature(g).view(np.int64) if len(g) else []))
            yield pd.DataFrame(rows, columns=["doc_id", "h", "k0", "k1", "grams", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text").filter("doc_id IS NOT NULL").mapInPandas(sign, "doc_id long, h long, k0 long, k1 long, grams long, bands array<long>")


def grouped(batches, keys: list[str], most: int = 1 << 22):
    """Runs of rows with equal ``keys`` of a sorted stream, as frames; a run that batches divide is put together."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        k = b[keys].to_numpy()
        cuts = np.nonzero((k[1:] != k[:-1]).any(1))[0] + 1
        bounds = [0, *cuts.tolist(), len(b)]
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            part = b.iloc[lo:hi]
            if lo == 0 and held and (held[-1][keys].iloc[-1].to_numpy() == k[0]).all():
                held.append(part)
                continue
            if held:
                yield pd.concat(held) if len(held) > 1 else held[0]
            held = [part]
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def first_pairs(sig: np.ndarray, band: int, tile: np.ndarray, two: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of one bucket of band ``band`` that agree on no earlier band; across the two tiles if ``two``."""
    n = len(sig)
    if n == 2:
        ok = (sig[0, :band] != sig[1, :band]).all() and (not two or tile[0] != tile[1])
        return (np.array([0]), np.array([1])) if ok else (np.zeros(0, int), np.zeros(0, int))
    if two:
        pair = tile[:, None] != tile[None, :]
    else:
        pair = np.ones((n, n), bool)
    pair &= np.arange(n)[:, None] < np.arange(n)[None, :]
    for k in range(band):
        pair &= sig[:, None, k] != sig[None, :, k]
        if not pair.any():
            break
    return np.nonzero(pair)


def verified(i: np.ndarray, j: np.ndarray, sets: list[np.ndarray], threshold: Fraction) -> np.ndarray:
    """Which of the pairs share ``threshold`` of their union at least, exactly."""
    num, den = threshold.numerator, threshold.denominator
    size = np.array([len(s) for s in sets], np.int64)
    can = np.minimum(size[i], size[j]) * den >= np.maximum(size[i], size[j]) * num
    both = np.zeros(len(i), np.int64)
    if can.sum() <= 4 * len(sets) and can.sum() < 64:
        for p in np.nonzero(can)[0]:
            both[p] = len(np.intersect1d(sets[i[p]], sets[j[p]], assume_unique=True))
    else:
        all_, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        order = np.argsort(all_, kind="stable")
        all_, owner = all_[order], owner[order]
        new = np.r_[True, all_[1:] != all_[:-1]]
        number = np.cumsum(new) - 1
        many = np.bincount(number)[number] > 1  # n-grams of one member only are in no intersection
        number, owner = number[many], owner[many]
        if len(number):
            number = np.cumsum(np.r_[False, number[1:] != number[:-1]])
            total = np.zeros((len(sets), len(sets)), np.float32)
            for lo in range(0, int(number[-1]) + 1, 4096):
                a, b = np.searchsorted(number, (lo, lo + 4096))
                m = np.zeros((len(sets), min(4096, int(number[-1]) + 1 - lo)), np.float32)
                m[owner[a:b], number[a:b] - lo] = 1
                total += m @ m.T
            both = total[i, j].astype(np.int64)
    return can & (both * den >= (size[i] + size[j] - both) * num)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    """Smallest member that links reach, by member."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def join(docs: DataFrame, **how) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored) with an id; parameters as in ``grouping``.

    Returns doc_id; text_hash (xxhash64 of the text); text_class, the smallest doc_id with the same n-gram set; class_id, the smallest doc_id that links
    reach (itself included); n_links, the other rows linked directly: those of the same set, and those of sets that share
    ``threshold`` of the union with it. Rows that repeat an id with other texts are linked by their texts alone. Texts without a word (null, empty) link with nothing; short texts are one n-gram;
    rows that repeat an id and text count as copies of one another; an empty table gives no row.
    """
    return grouping(docs, **how).drop("root", "first")


def grouping(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9995, tile: int = 256) -> DataFrame:
    """The rows of ``join`` with ``root``, the smallest (doc_id, n-gram set) that links reach (null for a text without a
    word), and ``first``: whether the row has that id and set."""
    bands, rows = bands_for(threshold, recall)
    limit = Fraction(str(threshold))
    sh = Shingler(n, bands, rows)
    c = written(classes(ready(docs), sh), "ngram-classes")
    words = c.filter("grams > 0")
    own = ["k0", "k1"]
    reps = words.groupBy(*own).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    reps = written(reps, "ngram-reps")
    # bands: one row per class, whatever its number of copies
    signs = words.join(reps, own).filter("doc_id = rep").select("rep", "k0", "k1", "copies", "bands").dropDuplicates(["rep", "k0", "k1"])
    signs = written(signs, "ngram-signatures")
    hung = signs.select("rep", "k0", "k1", F.posexplode("bands").alias("band", "key"))
    shared = hung.groupBy("band", "key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    tiles = F.ceil(F.col("m") / tile).cast("int")
    # only classes that share a bucket get their signatures back
    met = hung.join(shared, ["band", "key"]).join(signs, ["rep", "k0", "k1"]).withColumn("t", F.pmod(F.xxhash64("rep", "k0"), tiles).cast("int"))
    met = met.withColumn("u", F.explode(F.sequence(F.lit(0), tiles - 1))).withColumns({"lo": F.least("t", "u"), "hi": F.greatest("t", "u")})
    group = ["band", "key", "lo", "hi"]
    cols = [*group, "t", "rep", "k0", "k1", "copies", "bands"]

    def candidates(batches):
        out, rows_out = [], 0
        for g in grouped(batches, group):
            band, two = int(g["band"].iloc[0]), g["lo"].iloc[0] != g["hi"].iloc[0]
            if len(g) > 1:
                i, j = first_pairs(np.stack(g["bands"].to_list()), band, g["t"].to_numpy(), two)
                if len(i):
                    out.append(g.iloc[np.unique(np.concatenate([i, j]))])
                    rows_out += len(out[-1])
                    if rows_out > 2000:
                        yield pd.concat(out)
                        out, rows_out = [], 0
        if out:
            yield pd.concat(out)

    schema = "band int, key long, lo int, hi int, t int, rep long, k0 long, k1 long, copies long, bands array<long>"
    place = met.select(*cols).repartition(*group).sortWithinPartitions(*group)
    members = written(place.mapInPandas(candidates, schema), "ngram-members")
    # the sets of the members only, made again from their texts
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")

    def sets(batches):
        import xxhash

        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                g = sh.grams(text)
                d = xxhash.xxh3_128_intdigest(g.tobytes())
                rows.append((doc, (d >> 64) - 2**63, (d & (2**64 - 1)) - 2**63, g.tobytes()))
            yield pd.DataFrame(rows, columns=["rep", "k0", "k1", "set"])

    full = texts.mapInPandas(sets, "rep long, k0 long, k1 long, set binary")
    located = members.join(full, ["rep", "k0", "k1"]).select(*cols, "set").repartition(*group).sortWithinPartitions(*group, "rep", "k0", "k1")

    def verify(batches):
        out, rows_out = [], 0
        for g in grouped(batches, group):
            g = g.drop_duplicates(["rep", "k0", "k1"])
            band, two = int(g["band"].iloc[0]), g["lo"].iloc[0] != g["hi"].iloc[0]
            if len(g) < 2:
                continue
            i, j = first_pairs(np.stack(g["bands"].to_list()), band, g["t"].to_numpy(), two)
            ok = verified(i, j, [np.frombuffer(x, np.uint64) for x in g["set"]], limit)
            i, j = i[ok], j[ok]
            if len(i):
                copies, rep = g["copies"].to_numpy(), g["rep"].to_numpy()
                links = np.bincount(i, copies[j], len(g)) + np.bincount(j, copies[i], len(g))
                some = np.nonzero(links)[0]
                up = np.array(roots(len(g), i, j))
                out.append(pd.DataFrame({"rep": rep[some], "k0": g["k0"].to_numpy()[some], "k1": g["k1"].to_numpy()[some], "links": links[some].astype(np.int64), "to": rep[up[some]], "to0": g["k0"].to_numpy()[up[some]], "to1": g["k1"].to_numpy()[up[some]]}))
                rows_out += len(some)
                if rows_out > 5000:
                    yield pd.concat(out)
                    out, rows_out = [], 0
        if out:
            yield pd.concat(out)

    found = written(located.mapInPandas(verify, "rep long, k0 long, k1 long, links long, to long, to0 long, to1 long"), "ngram-links")
    links = found.groupBy("rep", "k0", "k1").agg(F.sum("links").alias("links"))
    # a node is an n-gram set, whatever ids it has; the smallest document comes first in its order
    node = F.struct("rep", "k0", "k1")
    roots_ = components(found.select(node.alias("a"), F.struct(F.col("to").alias("rep"), F.col("to0").alias("k0"), F.col("to1").alias("k1")).alias("b")))
    side = reps.join(links, ["rep", "k0", "k1"], "left").withColumn("node", node).join(roots_, "node", "left")
    side = side.select("k0", "k1", "rep", F.coalesce("root", "node").alias("root"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
    out = c.select("doc_id", "h", "k0", "k1", "grams").join(side, own, "left")
    alone = F.col("grams") == 0
    return out.select(
        "doc_id",
        F.col("h").alias("text_hash"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("text_class"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("root.rep")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("copies") - 1 + F.col("links")).cast("long").alias("n_links"),
        F.when(~alone, F.col("root")).alias("root"),
        (F.struct("doc_id", "k0", "k1") == F.col("root")).alias("first"),
    )


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one row of each group of linked rows: the one of the smallest doc_id. Rows without an id or without a
    word stay; of rows that repeat an id and text one stays. All columns stay as they are."""
    j = written(grouping(docs, **how), "ngram-join").filter("root IS NOT NULL")
    doc, h, mine = free_names(docs.columns, "doc", "hash", "mine")
    # rows of the smallest id may differ in text and yet have the root's set: the smallest hash stays
    kept = written(j.filter("first").groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"), F.count(F.lit(1)).alias("n")).select("k.*", "n"), "ngram-kept")
    gone = j.select("doc_id", "text_hash").join(kept, ["doc_id", "text_hash"], "left_anti").distinct()

    def of(d: DataFrame) -> DataFrame:
        return d.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(h))

    on = (F.col(mine) == F.col(h)) & (F.col("doc_id").cast("long") == F.col(doc))
    left = docs.withColumn(mine, F.xxhash64("text")).join(of(gone), on, "left_anti")
    again = kept.filter("n > 1")  # the same text perhaps, with the same id
    if again.limit(1).count() == 0:
        return left.select(*docs.columns)
    once = left.join(of(again), on, "left_semi").dropDuplicates(["doc_id", mine])
    return left.join(of(again), on, "left_anti").unionByName(once).select(*docs.columns)
