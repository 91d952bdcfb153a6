"""Mixing sources to target weights.

The words of a source form one stream (its documents in a repeatable order), cut into blocks of a fixed number of words;
what is left over is the stream's tail. The mix is a sequence of slots, dealt to output shards of a fixed number of slots.
Each output shard draws its source counts from a multinomial over the sources' shares; the k-th slot of a source takes the
block at place k of a pseudorandom permutation of its block numbers (a new permutation for each pass over the source, the
tail last), and blocks are joined to slots by (source, block number). Draws that run past a source's own number of slots are
handed to sources that drew too few, so each source gets exactly its number of slots; the last slot of a source is cut to the
words that its target still lacks. So a source's words differ from its target by less than one word, and no document is
taken more often than the repeat limit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from maskframe.llm.common import free_names, ready, running, written

#: a word is a run of other characters than space, tab, line feed, vertical tab, form feed and carriage return
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: np.ndarray, weights: np.ndarray, repeat: float) -> np.ndarray:
    """Shares of ``sum(sizes)`` by weight, none above ``repeat`` times its size; what a full source cannot take is shared
    again by weight among the others, until none is above. (Water level: sources fill in the order limit / weight.)"""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    limit, out = repeat * sizes, np.zeros(len(sizes))
    left, w_left = sizes.sum(), weights.sum()
    for i in np.argsort(limit / weights, kind="stable"):
        out[i] = min(limit[i], left * weights[i] / w_left)
        left, w_left = left - out[i], w_left - weights[i]
    return out


def documents_of(docs: DataFrame) -> DataFrame:
    """(doc_id, source, h, copy, size) of every row: ``h`` a hash of the text, ``copy`` numbers rows that are equal in
    all of these, so that the four name one row."""
    d = docs.select("doc_id", "source", F.xxhash64("text").alias("h"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return d.withColumn("copy", F.row_number().over(W.partitionBy("doc_id", "source", "h").orderBy("size")))


def sources_of(d: DataFrame, weights: tuple[int, ...], repeat: int) -> pd.DataFrame:
    """One row per source, by code point, null last: number, size, target words (whole words; ``target`` itself is not
    rounded), and slots. The list of sources is catalogue data and fits the driver."""
    s = d.groupBy("source").agg(F.sum("size").alias("size")).toPandas()
    s = s.sort_values("source", key=lambda c: c.map(lambda x: (x is None, (x or "").encode())), ignore_index=True)
    s["size"] = s["size"].astype("int64")
    s["target"] = targets(s["size"].to_numpy(), np.array([weights[i % len(weights)] for i in range(len(s))]), repeat) if len(s) else 0.0
    s["words"] = np.minimum(np.floor(s["target"] + 0.5), repeat * s["size"]).astype("int64")
    return s


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place ``i`` of a pseudorandom permutation of ``range(n)`` chosen by ``key``: four Feistel rounds over the smallest
    even number of bits that holds ``n``, walked on until the value is below ``n``."""
    i, n, key = (np.atleast_1d(np.asarray(x, np.uint64)) for x in (i, n, key))
    half = np.maximum((np.ceil(np.log2(np.maximum(n, 2).astype(float))).astype(np.uint64) + np.uint64(1)) // np.uint64(2), np.uint64(1))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = i.copy(), np.ones(len(i), bool)
    while todo.any():
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for r in range(4):
            x = (right + key[todo] + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & mask[todo])
        out[todo] = (left << half[todo]) | right
        todo[todo] = out[todo] >= n[todo]
    return out.astype(np.int64)


def slots_of(spark, s: pd.DataFrame, block: int, per_shard: int, seed: int) -> DataFrame:
    """The mix: (shard, source number, pass, block, words), one row per slot."""
    full, tail, size = (s["size"] // block).to_numpy(), (s["size"] % block).to_numpy(), s["size"].to_numpy()
    passes = np.where(size > 0, s["words"].to_numpy() // np.maximum(size, 1), 0)
    rest = s["words"].to_numpy() - passes * size
    quota = passes * (full + (tail > 0)) + np.where(rest > full * block, full + 1, -(-rest // block))
    total = int(quota.sum())
    shards = -(-total // per_shard)
    share = quota / max(total, 1)

    def draw(batches):
        for b in batches:
            for j in b["id"]:
                n = min(per_shard, total - int(j) * per_shard)
                c = np.random.Generator(np.random.PCG64([seed, int(j)])).multinomial(n, share)
                k = np.nonzero(c)[0]
                yield pd.DataFrame({"shard": np.full(len(k), j, np.int64), "src": k.astype(np.int32), "n": c[k].astype(np.int64)})

    drawn = written(spark.range(shards).mapInPandas(draw, "shard long, src int, n long"), "draws")
    got = np.zeros(len(s), np.int64)
    for r in drawn.groupBy("src").agg(F.sum("n").alias("n")).collect():
        got[r["src"]] = r["n"]
    over, under = np.maximum(got - quota, 0), np.maximum(quota - got, 0)
    over0, under0 = np.concatenate([[0], np.cumsum(over)]), np.concatenate([[0], np.cumsum(under)])

    def take(batches):
        for b in batches:
            src, k = b["src"].to_numpy().astype(np.int64), b["k"].to_numpy().astype(np.int64)
            late = k >= quota[src]
            r = over0[src] + k - quota[src]
            to = np.searchsorted(under0, r, "right") - 1
            to[~late] = 0
            src, k = np.where(late, to, src), np.where(late, got[np.minimum(to, len(got) - 1)] + r - under0[to], k)
            each = full[src] + (tail[src] > 0)
            p, i = k // each, k % each
            at = np.where(i < full[src], permuted(np.minimum(i, np.maximum(full[src] - 1, 0)), np.maximum(full[src], 1), (src * 1009 + p) * 7919 + seed), full[src])
            words = np.where(at < full[src], block, tail[src])
            words = np.where(p == passes[src], np.minimum(words, rest[src] - i * block), words)
            yield pd.DataFrame({"shard": b["shard"], "src": src.astype(np.int32), "pass": p.astype(np.int32), "block": at, "words": words.astype(np.int64)})

    before = W.partitionBy("src").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    each = drawn.withColumn("k0", F.coalesce(F.sum("n").over(before), F.lit(0))).select("shard", "src", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"), "k0").select("shard", "src", (F.col("k0") + F.col("i")).alias("k"))
    return each.mapInPandas(take, "shard long, src int, pass int, block long, words long")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeat: int = 3, block: int = 256, per_shard: int = 4096, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (doc_id, source, text; other columns are ignored).

    Returns (documents, spans). documents: doc_id, source, h, copy, size, source_size, target, one row per input row.
    spans: doc_id, source, h, copy, shard, pass, lo, hi: words [lo, hi) of that document stand in that output shard, on
    that pass over its source. A null or empty text has size 0 and no span; a null source is a source of its own; equal
    rows count each; an empty table gives empty frames. The result depends only on the rows and the parameters.
    """
    spark = ready(docs).sparkSession
    d = written(documents_of(docs), "mix-documents")
    s = sources_of(d, weights, repeat)
    rows = [(x, i, int(n), float(t)) for i, (x, n, t) in enumerate(s[["source", "size", "target"]].itertuples(index=False, name=None))]
    quotas = spark.createDataFrame(rows, "source string, src int, source_size long, target double")
    q = quotas.withColumnRenamed("source", "_source")
    known = d.join(F.broadcast(q) if len(s) <= 10_000 else q, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    slots = slots_of(spark, s, block, per_shard, seed)
    at = running(known.filter("size > 0"), ["src"], ["doc_id", "h", "copy"], F.col("size"), "start")
    pieces = at.select("doc_id", "source", "h", "copy", "src", "start", "size", F.explode(F.sequence((F.col("start") / block).cast("long"), ((F.col("start") + F.col("size") - 1) / block).cast("long"))).alias("block"))
    pieces = pieces.withColumn("lo", F.greatest(F.col("start") - F.col("block") * block, F.lit(0))).withColumn("hi", F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block)))
    spans = pieces.join(slots.hint("merge"), ["src", "block"]).withColumn("hi", F.least("hi", "words")).filter("hi > lo")
    first = F.col("block") * block - F.col("start")
    spans = spans.select("doc_id", "source", "h", "copy", "shard", "pass", (F.col("lo") + first).alias("lo"), (F.col("hi") + first).alias("hi"))
    return known.drop("src"), spans


def taken(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """``documents`` with ``taken``: the words that the mix takes of the row, repeats counted."""
    row = ["doc_id", "source", "h", "copy"]
    sums = spans.groupBy(*row).agg(F.sum(F.col("hi") - F.col("lo")).alias("t")).select(*[F.col(c).alias(f"_{c}") for c in row], "t")
    on = F.lit(True)
    for c in row:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return documents.join(sums.hint("merge"), on, "left").withColumn("taken", F.coalesce("t", F.lit(0)).cast("long")).drop("t", *[f"_{c}" for c in row])


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix as documents: one row per document and pass that takes words of it, with all columns of ``docs``; ``text``
    is the whole text where the pass takes all of it, else its words taken, in order, each unbroken span as it stands in
    the text and spans on lines of their own (``n_chars`` follows the text if there is such a column)."""
    import re

    documents, spans = mix(docs, **how)
    row = ["doc_id", "source", "h", "copy"]
    doc, source, h, copy, pass_, own, key, h2, key2, copy2 = free_names(docs.columns, *row, "pass", "spans", "key", "h2", "key2", "copy2")
    lists = spans.groupBy(*row, "pass").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias(own))
    lists = lists.select(*[F.col(c).alias(n) for c, n in zip(row, (doc, source, h, copy), strict=True)], F.col("pass").alias(pass_), own)

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        word, out = re.compile(WORD), []
        for text, own in zip(texts, spans, strict=True):
            joined: list[list[int]] = []
            for x in own:
                if joined and joined[-1][1] == x["lo"]:
                    joined[-1][1] = x["hi"]
                else:
                    joined.append([x["lo"], x["hi"]])
            at = [m.span() for m in word.finditer(text)]
            out.append(text if joined == [[0, len(at)]] else "\n".join(text[at[lo][0] : at[hi - 1][1]] for lo, hi in joined))
        return pd.Series(out)

    cut = F.pandas_udf(cut, "string")
    # a text meets its spans on one number for (doc_id, source, text); equal rows are told apart only if there are any
    lists = lists.withColumn(key, F.xxhash64(doc, source, h))
    keyed = docs.withColumn(h2, F.xxhash64("text")).withColumn(key2, F.xxhash64("doc_id", "source", h2))
    on = (F.col(key2) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(doc)) & F.col("source").eqNullSafe(F.col(source)) & (F.col(h2) == F.col(h))
    if documents.filter("copy > 1").limit(1).count():
        keyed = keyed.withColumn(copy2, F.row_number().over(W.partitionBy(key2, "doc_id", "source", h2).orderBy(h2)))
        on = on & (F.col(copy2) == F.col(copy))
    out = keyed.join(lists.hint("merge"), on).withColumn("text", cut("text", own))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)
