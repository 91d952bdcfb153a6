"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.session import saved

#: nodes with more edges than this, and than one in ``HUBS`` of all edges, are met by broadcast: at most ``HUBS`` rows
HUB_EDGES, HUBS = 1000, 10_000


def _state(e: DataFrame) -> tuple:
    """(edges, two checksums): equal for equal sets of edges."""
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 20)))).first())


def _with_least(e: DataFrame, edges: int) -> DataFrame:
    """``(u, v)`` with ``m``, the smallest of u and all its v's. The minima are pre-aggregated. They come back to the rows of a hub
    by broadcast, so that these stay where they lie; hubs have more than one in ``HUBS`` of the edges each, so there are fewer
    than ``HUBS`` of them. Other nodes have few edges by the same bound, and meet their minima in a shuffle."""
    limit = max(HUB_EDGES, edges // HUBS)
    low = e.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
    hubs = low.filter(F.col("n") > limit).drop("n")
    near = e.join(F.broadcast(hubs), "u")
    rest = e.join(F.broadcast(hubs.select("u")), "u", "left_anti").join(low.filter(F.col("n") <= limit).drop("n").hint("merge"), "u")
    return near.unionByName(rest)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)``, one row per node with a link to another one; ``root`` is the smallest node that links reach. Nodes are
    of any type that orders (structs too); edges with a null end, loops and repeats do not matter.

    Star contraction: alternately every node's larger neighbours are hung on the smallest one (large star), and its
    smaller ones with itself (small star), until all edges are stars; the number of rounds grows with the logarithm of the
    nodes. Each round is two grouped minima and two joins on single nodes, written to the shared folder; a hub keeps one
    edge per neighbour, and neither a neighbourhood nor a component is ever collected."""
    e = edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    e = saved(e.filter("u != v").distinct(), "edges")
    was = _state(e)
    while was[0]:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, 2 * was[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.distinct(), "large-star")
        hung = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))
        small = _with_least(large, was[0]).select(F.explode(hung).alias("e")).select("e.v", "e.u")
        e = saved(small.filter("u != v").distinct(), "edges")
        now = _state(e)
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
