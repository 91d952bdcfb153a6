"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

A text stands for its digest, so texts are read once and never shuffled to be compared. Misra-Gries counters, one set per
map task, merged, (Spark's ``freqItems``) name at most ``1 / support`` digests, among them every digest that more than
``support`` of all rows carry. The named digests are counted exactly, map side first, and the winners so verified (at most
``1 / support`` rows, so the broadcast has a bound) settle all their rows where these lie. No digest that is left has more
than ``support`` of the rows; those meet in an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskframe.llm.common import free_names, written

#: runs of these are one space in a normalised text: blank, tab, line feed, vertical tab, form feed, carriage return
BLANKS = r"[\x20\x09-\x0D]+"


def digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the normalised text in UTF-8; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ").cast("binary"), 256)


def frequent(rows: DataFrame, column: str, support: float) -> DataFrame:
    """(``column``): at most ``1 / support`` values, all that more than ``support`` of the rows carry among them."""
    return rows.stat.freqItems([column], support).select(F.explode(f"{column}_freqItems").alias(column))


def winners(rows: DataFrame) -> DataFrame:
    """(digest, best, group_size) by digest of rows (digest, key, row): ``best`` is the smallest (key, row), null keys last."""
    return rows.groupBy("digest").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))


def split(docs: DataFrame, key: str, text: str, support: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, heavy, light): the digest table (digest, key, row) of ``docs``, and the winners of the frequent digests and of
    all others."""
    rows = written(docs.select(digest(F.col(text)).alias("digest"), F.col(key).alias("key"), F.monotonically_increasing_id().alias("row")), "digests")
    named = written(frequent(rows, "digest", support), "frequent-digests")
    heavy = written(winners(rows.join(F.broadcast(named), "digest", "left_semi")), "frequent-winners")
    return rows, heavy, winners(rows.join(F.broadcast(heavy), "digest", "left_anti"))


def memberships(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = 0.001) -> DataFrame:
    """(``key``, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Texts are equal when they are identical after every run of blanks has become one space; a null text is an empty one.
    ``keep_id`` is the smallest ``key`` of the rows of equal text, whose row stays. Null keys come after all others (a group
    of null keys alone has a null ``keep_id``); of rows that repeat the smallest key and text exactly one stays. Other
    columns are ignored, whatever their names; an empty table gives no row.
    """
    rows, heavy, light = split(docs, key, text, support)
    settled = rows.join(F.broadcast(heavy), "digest")
    others = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").join(light, "digest")
    return settled.unionByName(others).select(
        F.col("key").alias(key),
        F.col("best.key").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = 0.001) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per group of equal texts, of the smallest ``key`` (ties and
    nulls as in ``memberships``; which of several rows of the same key and text it is, is open).

    Rows of frequent digests are dropped where they lie unless they carry the winning key; what is left is shuffled.
    """
    _, heavy, light = split(docs, key, text, support)
    d, k = free_names(docs.columns, "digest", "key")
    marked = docs.withColumn(d, digest(F.col(text)))

    def of(win: DataFrame) -> DataFrame:
        return win.select(F.col("digest").alias(d), F.col("best.key").alias(k))

    common, rest = of(heavy), of(light)
    own = F.col(key).eqNullSafe(F.col(k))
    first = marked.join(F.broadcast(common), d).filter(own).drop(k).dropDuplicates([d])
    left = marked.join(F.broadcast(common.select(d)), d, "left_anti").join(rest, d).filter(own).drop(k).dropDuplicates([d])
    return first.unionByName(left).select(*docs.columns)
