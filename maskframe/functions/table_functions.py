"""Table functions for SQL: runs of a text as pixels.

``rle_pixels(text, height, width)`` is a SQL function: Spark puts its body in the place of the call, so
``FROM annotations a, LATERAL rle_pixels(a.EncodedPixels, 768, 768) p`` runs inside the JVM like any other query.
``mask_pixels(TABLE(...) PARTITION BY ...)`` is its Arrow form for tables, a batch of rows at a time in NumPy (Spark does not
take Arrow table functions in lateral joins).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from maskframe.functions.classes import CANVAS_H, CANVAS_W
from maskframe.session import ship_package

# t: the tokens; used: those with a partner; runs are clipped with slice semantics. A pixel of a row counts once: runs that
# are in order and apart are taken as they are, others through their distinct pixels
_RUNS = """
  transform(array(filter(split(coalesce(text, ''), '\\\\s+'), x -> x <> '')), t ->
    CASE WHEN size(t) < 2 OR NOT forall(slice(t, 1, (size(t) div 2) * 2), x -> x rlike '^[0-9]+$' AND try_cast(x AS BIGINT) IS NOT NULL)
           THEN CAST(array() AS ARRAY<STRUCT<a: BIGINT, b: BIGINT>>)
    ELSE filter(transform(zip_with(filter(slice(t, 1, (size(t) div 2) * 2), (x, i) -> i % 2 = 0), filter(t, (x, i) -> i % 2 = 1),
                                   (x, y) -> named_struct('s', CAST(x AS BIGINT) - 1, 'e', CAST(x AS BIGINT) - 1 + CAST(y AS BIGINT))),
           r -> named_struct('a', least(greatest(CASE WHEN r.s < 0 THEN r.s + height * width ELSE r.s END, 0L), height * width),
                             'b', least(greatest(CASE WHEN r.e < 0 THEN r.e + height * width ELSE r.e END, 0L), height * width))), q -> q.b > q.a) END)[0]
"""
_PIXELS = f"""
  transform(array({_RUNS}), u -> transform(array(flatten(transform(u, q -> sequence(q.a, q.b - 1)))), p ->
    CASE WHEN size(u) < 2 OR forall(zip_with(slice(u, 2, size(u)), slice(u, 1, greatest(size(u) - 1, 0)), (y, x) -> y.a >= x.b), ok -> ok) THEN p
    ELSE array_distinct(p) END)[0])[0]
"""
RLE_PIXELS = f"""CREATE OR REPLACE TEMPORARY FUNCTION rle_pixels(text STRING, height BIGINT, width BIGINT) RETURNS TABLE (row BIGINT, col BIGINT)
RETURN SELECT p % height, p div height FROM (SELECT explode({_PIXELS}) AS p)"""


def painted(text: str | None, height: int, width: int) -> np.ndarray:
    """The distinct flat pixels that a text paints, in order; none if a token it uses is not a number that fits a long."""
    tokens = (text or "").split()
    tokens = tokens[: len(tokens) // 2 * 2]
    if not tokens or not all(t.isascii() and t.isdigit() and int(t) < 1 << 63 for t in tokens):
        return np.zeros(0, np.int64)
    n = height * width

    def bound(x: int) -> int:
        return min(max(x + n if x < 0 else x, 0), n)

    runs = [(bound(int(s) - 1), bound(int(s) - 1 + int(k))) for s, k in zip(tokens[::2], tokens[1::2], strict=True)]
    parts = [np.arange(a, b) for a, b in runs if b > a]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


class MaskPixels:
    """Rows (id, text) -> one row (id, row, col) per painted pixel of each row, on the default canvas."""

    def eval(self, table: pa.RecordBatch) -> Iterator[pa.Table]:
        ids = table.column(0)
        for i, text in enumerate(table.column(1).to_pylist()):  # a row's pixels at a time: bounded by the canvas
            p = painted(text, CANVAS_H, CANVAS_W)
            if len(p):
                yield pa.table({"ImageId": pa.array([ids[i].as_py()] * len(p), pa.string()), "row": pa.array(p % CANVAS_H), "col": pa.array(p // CANVAS_H)})


def register_table_functions(spark: SparkSession) -> None:
    """Makes ``rle_pixels`` and ``mask_pixels`` known to the session's SQL."""
    from pyspark.sql.functions import arrow_udtf

    ship_package(spark)
    spark.sql(RLE_PIXELS)
    spark.udtf.register("mask_pixels", arrow_udtf(MaskPixels, returnType="ImageId string, row bigint, col bigint"))
