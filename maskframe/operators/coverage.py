"""Coverage sweep and what is built on it.

Plan shape (per query):

1. the texts of an image stand together in one task (a window; no exchange if the table is already partitioned so);
2. a task reads them in Arrow batches: parse, per-row union, column cut, +1/-1 events at run ends, summed by
   ``(image, col, pos)``; a hot image keeps at most (H+1) x W sums from one batch to the next;
3. a running sum over the ordered positions gives the segments.

Per-image steps after the sweep (encode, stats) work on segments, and an image has at most H*W/2 of them no
matter how many rows it had: those groups are bounded by the canvas.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.functions import rle_batch as B
from maskframe.functions.classes import CANVAS_H, CANVAS_W, SHIP_IGNORE_LABEL
from maskframe.operators import image_batches as IB
from maskframe.session import ship_package

ID = "ImageId"
ENC = "EncodedPixels"


def coverage_segments(
    sources: Sequence[DataFrame] | DataFrame,
    height: int = CANVAS_H,
    width: int = CANVAS_W,
    id_col: str = ID,
    enc_col: str = ENC,
) -> DataFrame:
    """M3: elementary segments ``(id, col, r0, r1, c, c0, c1, ...)`` where ``c`` instances cover rows r0..r1-1 of
    column ``col`` and ``c<i>`` counts the rows of source ``i`` alone. Only covered segments (c > 0) are returned.

    Masks are added, not or-ed: a pixel in two instances counts 2 (SURVEY 1.1-5)."""
    if isinstance(sources, DataFrame):
        sources = [sources]
    ns = len(sources)
    seg = _segments(sources, height, width, id_col, enc_col)
    return seg.filter(F.col("c") > 0).select(id_col, "col", "r0", "r1", "c", *[f"c{i}" for i in range(ns if ns > 1 else 0)])


def _segments(sources: Sequence[DataFrame], height: int, width: int, id_col: str, enc_col: str = ENC) -> DataFrame:
    """``(id, col, r0, r1, c, c0, c1, ...)`` of :func:`coverage_segments` and one empty segment (``c`` 0) per image, so that what
    sums over images needs no second read for those without a mask. The rows of an image are swept in Arrow batches, from
    their texts; the batches carry only summed run ends from one to the next."""
    ns = len(sources)
    rows = _texts(sources, id_col, enc_col)
    names = [id_col, "col", "r0", "r1", "c", *[f"c{i}" for i in range(ns)]]
    schema = IB.schema_of(rows, [id_col], "col bigint, r0 bigint, r1 bigint, c int" + "".join(f", c{i} int" for i in range(ns)))

    def finish(keys, image, col, r0, r1, counts):
        none = np.zeros(keys.num_rows, np.int64)
        yield pa.RecordBatch.from_arrays([keys.column(0), *[pa.array(none)] * 3, *[pa.array(none, pa.int32())] * (ns + 1)], names=names)
        total = counts.sum(axis=1)

        def part(s):
            whole = [pa.array(x[s]) for x in (col, r0, r1)]
            return pa.RecordBatch.from_arrays([keys.column(0).take(pa.array(image[s])), *whole, *[pa.array(x[s], pa.int32()) for x in (total, *counts.T)]], names=names)

        yield from IB.in_slices(len(image), part)

    return _swept(rows, ns, height, width, id_col, finish, schema)


def _texts(sources: Sequence[DataFrame], id_col: str, enc_col: str) -> DataFrame:
    """The rows of all sources as ``(id, _src, _text)``."""
    rows = None
    for i, src in enumerate(sources):
        x = src.select(F.col(id_col), F.lit(i).alias("_src"), F.col(enc_col).alias("_text"))
        rows = x if rows is None else rows.unionByName(x)
    return rows


def _swept(rows: DataFrame, layers: int, height: int, width: int, id_col: str, finish, schema) -> DataFrame:
    """``finish`` on complete images of :func:`_texts`, one layer of counts a source."""
    def runs(batch):
        counts, a, b, _ = B.decode(batch.column("_text"), height * width)
        row = np.repeat(np.arange(batch.num_rows), counts)
        return row, a, b, batch.column("_src").to_numpy()[row], np.ones(len(row), np.int64)

    ship_package(rows.sparkSession)
    return IB.beside(rows, [id_col]).mapInArrow(lambda batches: IB.sweep(batches, [id_col], height, width, layers, runs, finish), schema)


def pixel_counts(sources: Sequence[DataFrame] | DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID, enc_col: str = ENC) -> DataFrame:
    """The segments of :func:`coverage_segments` added up where they are swept: ``(id, c, c0, c1, ..., pixels)``, the pixels of
    every image that have the same counts, and one row of zeros per image, so that images without a mask appear too."""
    sources = [sources] if isinstance(sources, DataFrame) else list(sources)
    ns = len(sources)
    rows = _texts(sources, id_col, enc_col)
    names = [id_col, "c", *[f"c{i}" for i in range(ns)], "pixels"]
    schema = IB.schema_of(rows, [id_col], "c int" + "".join(f", c{i} int" for i in range(ns)) + ", pixels bigint")

    def finish(keys, image, col, r0, r1, counts):
        # a number for every combination of counts, as small as they allow
        most = [int(x) + 1 for x in counts.max(axis=0)] if len(counts) else [1] * ns
        if keys.num_rows * math.prod(most) <= IB.MOST_OUT:
            which = np.stack(np.unravel_index(np.arange(math.prod(most)), most), axis=1)
            code = np.ravel_multi_index(tuple(counts.T), most) if len(counts) else image
        else:
            which, code = np.unique(counts, axis=0, return_inverse=True)
            code = code.reshape(-1)
        cell, where = np.unique(image * len(which) + code, return_inverse=True)
        pixels = np.bincount(where, weights=r1 - r0, minlength=len(cell)).astype(np.int64)  # far below 2**53: at most the canvas
        found = which[cell % len(which)]
        every = np.arange(keys.num_rows)
        own = [np.concatenate([np.zeros(len(every), np.int64), x]) for x in (found.sum(axis=1), *found.T)]
        yield pa.RecordBatch.from_arrays([keys.column(0).take(pa.array(np.concatenate([every, cell // len(which)]))), *[pa.array(x, pa.int32()) for x in own],
                                          pa.array(np.concatenate([np.zeros(len(every), np.int64), pixels]))], names=names)

    return _swept(rows, ns, height, width, id_col, finish, schema)


def packed_masks(sources: Sequence[DataFrame] | DataFrame, keep: Callable[[np.ndarray, np.ndarray], np.ndarray], height: int = CANVAS_H, width: int = CANVAS_W,
                 id_col: str = ID, enc_col: str = ENC) -> DataFrame:
    """Sweep and selection in one pass: ``(id, _runs, _wide, _mark)``, one row per image of any source with the packed runs of the
    pixels that ``keep(c, counts)`` selects, joined where they touch (``c`` rows cover a pixel, ``counts[:, i]`` of source ``i``).
    Images without such pixels have none. What follows works on whole masks, row by row: no piece is a row or is shuffled, and
    the sources are not read again for their ids. A value is bounded by the canvas."""
    sources = [sources] if isinstance(sources, DataFrame) else list(sources)
    rows = _texts(sources, id_col, enc_col)
    schema = IB.schema_of(rows, [id_col], "_runs binary, _wide boolean, _mark int")
    wide = height * width >= B.WIDE

    def finish(keys, image, col, r0, r1, counts):
        at = np.flatnonzero(keep(counts.sum(axis=1), counts))
        base = col[at] * height
        yield from IB.packed_images(keys, *IB.joined(image[at], base + r0[at], base + r1[at]), wide, id_col)

    return _swept(rows, len(sources), height, width, id_col, finish, schema)


def packed_strips(sources: Sequence[DataFrame] | DataFrame, keep: Callable[[np.ndarray, np.ndarray], np.ndarray], strip: int = 64, height: int = CANVAS_H, width: int = CANVAS_W,
                  id_col: str = ID, enc_col: str = ENC) -> DataFrame:
    """The selected pixels of :func:`packed_masks` as one row per image and strip of ``strip`` columns that has some:
    ``(id, _strip, _runs, _wide, _mark)``, ``_mark`` 0."""
    sources = [sources] if isinstance(sources, DataFrame) else list(sources)
    rows = _texts(sources, id_col, enc_col)
    names = [id_col, "_strip", "_runs", "_wide", "_mark"]
    schema = IB.schema_of(rows, [id_col], "_strip bigint, _runs binary, _wide boolean, _mark int")
    wide = height * width >= B.WIDE

    def finish(keys, image, col, r0, r1, counts):
        at = np.flatnonzero(keep(counts.sum(axis=1), counts))
        base = col[at] * height
        number = -(-width // strip)
        place, a, b = IB.joined(image[at] * number + col[at] // strip, base + r0[at], base + r1[at])
        head = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])[:len(place)]
        index = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(place)]))
        for some, own in IB.slices_of(len(head), index):
            n = some.stop - some.start
            packed = B.pack(np.bincount(index[own] - some.start, minlength=n), a[own], b[own], wide).cast(pa.binary())
            at = place[head[some]]
            yield pa.RecordBatch.from_arrays([keys.column(0).take(pa.array(at // number)), pa.array(at % number), packed, pa.array(np.full(n, wide)), pa.array(np.zeros(n, np.int32))], names=names)

    return _swept(rows, len(sources), height, width, id_col, finish, schema)


def packed_segments(annotations: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID, enc_col: str = ENC) -> DataFrame:
    """:func:`coverage_segments` of one source with the segments of an image and a count in one row: ``(id, c, _runs, _wide)``,
    ``_runs`` the packed runs (``rle_batch.pack``) of the pixels that ``c`` rows cover. A value is bounded by the canvas."""
    rows = annotations.select(F.col(id_col), F.col(enc_col).alias("_text"))
    schema = IB.schema_of(rows, [id_col], "c int, _runs binary, _wide boolean")

    def runs(batch):
        counts, a, b, _ = B.decode(batch.column("_text"), height * width)
        return np.repeat(np.arange(batch.num_rows), counts), a, b, np.zeros(len(a), np.int64), np.ones(len(a), np.int64)

    def finish(keys, image, col, r0, r1, counts):
        c = counts[:, 0]
        order = np.lexsort((c, image))  # stable: runs stay in order
        image, c, a, b = image[order], c[order], (col * height + r0)[order], (col * height + r1)[order]
        new = np.r_[True, (image[1:] != image[:-1]) | (c[1:] != c[:-1])][:len(image)]
        mask, head = np.cumsum(new) - 1, np.flatnonzero(new)
        for some, own in IB.slices_of(len(head), mask):
            wide = bool(b[own].max() >= B.WIDE)
            packed = B.pack(np.bincount(mask[own] - some.start, minlength=some.stop - some.start), a[own], b[own], wide).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([keys.column(0).take(pa.array(image[head[some]])), pa.array(c[head[some]], pa.int32()), packed, pa.array(np.full(len(packed), wide))],
                                             names=[id_col, "c", "_runs", "_wide"])

    ship_package(rows.sparkSession)
    return IB.beside(rows, [id_col]).mapInArrow(lambda batches: IB.sweep(batches, [id_col], height, width, 1, runs, finish), schema)


def coverage_histogram(segments: DataFrame) -> DataFrame:
    """A13 summary: covered pixels per coverage count, of segments or of their sums per image (:func:`pixel_counts`)."""
    n = F.col("pixels") if "pixels" in segments.columns else F.col("r1") - F.col("r0")
    return segments.filter(F.col("c") > 0).groupBy("c").agg(F.sum(n).cast("bigint").alias("pixels")).withColumnRenamed("c", "coverage")


def image_ids(df: DataFrame, id_col: str = ID) -> DataFrame:
    return df.select(id_col).distinct()


def label_raster_stats(annotations: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W,
                       ignore_label: int = SHIP_IGNORE_LABEL, id_col: str = ID) -> DataFrame:
    """M9: per image, pixels of the summed label raster by value: background 0, ship 1, ``ignore`` (2 for the ship
    dataset: doubly covered pixels are ignored in loss and evaluation) and ``error`` (>= 3, outside the class
    range). Every image appears, also those without ships (the sweep gives each a row of zeros)."""
    seg = pixel_counts(annotations, height, width, id_col)
    n = F.col("pixels")
    u = seg.select(
        id_col,
        F.when(F.col("c") == 1, n).otherwise(0).alias("ship"),
        F.when(F.col("c") == ignore_label, n).otherwise(0).alias("ign"),
        F.when(F.col("c") > ignore_label, n).otherwise(0).alias("err"),
        n.alias("cov"),
    )
    return u.groupBy(id_col).agg(
        (F.lit(height * width) - F.sum("cov")).cast("bigint").alias("background"),
        F.sum("ship").cast("bigint").alias("ship"),
        F.sum("ign").cast("bigint").alias("ignored"),
        F.sum("err").cast("bigint").alias("error"),
    )


def encode_pieces(pieces: DataFrame, height: int = CANVAS_H, id_col: str = ID,
                  keys: tuple[str, ...] = (), out: str = ENC, ids: DataFrame | None = None) -> DataFrame:
    """M6 + W5: disjoint column pieces -> one RLE text per ``(id, *keys)`` with maximal runs on the flat index
    (runs wrap across columns exactly like the reference's encoder). Group size is bounded by the canvas.

    With ``ids`` (no ``keys``): one row per row of ``ids``, as a left join of it to the texts -- a null text without pieces --
    made where the pieces meet, so that no text is shuffled. Pieces travel packed, a few bytes a run."""
    part = [id_col, *keys]
    rows = IB.with_ids(IB.packed_pieces(pieces, part, height), ids, id_col)
    return _encode(IB.beside(rows, part), part, out, ids is not None)


def encode_masks(masks: DataFrame, id_col: str = ID, out: str = ENC) -> DataFrame:
    """:func:`encode_pieces` with ``ids`` of whole masks (:func:`packed_masks`): one text per image, null without pixels. Each mask is
    in one row, so nothing is shuffled."""
    return _encode(masks, [id_col], out, True)


def _encode(rows: DataFrame, part: list[str], out: str, joined: bool) -> DataFrame:
    schema = IB.schema_of(rows, part, f"`{out}` string")

    def fn(batches):
        for key, marks, image, a, b in IB.complete(batches, part):
            counts = np.bincount(image, minlength=key.num_rows)
            for some, own in IB.slices_of(key.num_rows, image):
                k, n = key.slice(some.start, some.stop - some.start), counts[some]
                text = IB.texts(n, a[own], b[own])
                if joined:  # a null id meets no text
                    none = (n == 0) | key.column(0).is_null().to_numpy(zero_copy_only=False)[some]
                    text = pc.if_else(pa.array(none), pa.scalar(None, pa.string()), text)
                    again = pa.array(np.repeat(np.arange(len(n)), marks[some]))
                    k, text = k.take(again), text.take(again)
                yield pa.RecordBatch.from_arrays([*k.columns, text], names=[*part, out])

    ship_package(rows.sparkSession)
    return rows.mapInArrow(fn, schema)


def select_mask(segments: DataFrame, predicate, id_col: str = ID) -> DataFrame:
    """Pieces of the segments that satisfy a predicate on the counts (vote, union, intersection ...)."""
    return segments.filter(predicate).select(id_col, "col", "r0", "r1")


def mask_per_image(segments: DataFrame, predicate, ids: DataFrame, height: int = CANVAS_H, id_col: str = ID) -> DataFrame:
    """One RLE row per image for the pixels satisfying ``predicate``; images with nothing get a null row."""
    return encode_pieces(select_mask(segments, predicate, id_col), height, id_col, ids=ids)


def vote(sources: Sequence[DataFrame], k: int = 2, height: int = CANVAS_H, width: int = CANVAS_W,
         id_col: str = ID) -> DataFrame:
    """M4: pixels covered by at least ``k`` rows of the concatenated sources, one RLE row per image."""
    return encode_masks(packed_masks(sources, lambda c, by: c >= k, height, width, id_col), id_col)


def ids_of(sources: Sequence[DataFrame], id_col: str) -> DataFrame:
    u = None
    for s in sources:
        x = s.select(id_col).distinct()
        u = x if u is None else u.unionByName(x)
    return u.distinct()


def mask_setop(a: DataFrame, b: DataFrame, op: str, height: int = CANVAS_H, width: int = CANVAS_W,
               id_col: str = ID) -> DataFrame:
    """U3 (re-aimed): union, intersection or difference (a minus b) of two masks per image."""
    keep = {
        "union": lambda c, by: c > 0,
        "intersect": lambda c, by: (by[:, 0] > 0) & (by[:, 1] > 0),
        "difference": lambda c, by: (by[:, 0] > 0) & (by[:, 1] == 0),
    }[op]
    return encode_masks(packed_masks([a, b], keep, height, width, id_col), id_col)


def mask_iou(truth: DataFrame, pred: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W,
             id_col: str = ID) -> DataFrame:
    """M15 (re-aimed): per image, integer intersection and union of the truth and predicted masks and their IoU
    (null when both are empty). All images of either side appear."""
    seg = pixel_counts([truth, pred], height, width, id_col)
    n = F.col("pixels")
    rows = seg.select(
        id_col,
        F.when((F.col("c0") > 0) & (F.col("c1") > 0), n).otherwise(0).alias("inter"),
        n.alias("uni"),
        F.when(F.col("c0") > 0, n).otherwise(0).alias("t"),
        F.when(F.col("c1") > 0, n).otherwise(0).alias("p"),
    )
    g = rows.groupBy(id_col).agg(
        F.sum("inter").cast("bigint").alias("intersection"),
        F.sum("uni").cast("bigint").alias("union_px"),
        F.sum("t").cast("bigint").alias("truth_px"),
        F.sum("p").cast("bigint").alias("pred_px"),
    )
    return g.withColumn(
        "iou", F.when(F.col("union_px") > 0, F.round(F.col("intersection") / F.col("union_px"), 6))
    )


def horizontal_runs(pieces: DataFrame, id_col: str = ID, keep: tuple[str, ...] = (), height: int = CANVAS_H) -> DataFrame:
    """Row-wise maximal runs ``(id, *keep, row, c0, c1)`` (columns c0..c1 inclusive) of a mask given as column pieces,
    without going through pixels (``image_batches.rowwise_runs``). Pieces travel packed, and complete images are handled in
    one call."""
    part = [id_col, *keep]
    rows = IB.with_ids(IB.packed_pieces(pieces, part, height), None, id_col)
    schema = IB.schema_of(rows, part, "row bigint, c0 bigint, c1 bigint")
    def fn(batches):
        for keys, _, image, a, b in IB.complete(batches, part):
            for some, own in IB.slices_of(keys.num_rows, image):
                if own.stop > own.start:
                    im, row, c0, c1 = IB.rowwise_runs(image[own], a[own], b[own], height)
                    for s in range(0, len(im), IB.MOST_OUT):
                        t = slice(s, s + IB.MOST_OUT)
                        yield pa.RecordBatch.from_arrays([*[k.take(pa.array(im[t])) for k in keys.columns], *[pa.array(x[t]) for x in (row, c0, c1)]], names=[*part, "row", "c0", "c1"])

    ship_package(pieces.sparkSession)
    return IB.beside(rows, part).mapInArrow(fn, schema)
