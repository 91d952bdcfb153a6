"""Connected components of masks and per-instance re-encoding.

The mask arrives as disjoint column pieces ``(id, col, r0, r1)`` from the coverage sweep. Images are labelled many at a
time in Arrow batches; an image holds at most ``W * ceil(H/2)`` pieces however many annotation rows it had, so one image is
bounded by the canvas. Inside a batch everything is NumPy on
pieces (never pixels): 8-neighbour edges between adjacent columns come from two ``searchsorted`` calls, labels from
vectorised hook-and-compress rounds.

Instance numbers follow the raster order of each component's first pixel (row-major), as ``label`` + ``np.unique``
number them in the reference.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskframe.functions import rle_batch as B
from maskframe.functions.classes import CANVAS_H, CANVAS_W
from maskframe.operators import image_batches as IB
from maskframe.session import ship_package

ID = "ImageId"
ENC = "EncodedPixels"


def label_pieces(col: np.ndarray, r0: np.ndarray, r1: np.ndarray, height: int, width: int):
    """:func:`label_pieces_batch` for one image: merged pieces ``(col, r0, r1)`` and their instance numbers."""
    _, c, a, b, inst = label_pieces_batch(np.zeros(len(col), np.int64), col, r0, r1, height, width)
    return c, a, b, inst


def _encode_all(inst, col, r0, r1, height):
    """Maximal flat runs of every instance at once -> (instance ids, RLE texts)."""
    a = col * height + r0
    b = col * height + r1
    order = np.lexsort((a, inst))
    inst, a, b = inst[order], a[order], b[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (inst[1:] != inst[:-1]) | (a[1:] != b[:-1])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(a)) - 1
    rs, rn, ri = a[starts] + 1, b[ends] - a[starts], inst[starts]
    cut = np.flatnonzero(np.diff(ri)) + 1
    texts = [" ".join(f"{x} {y}" for x, y in zip(s_.tolist(), n_.tolist()))
             for s_, n_ in zip(np.split(rs, cut), np.split(rn, cut))]
    return np.unique(ri), texts


def connected_components(pieces: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID) -> DataFrame:
    """M5 + W8: ``(id, col, r0, r1)`` -> ``(id, instance_id, col, r0, r1)``."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        c, a, b, inst = label_pieces(pdf["col"].to_numpy(), pdf["r0"].to_numpy(), pdf["r1"].to_numpy(), height, width)
        return pd.DataFrame({id_col: pdf[id_col].iloc[0], "instance_id": inst, "col": c, "r0": a, "r1": b})

    ship_package(pieces.sparkSession)
    schema = f"`{id_col}` string, instance_id bigint, col bigint, r0 bigint, r1 bigint"
    p = pieces.select(id_col, F.col("col").cast("bigint"), F.col("r0").cast("bigint"), F.col("r1").cast("bigint"))
    return p.groupBy(id_col).applyInPandas(fn, schema)


def component_stats(pieces: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID) -> DataFrame:
    """Per component: pixel count and the raster position of its first pixel, measured where the image is labelled."""

    def frame(ids, marks, image, col, r0, r1) -> pa.RecordBatch:
        im, c, a, b, inst = label_pieces_batch(image, col, r0, r1, height, width)
        order = np.lexsort((a * width + c, inst, im))
        im, c, a, b, inst = im[order], c[order], a[order], b[order], inst[order]
        head = np.flatnonzero(np.r_[True, (im[1:] != im[:-1]) | (inst[1:] != inst[:-1])]) if len(im) else im
        pixels = np.add.reduceat(b - a, head) if len(im) else im
        return pa.RecordBatch.from_arrays([ids.take(pa.array(im[head])), *map(pa.array, (inst[head], pixels, (a * width + c)[head]))], names=[id_col, "instance_id", "pixels", "first_pixel"])

    return _batched(pieces, frame, f"`{id_col}` string, instance_id bigint, pixels bigint, first_pixel bigint", id_col, height)


def multi_rle(pieces: DataFrame, ids: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W,
              id_col: str = ID, batched: bool = True) -> DataFrame:
    """M7: one RLE row per component; an image with no component gets one ``(id, null)`` row (J9 left join).

    Labelling and encoding happen in the same per-image group, so the components are never re-shuffled."""
    if batched:
        return multi_rle_batched(pieces, ids, height, width, id_col)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        c, a, b, inst = label_pieces(pdf["col"].to_numpy(), pdf["r0"].to_numpy(), pdf["r1"].to_numpy(), height, width)
        ks, texts = _encode_all(inst, c, a, b, height)
        return pd.DataFrame({id_col: pdf[id_col].iloc[0], "instance_id": ks, ENC: texts}, columns=[id_col, "instance_id", ENC])

    ship_package(pieces.sparkSession)
    schema = f"`{id_col}` string, instance_id bigint, `{ENC}` string"
    p = pieces.select(id_col, F.col("col").cast("bigint"), F.col("r0").cast("bigint"), F.col("r1").cast("bigint"))
    enc = p.groupBy(id_col).applyInPandas(fn, schema)
    return ids.join(enc, id_col, "left")


def multi_rle_grouped(pieces: DataFrame, ids: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W,
                      id_col: str = ID) -> DataFrame:
    """M7 with one ``applyInPandas`` group per image (simple form; the batched form is the default)."""
    return multi_rle(pieces, ids, height, width, id_col, batched=False)


def instances_per_image(pieces: DataFrame, ids: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W,
                        id_col: str = ID) -> DataFrame:
    """Number of connected instances per image (0 when none)."""
    st = component_stats(pieces, height, width, id_col).groupBy(id_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("instances")
    )
    return ids.join(st, id_col, "left").select(id_col, F.coalesce("instances", F.lit(0)).cast("bigint").alias("instances"))


# ---- batched form: many images per Python call ---------------------------------------------------------------------
def label_pieces_batch(img: np.ndarray, col: np.ndarray, r0: np.ndarray, r1: np.ndarray, height: int, width: int):
    """Labels the 8-connected components of disjoint column pieces of many images at once (``img`` = dense image index).
    Images are laid side by side with two empty columns between them, so no edge crosses images; instance numbers
    restart at 1 in every image (raster order of the first pixel)."""
    if not len(col):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    gcol = img.astype(np.int64) * (width + 2) + col.astype(np.int64)
    c, a, b, _ = None, None, None, None
    order = np.lexsort((r0, gcol))
    gcol, r0, r1 = gcol[order], r0.astype(np.int64)[order], r1.astype(np.int64)[order]
    new = np.ones(len(gcol), dtype=bool)
    new[1:] = ~((gcol[1:] == gcol[:-1]) & (r0[1:] <= r1[:-1]))
    starts = np.flatnonzero(new)
    gcol, r0, r1 = gcol[starts], r0[starts], np.maximum.reduceat(r1, starts)
    m = len(gcol)
    stride = height + 2
    key0, key1 = gcol * stride + r0, gcol * stride + r1
    prev = (gcol - 1) * stride
    lo = np.searchsorted(key1, prev + r0, side="left")
    hi = np.searchsorted(key0, prev + r1, side="right")
    cnt = np.maximum(hi - lo, 0)
    u = np.repeat(np.arange(m), cnt)
    v = np.repeat(lo, cnt) + (np.arange(len(u)) - np.repeat(np.cumsum(cnt) - cnt, cnt)) if len(u) else u
    lab = np.arange(m)
    while len(u):
        lu, lv = lab[u], lab[v]
        if np.array_equal(lu, lv):
            break
        mn = np.minimum(lu, lv)
        np.minimum.at(lab, lu, mn)
        np.minimum.at(lab, lv, mn)
        while True:
            nxt = lab[lab]
            if np.array_equal(nxt, lab):
                break
            lab = nxt
    im = gcol // (width + 2)
    c = gcol - im * (width + 2)
    first = r0 * width + c
    root_first = np.full(m, np.iinfo(np.int64).max, dtype=np.int64)
    np.minimum.at(root_first, lab, first)
    comp = np.unique(lab)  # one entry per component, ordered by (image, first pixel) below
    ck = np.lexsort((root_first[comp], im[comp]))
    comp_sorted = comp[ck]
    comp_img = im[comp_sorted]
    start_of_img = np.ones(len(comp_sorted), dtype=bool)
    start_of_img[1:] = comp_img[1:] != comp_img[:-1]
    idx = np.arange(len(comp_sorted))
    base = np.maximum.accumulate(np.where(start_of_img, idx, 0))
    rank = np.empty(m, dtype=np.int64)
    rank_of_comp = np.empty(len(comp_sorted), dtype=np.int64)
    rank_of_comp[:] = idx - base + 1
    lookup = np.full(m, -1, dtype=np.int64)
    lookup[comp_sorted] = rank_of_comp
    rank[:] = lookup[lab]
    return im, c, r0, r1, rank


def _batched(pieces: DataFrame, frame_fn, schema: str, id_col: str, height: int, partitions: int | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Stream images through ``mapInArrow``: pieces travel packed, the rows of an image (and of ``ids``, which mark those that
    have none) stand together, and the complete images of a batch are handled in one vectorised call
    ``frame_fn(ids, marks, image, col, r0, r1)``. Memory per task: one batch plus one image (bounded by the canvas)."""

    rows = IB.with_ids(IB.packed_pieces(pieces, [id_col], height), ids, id_col)
    if partitions:
        rows = rows.repartition(partitions, id_col)
    return _on_masks(IB.beside(rows, [id_col]), frame_fn, schema, id_col, height)


def _on_masks(rows: DataFrame, frame_fn, schema: str, id_col: str, height: int) -> DataFrame:
    """``frame_fn(ids, marks, image, col, r0, r1)`` on the complete images of packed rows that stand together."""
    def fn(batches):
        for keys, marks, image, a, b in IB.complete(batches, [id_col]):
            for some, own in IB.slices_of(keys.num_rows, image):
                i, col, r0, r1 = IB.cut_columns(a[own], b[own], height)
                yield frame_fn(keys.column(0)[some.start:some.stop], marks[some], image[own][i] - some.start, col, r0, r1)

    ship_package(rows.sparkSession)
    return rows.mapInArrow(fn, schema)


def connected_components_batched(pieces: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID,
                                 partitions: int | None = None) -> DataFrame:
    """M5 + W8, many images per Python call: ``(id, col, r0, r1)`` -> ``(id, instance_id, col, r0, r1)``."""

    def frame(ids, marks, image, col, r0, r1) -> pa.RecordBatch:
        im, c, a, b, inst = label_pieces_batch(image, col, r0, r1, height, width)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(im)), *map(pa.array, (inst, c, a, b))], names=[id_col, "instance_id", "col", "r0", "r1"])

    return _batched(pieces, frame, f"`{id_col}` string, instance_id bigint, col bigint, r0 bigint, r1 bigint", id_col, height, partitions)


def multi_rle_batched(pieces: DataFrame, ids: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W,
                      id_col: str = ID, partitions: int | None = None) -> DataFrame:
    """M7, many images per Python call (see :func:`_batched`), as a left join of ``ids`` to the components; it is made where the
    pieces of an image meet, so that no text is shuffled."""

    return _batched(pieces, _texts_of(height, width, id_col), f"`{id_col}` string, instance_id bigint, `{ENC}` string", id_col, height, partitions, ids)


def multi_rle_masks(masks: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID) -> DataFrame:
    """M7 of whole masks (``coverage.packed_masks``), with one null row for an image without components. A mask is one row, so
    nothing is shuffled."""
    return _on_masks(masks, _texts_of(height, width, id_col), f"`{id_col}` string, instance_id bigint, `{ENC}` string", id_col, height)


def instances_of_masks(masks: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID) -> DataFrame:
    """A14 of whole masks (``coverage.packed_masks``): a row per image, 0 without components."""

    def frame(ids, marks, image, col, r0, r1) -> pa.RecordBatch:
        im, _, _, _, inst = label_pieces_batch(image, col, r0, r1, height, width)
        n = np.zeros(len(ids), np.int64)
        np.maximum.at(n, im, inst)  # numbers run from 1
        n[ids.is_null().to_numpy(zero_copy_only=False)] = 0  # a null id meets nothing
        again = pa.array(np.repeat(np.arange(len(ids)), marks))
        return pa.RecordBatch.from_arrays([ids.take(again), pa.array(n).take(again)], names=[id_col, "instances"])

    return _on_masks(masks, frame, f"`{id_col}` string, instances bigint", id_col, height)


def _texts_of(height: int, width: int, id_col: str):
    def frame(ids_, marks, image, col, r0, r1) -> pa.RecordBatch:
        null = ids_.is_null().to_numpy(zero_copy_only=False)
        im, c, a, b, inst = label_pieces_batch(image, col, r0, r1, height, width)
        keep = ~null[im] & (marks[im] > 0)  # a null id meets nothing
        key, lo, hi = (im * (1 << 32) + inst)[keep], (c * height + a)[keep], (c * height + b)[keep]
        order = np.lexsort((lo, key))
        key, lo, hi = key[order], lo[order], hi[order]
        head = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (lo[1:] != hi[:-1])]) if len(key) else key
        key, lo, hi = key[head], lo[head], hi[np.r_[head[1:], len(hi)] - 1] if len(head) else hi
        ks, counts = np.unique(key, return_counts=True)
        at, number = ks >> 32, ks & ((1 << 32) - 1)
        none = np.setdiff1d(np.arange(len(ids_)), at)
        again, more = marks[at], marks[none]
        text = IB.texts(counts, lo, hi).take(pa.array(np.repeat(np.arange(len(ks)), again)))
        rows = np.concatenate([np.repeat(at, again), np.repeat(none, more)])
        nulls = int(more.sum())
        number = pa.concat_arrays([pa.array(np.repeat(number, again), pa.int64()), pa.nulls(nulls, pa.int64())])
        return pa.RecordBatch.from_arrays([ids_.take(pa.array(rows)), number, pa.concat_arrays([text, pa.nulls(nulls, pa.string())])], names=[id_col, "instance_id", ENC])

    return frame


# ---- table form: an image of any size, over many tasks ---------------------------------------------------------------
def packed_strips(pieces: DataFrame, height: int, strip: int, id_col: str = ID) -> DataFrame:
    """Pieces as packed rows ``(id, _strip, _runs, _wide, _mark)``, those of a strip of ``strip`` columns beside each other."""
    part = [id_col, "_strip"]
    x = pieces.select(id_col, F.floor(F.col("col") / strip).cast("bigint").alias("_strip"), "col", "r0", "r1")
    return IB.beside(IB.with_ids(IB.packed_pieces(x, part, height), None, id_col), part)


def strip_components(strips: DataFrame, height: int, strip: int, id_col: str = ID) -> DataFrame:
    """``(id, root, _runs, _wide, _border)`` of :func:`packed_strips` (or ``coverage.packed_strips``), one row per component of a strip of ``strip`` columns: its first pixel
    ``struct(id, row, col)``, its packed runs and its pieces ``struct(col, r0, r1)`` in the strip's first and last column (pieces that
    touch within a column merged). A strip of an image is at most ``strip * ceil(H / 2)`` pieces; many are labelled in one
    NumPy call."""
    part = [id_col, "_strip"]
    rows = strips.withColumn(id_col, F.col(id_col).cast("string"))  # all columns: without its count the window would go

    def fn(batches):
        for keys, _, image, a, b in IB.complete(batches, part):
            for some, own in IB.slices_of(keys.num_rows, image):
                if own.stop == own.start:
                    continue
                i, col, r0, r1 = IB.cut_columns(a[own], b[own], height)
                im, c, r0, r1, inst = label_pieces_batch(image[own][i] - some.start, col % strip, r0, r1, height, strip)
                place = c + keys.column("_strip").slice(some.start, some.stop - some.start).to_numpy()[im] * strip
                group = im * (int(inst.max()) + 1) + inst
                lead = np.lexsort((c, r0, group))  # the first pixel in raster order
                lead = lead[np.r_[True, group[lead][1:] != group[lead][:-1]]]
                order = np.lexsort((r0, c, group))
                group, c, place, r0, r1 = group[order], c[order], place[order], r0[order], r1[order]
                counts = np.diff(np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)])
                lo, hi = place * height + r0, place * height + r1
                wide = bool(hi.max() >= B.WIDE)
                edge = np.flatnonzero((c == 0) | (c == strip - 1))
                off = np.searchsorted(edge, np.r_[0, np.cumsum(counts)]).astype(np.int32)
                border = pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays([pa.array(v[edge]) for v in (place, r0, r1)], ["col", "r0", "r1"]))
                ids, n = keys.column(0).take(pa.array(some.start + im[lead])), len(lead)
                first = order.argsort()[lead]
                yield pa.RecordBatch.from_arrays([ids, pa.array(r0[first]), pa.array(place[first]), B.pack(counts, lo, hi, wide).cast(pa.binary()), pa.array(np.full(n, wide)), border],
                                                 names=[id_col, "row0", "col0", "_runs", "_wide", "_border"])

    ship_package(strips.sparkSession)
    out = rows.mapInArrow(fn, f"`{id_col}` string, row0 bigint, col0 bigint, _runs binary, _wide boolean, _border array<struct<col: bigint, r0: bigint, r1: bigint>>")
    return out.select(id_col, F.struct(F.col(id_col).alias("id"), F.col("row0").alias("row"), F.col("col0").alias("col")).alias("root"), "_runs", "_wide", "_border")


def unpacked_pieces(rows: DataFrame, keep: list[str], height: int) -> DataFrame:
    """``(*keep, col, r0, r1)``: the column pieces of packed rows ``(*keep, _runs, _wide)``."""
    rows = rows.select(*keep, "_runs", "_wide")

    def fn(batches):
        for batch in batches:
            row, a, b = IB.packed_rows(batch)
            for some, own in IB.slices_of(batch.num_rows, row):
                i, col, r0, r1 = IB.cut_columns(a[own], b[own], height)
                at = pa.array(row[own][i])
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in keep], *map(pa.array, (col, r0, r1))], names=[*keep, "col", "r0", "r1"])

    ship_package(rows.sparkSession)
    return rows.mapInArrow(fn, IB.schema_of(rows, keep, "col bigint, r0 bigint, r1 bigint"))


def touching_strips(labelled: DataFrame, strip: int, row_bin: int = 512, id_col: str = ID) -> DataFrame:
    """Links ``(a, b)`` between components of neighbouring strips whose pieces touch at a side or a corner: an equi join of the
    strips' border columns on (image, column, bin of rows), each pair of pieces in the one bin where it meets first."""
    bins = F.sequence(F.floor(F.col("r0") / row_bin), F.floor(F.col("r1") / row_bin))
    p = labelled.select(F.col(id_col).alias("_id"), "col", "r0", "r1", "root", F.explode(bins).alias("bin"))
    left = p.filter(F.col("col") % strip == strip - 1).select("_id", F.col("col").alias("c"), F.col("r0").alias("a0"), F.col("r1").alias("a1"), F.col("root").alias("a"), "bin")
    right = p.filter(F.col("col") % strip == 0).select(F.col("_id").alias("_id2"), (F.col("col") - 1).alias("c2"), F.col("r0").alias("b0"), F.col("r1").alias("b1"), F.col("root").alias("b"), F.col("bin").alias("bin2"))
    on = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("c") == F.col("c2")) & (F.col("bin") == F.col("bin2"))
    on = on & (F.col("a0") <= F.col("b1")) & (F.col("b0") <= F.col("a1"))
    return left.join(right, on).filter(F.col("bin") == F.floor(F.greatest("a0", "b0") / row_bin)).select("a", "b")


def connected_components_tables(pieces: DataFrame, height: int = CANVAS_H, id_col: str = ID, strip: int = 64, row_bin: int = 512, band: int = 64) -> DataFrame:
    """M5 + W8 for canvases that no single task may hold: ``(id, col, r0, r1)`` -> ``(id, instance_id, col, r0, r1)``, as
    :func:`connected_components` numbers them (pieces that touch within a column come back as one; ids are text).

    Strips of ``strip`` columns are labelled each for itself, and a component of a strip is one row with its pieces packed; only what touches across a strip's border becomes an edge, and
    the edges' components come from the star contraction of :mod:`maskframe.operators.graph`. Components are numbered in
    raster order by bands of ``band`` rows and the number of components in the bands before. No step has an image, or a
    component, in one task."""
    return connected_components_strips(packed_strips(pieces, height, strip, id_col), height, id_col, strip, row_bin, band)


def connected_components_strips(strips: DataFrame, height: int = CANVAS_H, id_col: str = ID, strip: int = 64, row_bin: int = 512, band: int = 64) -> DataFrame:
    """:func:`connected_components_tables` of masks that are packed by strip already (``coverage.packed_strips``)."""
    from maskframe.operators.graph import connected_components as of_edges
    from maskframe.session import saved

    p = saved(strip_components(strips, height, strip, id_col), "strips")
    near = F.size("_border") > 0  # only these can have a link
    borders = p.filter(near).select(id_col, "root", F.explode("_border").alias("b")).select(id_col, "b.col", "b.r0", "b.r1", "root")
    top = of_edges(touching_strips(borders, strip, row_bin, id_col)).select(F.col("node").alias("root"), F.col("root").alias("_top"))
    linked = p.filter(near).join(top, "root", "left").select(id_col, F.coalesce("_top", "root").alias("_root"), "_runs", "_wide")
    j = saved(linked.unionByName(p.filter(~near).select(id_col, F.col("root").alias("_root"), "_runs", "_wide")), "labelled")
    roots = j.select("_root").distinct().select("_root", F.col("_root.id").alias("_id"), F.floor(F.col("_root.row") / band).alias("_band"), "_root.row", "_root.col")
    counts = roots.groupBy("_id", "_band").agg(F.count(F.lit(1)).alias("_n"))
    up = Window.partitionBy("_id").orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_id").alias("_id2"), F.col("_band").alias("_band2"), F.coalesce(F.sum("_n").over(up), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_id", "_band").orderBy("row", "col")
    on = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_band") == F.col("_band2"))
    numbered = roots.withColumn("_in", F.row_number().over(inside)).join(starts, on).select("_root", (F.col("_start") + F.col("_in")).cast("bigint").alias("instance_id"))
    return unpacked_pieces(j.join(numbered, "_root"), [id_col, "instance_id"], height)
