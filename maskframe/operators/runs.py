"""Runs and pixels.

A *run* is a half-open interval ``[a, b)`` on the column-major flat index of an H x W canvas. Spatial operators
first cut runs at column boundaries into *pieces* ``(col, r0, r1)`` -- rows ``r0 .. r1-1`` of one column -- because
a run that wraps from the bottom of a column to the top of the next is one interval but not one spatial segment.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from maskframe.functions.classes import CANVAS_H, CANVAS_W
from maskframe.functions.rle_batch import WIDE, decode, mask_runs, pack
from maskframe.operators import image_batches as IB
from maskframe.session import ship_package

ID = "ImageId"
ENC = "EncodedPixels"
MOST_PIXELS = 1 << 16  # written out at once: they stay in a core's cache


def idiv(x: Column, n) -> Column:
    """Integer division for non-negative values."""
    return F.call_function("div", x, F.lit(n)).cast("bigint")


def rle_runs(df: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID, enc_col: str = ENC,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """M1: text -> one row per painted run ``(id, *keep, start0, len)``.

    Runs are what the reference paints for that row: clipped, and the union of the row's own runs (a row painting
    a pixel twice still covers it once). Rows with invalid tokens are left out (see ``annotations.quarantine``)."""
    r = df.select(id_col, *keep, F.explode(mask_runs(F.col(enc_col), height, width)).alias("r"))
    return r.select(id_col, *keep, F.col("r.a").alias("start0"), (F.col("r.b") - F.col("r.a")).alias("len"))


def run_pieces(runs: DataFrame, height: int = CANVAS_H, id_col: str = ID, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cut runs ``(start0, len)`` at column boundaries -> ``(id, *keep, col, r0, r1)``."""
    a = F.col("start0")
    b = F.col("start0") + F.col("len")
    x = runs.select(
        id_col, *keep, a.alias("a"), b.alias("b"),
        F.explode(F.sequence(idiv(a, height), idiv(b - 1, height))).alias("col"),
    )
    base = F.col("col") * height
    return x.select(
        id_col, *keep, "col",
        (F.greatest(F.col("a"), base) - base).alias("r0"),
        (F.least(F.col("b"), base + height) - base).alias("r1"),
    )


def pieces_to_runs(pieces: DataFrame, height: int = CANVAS_H, id_col: str = ID, keep: tuple[str, ...] = ()) -> DataFrame:
    """Inverse projection of :func:`run_pieces` (pieces stay separate; encoding merges them)."""
    base = F.col("col") * height
    return pieces.select(id_col, *keep, (base + F.col("r0")).alias("start0"), (F.col("r1") - F.col("r0")).alias("len"))


def rle_pixels(runs: DataFrame, height: int = CANVAS_H, id_col: str = ID, keep: tuple[str, ...] = ()) -> DataFrame:
    """M2: runs -> one row per pixel ``(id, *keep, row, col)``. Output is as large as the mask area; use only where a
    pixel-level step is unavoidable (90-degree rotation, resizing)."""
    p = runs.select(id_col, *keep, F.explode(F.sequence(F.col("start0"), F.col("start0") + F.col("len") - 1)).alias("p"))
    return p.select(id_col, *keep, (F.col("p") % height).alias("row"), idiv(F.col("p"), height).alias("col"))


def rle_pixel_sums(df: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID, enc_col: str = ENC) -> DataFrame:
    """M1 + M2 with the pixels summarised by image: ``(id, pixels, sum_row, sum_col)``, the sums over the rows of :func:`rle_pixels`
    of :func:`rle_runs`. Every pixel of every row is written out and split into row and column, in NumPy, where the texts of
    an Arrow batch are read; the pixels are added up there, ``MOST_PIXELS`` at a time, so that none of them is a row. A row
    paints a pixel once, rows add up, and an image without pixels has no row."""
    rows = df.select(F.col(id_col), F.col(enc_col).alias("_text"))
    size = height * width
    kind = np.int32 if size < WIDE else np.int64

    def fn(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(id_col).dictionary_encode(null_encoding="encode")
            counts, a, b, _ = decode(batch.column("_text"), size)
            image = np.repeat(ids.indices.to_numpy(), counts)
            image, a, b = short_runs(image, a, b)
            ends = np.cumsum(b - a)
            sums = np.zeros((3, len(ids.dictionary)), np.int64)
            lo = 0
            while lo < len(a):
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - (b[lo] - a[lo]) + MOST_PIXELS, side="right")))
                n = b[lo:hi] - a[lo:hi]
                first = np.cumsum(n) - n
                pixel = np.repeat((a[lo:hi] - first).astype(kind), n)
                pixel += np.arange(len(pixel), dtype=kind)
                col = pixel // kind(height)
                pixel -= col * kind(height)
                head = np.flatnonzero(np.r_[True, image[lo + 1:hi] != image[lo:hi - 1]])
                own = image[lo:hi][head]
                at = first[head]
                for k, of in enumerate((np.diff(np.r_[at, len(pixel)]), np.add.reduceat(pixel, at, dtype=np.int64), np.add.reduceat(col, at, dtype=np.int64))):
                    np.add.at(sums[k], own, of)
                lo = hi
            some = np.flatnonzero(sums[0])
            yield pa.RecordBatch.from_arrays([ids.dictionary.take(pa.array(some)), *[pa.array(x[some]) for x in sums]], names=[id_col, "pixels", "sum_row", "sum_col"])

    ship_package(df.sparkSession)
    parts = rows.mapInArrow(fn, IB.schema_of(rows, [id_col], "pixels bigint, sum_row bigint, sum_col bigint"))
    return parts.groupBy(id_col).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("pixels", "sum_row", "sum_col")])


def short_runs(image: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of more than ``MOST_PIXELS`` in several."""
    n = -(-(b - a) // MOST_PIXELS)
    if (n <= 1).all():
        return image, a, b
    i = np.repeat(np.arange(len(a)), n)
    lo = a[i] + MOST_PIXELS * (np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n))
    return image[i], lo, np.minimum(lo + MOST_PIXELS, b[i])


def flip_updown(pieces: DataFrame, height: int = CANVAS_H, id_col: str = ID, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flip around the horizontal axis; a column piece stays one piece (``row' = H-1-row``)."""
    return pieces.select(id_col, *keep, "col", (F.lit(height) - F.col("r1")).alias("r0"),
                         (F.lit(height) - F.col("r0")).alias("r1"))


def flipped_masks(masks: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID) -> DataFrame:
    """:func:`flip_updown` of whole masks (``coverage.packed_masks``), one row each."""
    return IB.moved_masks(masks, lambda image, col, r0, r1: (image, col, height - r1, height - r0), height, (height, width), id_col)


# fixed values: the augmentation rotates about this point, not the canvas centre (767/2)
ROTATION_CENTRE = (384, 384)


def rotate_180(pieces: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID,
               keep: tuple[str, ...] = (), centre=ROTATION_CENTRE) -> DataFrame:
    """M11 (180 degrees) about ``centre``: ``(x, y) -> (2cx - x, 2cy - y)``; pixels leaving the canvas are lost and
    the first row / column stay empty. Stays on pieces (no pixel explosion)."""
    cx, cy = centre
    ncol = F.lit(2 * cx) - F.col("col")
    r0 = F.greatest(F.lit(2 * cy + 1) - F.col("r1"), F.lit(0))
    r1 = F.least(F.lit(2 * cy + 1) - F.col("r0"), F.lit(height))
    out = pieces.select(id_col, *keep, ncol.alias("col"), r0.alias("r0"), r1.alias("r1"))
    return out.filter((F.col("col") >= 0) & (F.col("col") < width) & (F.col("r1") > F.col("r0")))


def rotate_90(pieces: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID,
              keep: tuple[str, ...] = (), centre=ROTATION_CENTRE) -> DataFrame:
    """M11 (90 degrees, counter-clockwise as OpenCV's positive angle) about ``centre``:
    ``(x, y) -> (y + cx - cy, cx + cy - x)``. A row-wise run of the source (row r, columns c0..c1) is exactly one
    column piece of the result (column r + cx - cy, rows cx + cy - c1 .. cx + cy - c0), so the rotation is computed
    from :func:`coverage.horizontal_runs` without exploding pixels."""
    from maskframe.operators.coverage import horizontal_runs

    cx, cy = centre
    h = horizontal_runs(pieces.select(id_col, *keep, "col", "r0", "r1"), id_col, keep, height)
    out = h.select(
        id_col, *keep,
        (F.col("row") + F.lit(cx - cy)).alias("col"),
        F.greatest(F.lit(cx + cy) - F.col("c1"), F.lit(0)).alias("r0"),
        F.least(F.lit(cx + cy + 1) - F.col("c0"), F.lit(height)).alias("r1"),
    )
    return out.filter((F.col("col") >= 0) & (F.col("col") < width) & (F.col("r1") > F.col("r0")))


def rotated_masks(masks: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID, centre=ROTATION_CENTRE) -> DataFrame:
    """:func:`rotate_90` of whole masks (``coverage.packed_masks``), one row each."""
    cx, cy = centre

    def move(image, col, r0, r1):
        base = col * height
        image, row, c0, c1 = IB.rowwise_runs(image, base + r0, base + r1, height)
        to, r0, r1 = row + (cx - cy), np.maximum(cx + cy - c1, 0), np.minimum(cx + cy + 1 - c0, height)
        inside = np.flatnonzero((to >= 0) & (to < width) & (r1 > r0))
        return image[inside], to[inside], r0[inside], r1[inside]

    return IB.moved_masks(masks, move, height, (height, width), id_col)


def augmented(pieces: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID,
              keep: tuple[str, ...] = (), centre=ROTATION_CENTRE) -> DataFrame:
    """I17 on masks: ``(id, suffix, *keep, col, r0, r1)`` of every image in its four variants -- as it is, turned by 180
    (``_a``) and 90 degrees (``_b``) about ``centre``, upside down (``_f``). Three of them move pieces and are made in one pass;
    a variant that loses all its pixels keeps one empty piece (``r0 = r1``), so no image with pieces is lost."""
    cx, cy = centre
    r0, r1, h = F.col("r0"), F.col("r1"), F.lit(height)

    def variant(suffix, col, a, b):
        inside = (col >= 0) & (col < width) & (b > a)
        return F.struct(F.lit(suffix).alias("suffix"), F.when(inside, col).otherwise(F.lit(0)).cast("bigint").alias("col"),
                        F.when(inside, a).otherwise(F.lit(0)).cast("bigint").alias("r0"), F.when(inside, b).otherwise(F.lit(0)).cast("bigint").alias("r1"))

    moved = F.array(
        variant("", F.col("col"), r0, r1),
        variant("_a", F.lit(2 * cx) - F.col("col"), F.greatest(F.lit(2 * cy + 1) - r1, F.lit(0)), F.least(F.lit(2 * cy + 1) - r0, h)),
        variant("_b", F.lit(0), F.lit(0), F.lit(0)),
        variant("_f", F.col("col"), h - r1, h - r0),
    )
    three = pieces.select(id_col, *keep, F.explode(moved).alias("v")).select(id_col, "v.suffix", *keep, "v.col", "v.r0", "v.r1")
    turned = rotate_90(pieces, height, width, id_col, keep, centre)
    return three.unionByName(turned.select(id_col, F.lit("_b").alias("suffix"), *keep, *[F.col(c).cast("bigint").alias(c) for c in ("col", "r0", "r1")]))


def augmented_masks(masks: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID,
                    keep: tuple[str, ...] = (), centre=ROTATION_CENTRE) -> DataFrame:
    """:func:`augmented` of whole masks ``(id, *keep, _runs, _wide)`` (``coverage.packed_segments``), one row each:
    ``(id, suffix, *keep, _runs, _wide, pixels)``, four rows per mask with the turned runs packed and their number of pixels. All four
    variants are made in one pass over an Arrow batch of masks; no piece is a row, and nothing is shuffled. A variant
    that loses all its pixels is an empty mask."""
    cx, cy = centre
    part = [id_col, *keep]
    names = [id_col, "suffix", *keep, "_runs", "_wide", "pixels"]
    plain = masks.select(*part, "_runs", "_wide")
    first, rest = IB.schema_of(plain, [id_col], "suffix string"), IB.schema_of(plain, keep, "_runs binary, _wide boolean, pixels bigint")
    size = height * width
    wide = size >= WIDE

    def moved(mask, a, b):
        i, col, r0, r1 = IB.cut_columns(a, b, height)
        i = mask[i]
        yield "", i, col, r0, r1
        yield "_a", i, 2 * cx - col, 2 * cy + 1 - r1, 2 * cy + 1 - r0
        m, row, c0, c1 = IB.rowwise_runs(mask, a, b, height)
        yield "_b", m, row + (cx - cy), cx + cy - c1, cx + cy + 1 - c0
        yield "_f", i, col, height - r1, height - r0

    def fn(batches):
        for batch in batches:
            mask, a, b = IB.packed_rows(batch)
            for some, own in IB.slices_of(batch.num_rows, mask):
                n = some.stop - some.start
                keys = [batch.column(c).slice(some.start, n) for c in part]
                for suffix, m, col, r0, r1 in moved(mask[own] - some.start, a[own], b[own]):
                    r0, r1 = np.maximum(r0, 0), np.minimum(r1, height)
                    inside = (col >= 0) & (col < width) & (r1 > r0)
                    m, x, y = m[inside], (col * height + r0)[inside], (col * height + r1)[inside]
                    place = m * size + x
                    if (place[1:] < place[:-1]).any():
                        order = np.argsort(place, kind="stable")
                        m, x, y = m[order], x[order], y[order]
                    counts = np.bincount(m, minlength=n)
                    total = np.concatenate([[0], np.cumsum(y - x)])
                    ends = np.cumsum(counts)
                    yield pa.RecordBatch.from_arrays([keys[0], pa.array([suffix] * n, pa.string()), *keys[1:], pack(counts, x, y, wide).cast(pa.binary()), pa.array(np.full(n, wide)),
                                                      pa.array(total[ends] - total[ends - counts])], names=names)

    ship_package(masks.sparkSession)
    return plain.mapInArrow(fn, StructType(first.fields + rest.fields))


def rotate_90_pixels(pieces: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID,
                     keep: tuple[str, ...] = (), centre=ROTATION_CENTRE) -> DataFrame:
    """M11 (90 degrees) through pixels of the rotated mask, regrouped into column pieces (W5); the reference form
    :func:`rotate_90` is checked against."""
    cx, cy = centre
    px = pieces.select(id_col, *keep, "col", F.explode(F.sequence(F.col("r0"), F.col("r1") - 1)).alias("row"))
    rot = px.select(
        id_col, *keep,
        (F.col("row") + F.lit(cx - cy)).alias("col"),
        (F.lit(cx + cy) - F.col("col")).alias("row"),
    ).filter((F.col("col") >= 0) & (F.col("col") < width) & (F.col("row") >= 0) & (F.col("row") < height))
    return pixels_to_pieces(rot, id_col=id_col, keep=keep)


def pixels_to_pieces(pixels: DataFrame, id_col: str = ID, keep: tuple[str, ...] = ()) -> DataFrame:
    """Distinct pixels ``(id, *keep, row, col)`` -> maximal column pieces by gaps-and-islands
    (``row - row_number()`` is constant along a vertical run). Partitioned by (id, col): at most H rows per window
    partition, so a hot image is spread over its columns."""
    part = [id_col, *keep, "col"]
    w = Window.partitionBy(*part).orderBy("row")
    g = pixels.withColumn("g", F.col("row") - F.row_number().over(w))
    return g.groupBy(*part, "g").agg(F.min("row").alias("r0"), (F.max("row") + 1).alias("r1")).drop("g")
