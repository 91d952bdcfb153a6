"""Tiling of masks.

The range join "each tile x each mask" is expressed without a join: a tile grid is n x n boxes whose 1-D ranges are
the same for x and y, so every coverage segment (one column, a row range) finds its boxes by filtering the literal
array of the n ranges -- at most 2 x 3 candidates for the 256 / 128 grids -- and is exploded into them. No nested
loop, no broadcast, no shuffle until the per-(image, tile) sum, which is partially aggregated on the map side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskframe.functions import rle_batch as B
from maskframe.functions.classes import CANVAS_H, CANVAS_W
from maskframe.functions.names import sample_name
from maskframe.operators import image_batches as IB
from maskframe.session import ship_package

ID = "ImageId"
ENC = "EncodedPixels"


def tile_centers(resize: int, n: int, size: int = 256) -> list[int]:
    """``n`` centres along one axis, spread evenly from the first box at the left edge to the last at the right edge;
    (512, 3), (768, 5) and (1024, 7) all give a stride of 128."""
    return [size // 2 + i * (resize - size) // max(n - 1, 1) for i in range(n)]


def tile_ranges(resize: int, n: int, size: int = 256) -> list[tuple[int, int, int]]:
    half = size // 2
    return [(i, c - half, c + half) for i, c in enumerate(tile_centers(resize, n, size))]


def tile_grid(spark: SparkSession, resize: int, n: int, size: int = 256) -> DataFrame:
    """``(tile, x0, y0, x1, y1)`` with ``tile = iy * n + ix`` (n*n rows)."""
    r = tile_ranges(resize, n, size)
    rows = [(iy * n + ix, x0, y0, x1, y1) for iy, y0, y1 in r for ix, x0, x1 in r]
    return spark.createDataFrame(rows, "tile int, x0 int, y0 int, x1 int, y1 int")


def _ranges_literal(resize: int, n: int, size: int):
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
                     for i, lo, hi in tile_ranges(resize, n, size)])


def tile_overlap(segments: DataFrame, resize: int, n: int, size: int = 256, id_col: str = ID,
                 value_col: str | None = "c", force_literal: bool = False) -> DataFrame:
    """Per (image, tile), the sum of mask values inside the box (``mask_area``), for tiles that overlap the
    mask. ``segments`` are column pieces ``(id, col, r0, r1[, value])`` on a ``resize`` x ``resize`` canvas."""
    v = F.col(value_col) if value_col else F.lit(1)
    r = tile_ranges(resize, n, size)
    steps = {r[i + 1][1] - r[i][1] for i in range(len(r) - 1)}
    if len(steps) == 1 and r[0][1] == 0 and not force_literal:
        return _tile_overlap_uniform(segments, n, size, steps.pop(), id_col, v)
    rng = _ranges_literal(resize, n, size)
    x = segments.select(
        id_col, "r0", "r1", v.alias("v"),
        F.explode(F.filter(rng, lambda b: (b["lo"] <= F.col("col")) & (F.col("col") < b["hi"]))).alias("bx"),
    )
    y = x.select(
        id_col, "v", F.col("bx.i").alias("ix"), "r0", "r1",
        F.explode(F.filter(rng, lambda b: (b["lo"] < F.col("r1")) & (F.col("r0") < b["hi"]))).alias("by"),
    )
    ov = F.least(F.col("r1"), F.col("by.hi")) - F.greatest(F.col("r0"), F.col("by.lo"))
    z = y.select(id_col, (F.col("by.i") * n + F.col("ix")).cast("int").alias("tile"), (F.col("v") * ov).alias("a"))
    return z.groupBy(id_col, "tile").agg(F.sum("a").cast("bigint").alias("mask_area"))


def _tile_overlap_uniform(segments: DataFrame, n: int, size: int, step: int, id_col: str, v) -> DataFrame:
    """Evenly spaced boxes ``[step*i, step*i + size)``: the boxes holding column ``col`` are
    ``i in [floor((col - size) / step) + 1, floor(col / step)]`` and the boxes meeting rows ``[r0, r1)`` are
    ``i in [floor((r0 - size) / step) + 1, ceil(r1 / step) - 1]`` (clipped to ``[0, n-1]``): native ``sequence``,
    no lambda per piece."""

    def rng(lo, hi):
        lo = F.greatest(lo, F.lit(0))
        hi = F.least(hi, F.lit(n - 1))
        return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    fl = lambda x: F.floor(x / F.lit(step)).cast("int")
    col = F.col("col")
    x = segments.select(id_col, "r0", "r1", v.alias("v"), F.explode(rng(fl(col - size) + 1, fl(col))).alias("ix"))
    y = x.select(id_col, "v", "ix", "r0", "r1",
                 F.explode(rng(fl(F.col("r0") - size) + 1, F.ceil(F.col("r1") / F.lit(step)).cast("int") - 1)).alias("iy"))
    lo = F.col("iy") * step
    ov = F.least(F.col("r1"), lo + size) - F.greatest(F.col("r0"), lo)
    z = y.select(id_col, (F.col("iy") * n + F.col("ix")).cast("int").alias("tile"), (F.col("v") * ov).alias("a"))
    return z.groupBy(id_col, "tile").agg(F.sum("a").cast("bigint").alias("mask_area"))


def _cut(lo: np.ndarray, hi: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals cut at ``borders``: ``(index of the interval, cell, length)``; what lies outside the borders is left out."""
    lo, hi = np.clip(lo, borders[0], borders[-1]), np.clip(hi, borders[0], borders[-1])
    i = np.flatnonzero(hi > lo)
    lo, hi = lo[i], hi[i]
    first, last = np.searchsorted(borders, lo, side="right") - 1, np.searchsorted(borders, hi - 1, side="right") - 1
    if (first == last).all():
        return i, first, hi - lo
    n = last - first + 1
    k = np.repeat(np.arange(len(i)), n)
    cell = first[k] + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
    return i[k], cell, np.minimum(hi[k], borders[cell + 1]) - np.maximum(lo[k], borders[cell])


def _grids(canvases: Sequence[tuple[str, int, int]], size: int) -> list[tuple]:
    """``(name, side, tiles a side, borders of the tiles, cells inside each tile)`` of every canvas."""
    grids = []
    for name, side, n in canvases:
        r = tile_ranges(side, n, size)
        borders = np.unique([x for _, lo, hi in r for x in (lo, hi)])
        inside = np.array([[int(lo <= x < hi) for x in borders[:-1]] for _, lo, hi in r], np.int64)
        grids.append((name, side, n, borders, inside))
    return grids


def _tile_sums(images: int, image: np.ndarray, col: np.ndarray, r0: np.ndarray, r1: np.ndarray, grid: tuple, height: int, width: int) -> np.ndarray:
    """``[image, tile]``: the mass of pieces in every tile of one canvas. Pieces are cut at the tiles' borders and summed by cell."""
    _, side, n, borders, inside = grid
    up = lambda x, by: x if side == by else (x * side + by - 1) // by
    cells = len(borders) - 1
    p, cy, tall = _cut(up(r0, height), up(r1, height), borders)
    q, cx, wide = _cut(up(col, width)[p], up(col + 1, width)[p], borders)
    place = (image[p[q]] * cells + cy[q]) * cells + cx
    mass = np.bincount(place, weights=tall[q] * wide, minlength=images * cells * cells).astype(np.int64)
    return (inside @ mass.reshape(-1, cells, cells) @ inside.T).reshape(images, n * n)


def _tile_rows(key: pa.Array, name: str, at: np.ndarray, tile: np.ndarray, mass: np.ndarray, id_col: str, out: str) -> pa.RecordBatch:
    canvas = pa.array([name]).take(pa.array(np.zeros(len(at), np.int64)))
    return pa.RecordBatch.from_arrays([key.take(pa.array(at)), canvas, pa.array(tile, pa.int32()), pa.array(mass)], names=[id_col, "canvas", "tile", out])


def tile_masses(annotations: DataFrame, canvases: Sequence[tuple[str, int, int]], size: int = 256, height: int = CANVAS_H, width: int = CANVAS_W,
                id_col: str = ID, enc_col: str = ENC) -> DataFrame:
    """M1 + M14 + J5 from texts: ``(id, canvas, tile, mask_area)``, for every canvas ``(name, side, tiles a side)`` the mass of each
    tile that meets the mask; the label raster (rows of an image add up) is resized to the canvas by nearest sampling.

    The same sums as :func:`tile_overlap` of the pieces, but a task reads the texts in Arrow batches: the pieces of a batch are cut at
    the borders of the tiles, summed by (image, cell), and a tile is the sum of its cells. Only the sums of the
    images of a batch leave it, at most ``n * n`` a canvas, and are shuffled, by image, so that ranks within an image need no
    further exchange; no run or piece is a row."""
    rows = annotations.select(F.col(id_col), F.col(enc_col).alias("_text"))
    grids = _grids(canvases, size)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(id_col).dictionary_encode(null_encoding="encode")
            key, group = ids.dictionary, ids.indices.to_numpy()
            counts, a, b, _ = B.decode(batch.column("_text"), height * width)
            row = np.repeat(group, counts)
            i, col, r0, r1 = IB.cut_columns(a, b, height)
            image = row[i]
            for grid in grids:
                total = _tile_sums(len(key), image, col, r0, r1, grid, height, width)
                at, tile = np.nonzero(total)
                yield _tile_rows(key, grid[0], at, tile, total[at, tile], id_col, "_mass")

    ship_package(annotations.sparkSession)
    schema = IB.schema_of(rows, [id_col], "canvas string, tile int, _mass bigint")
    return rows.mapInArrow(fn, schema).repartition(id_col).groupBy(id_col, "canvas", "tile").agg(F.sum("_mass").cast("bigint").alias("mask_area"))


def fullest_tiles(annotations: DataFrame, canvases: Sequence[tuple[str, int, int, int]], min_area: int = 64, size: int = 256, height: int = CANVAS_H, width: int = CANVAS_W,
                  id_col: str = ID, enc_col: str = ENC) -> DataFrame:
    """:func:`tile_masses` and W4 + P8 in one pass: ``(id, canvas, tile, mask_area)``, of every canvas ``(name, side, tiles a side, tiles
    kept)`` the tiles of an image with the largest mass (ties: higher tile first) that reach ``min_area``. All tiles are measured;
    the rows of an image stand together, so its sums are complete in the task and only the tiles kept leave it. Of the
    image that is open at a batch's end its sums are carried on."""
    rows = annotations.select(F.col(id_col), F.col(enc_col).alias("_text"))
    grids, most = _grids([c[:3] for c in canvases], size), [c[3] for c in canvases]

    def kept(keys: pa.Array, totals: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for grid, total, k in zip(grids, totals, most, strict=True):
            tiles = total.shape[1]
            best = np.argsort(-(total * tiles + np.arange(tiles)), axis=1)[:, :k]
            mass = np.take_along_axis(total, best, 1)
            at, place = np.nonzero((mass > 0) & (mass >= min_area))
            yield _tile_rows(keys, grid[0], at, best[at, place], mass[at, place], id_col, "mask_area")

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            group, first = IB.groups(batch, [id_col])
            keys = batch.column(id_col).take(pa.array(first))
            counts, a, b, _ = B.decode(batch.column("_text"), height * width)
            i, col, r0, r1 = IB.cut_columns(a, b, height)
            image = np.repeat(group, counts)[i]
            totals = [_tile_sums(len(first), image, col, r0, r1, grid, height, width) for grid in grids]
            if held is not None:
                if held[0].to_pylist() == keys.slice(0, 1).to_pylist():
                    for total, before in zip(totals, held[1], strict=True):
                        total[:1] += before
                else:
                    yield from kept(*held)
            last = len(first) - 1
            yield from kept(keys.slice(0, last), [x[:last] for x in totals])
            held = keys.slice(last), [x[last:] for x in totals]
        if held is not None:
            yield from kept(*held)

    ship_package(annotations.sparkSession)
    return IB.beside(rows, [id_col]).mapInArrow(fn, IB.schema_of(rows, [id_col], "canvas string, tile int, mask_area bigint"))


def box_overlap(pieces: DataFrame, boxes: DataFrame, bin_size: int = 128, id_col: str = ID, box_col: str = "box",
                value_col: str | None = None) -> DataFrame:
    """J5 with boxes as data: per (image, box) the sum of mask values inside the box (``mask_area``), for boxes that meet the
    mask. ``pieces`` are column pieces ``(id, col, r0, r1[, value])`` that may overlap (they add up), ``boxes``
    ``(id, box, x0, y0, x1, y1)``, ends exclusive, of any size and number; equal boxes of one image add into one row, and
    rows with a null in them meet nothing.

    The range join is an equi join on (image, column bin, row bin). Pieces are cut at the bins' row borders, so each part lies in
    one bin, and equal parts are added up before the shuffle: a bin of an image holds at most as many parts as its cells allow,
    however many rows the image had, and an image with a third of all rows is spread over its bins. A box meets the
    parts of the bins that it cuts; bins that lie inside it whole are met as one total each, so a long box does not
    read its inside."""
    v = (F.col(value_col) if value_col else F.lit(1)).cast("bigint")
    b = F.lit(bin_size)
    fl = lambda x: F.floor(x / b).cast("bigint")
    p = pieces.filter(F.col("r1") > F.col("r0")).select(
        F.col(id_col).alias("_id"), F.col("col").cast("bigint").alias("_c"), v.alias("_v"), "r0", "r1",
        F.explode(F.sequence(fl(F.col("r0")), fl(F.col("r1") - 1))).alias("_rb"))
    p = p.select("_id", fl(F.col("_c")).alias("_cb"), "_rb", "_c", F.greatest("r0", F.col("_rb") * b).cast("bigint").alias("_a"),
                 F.least("r1", (F.col("_rb") + 1) * b).cast("bigint").alias("_b"), "_v")
    parts = p.groupBy("_id", "_cb", "_rb", "_c", "_a", "_b").agg(F.sum("_v").alias("_v"))
    totals = parts.groupBy("_id", "_cb", "_rb").agg(F.sum(F.col("_v") * (F.col("_b") - F.col("_a"))).alias("_t"))
    x = boxes.select(F.col(id_col).alias("_id"), F.col(box_col).alias("_box"), *[F.col(c).cast("bigint").alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    x = x.filter((F.col("_x1") > F.col("_x0")) & (F.col("_y1") > F.col("_y0")))
    x = x.withColumn("_cb", F.explode(F.sequence(fl(F.col("_x0")), fl(F.col("_x1") - 1))))
    x = x.withColumn("_rb", F.explode(F.sequence(fl(F.col("_y0")), fl(F.col("_y1") - 1))))
    inside = (F.col("_x0") <= F.col("_cb") * b) & ((F.col("_cb") + 1) * b <= F.col("_x1"))
    inside = inside & (F.col("_y0") <= F.col("_rb") * b) & ((F.col("_rb") + 1) * b <= F.col("_y1"))
    keys = ["_id", "_cb", "_rb"]
    full = x.filter(inside).join(totals, keys).select("_id", "_box", F.col("_t").alias("_m"))
    cut = x.filter(~inside).join(parts, keys).filter((F.col("_x0") <= F.col("_c")) & (F.col("_c") < F.col("_x1")))
    rows = F.least("_b", "_y1") - F.greatest("_a", "_y0")
    cut = cut.filter(rows > 0).select("_id", "_box", (F.col("_v") * rows).alias("_m"))
    out = full.unionByName(cut).groupBy("_id", "_box").agg(F.sum("_m").cast("bigint").alias("mask_area"))
    return out.filter("mask_area != 0").select(F.col("_id").alias(id_col), F.col("_box").alias(box_col), "mask_area")


def box_masses(annotations: DataFrame, boxes: DataFrame, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID, enc_col: str = ENC,
               box_col: str = "box") -> DataFrame:
    """M1 + :func:`box_overlap` from texts: the same sums, but no run or piece is a row. The runs of an Arrow batch of texts are packed by
    image where they are read and shuffled once, by image, with the boxes beside them; equal boxes of an image stand together, so
    their sums leave the task complete.

    A box meets the pieces of its image one by one. Where an image's pieces times its boxes outnumber the pixels, or its runs a quarter
    of them, it is painted instead and its boxes are read off running sums: a task holds one batch and one canvas, however many
    rows or boxes an image has."""
    size = height * width
    wide = size >= B.WIDE
    texts = annotations.filter(F.col(id_col).isNotNull()).select(F.col(id_col), F.col(enc_col).alias("_text"))
    schema = IB.schema_of(texts, [id_col], "_runs binary, _wide boolean")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(id_col).dictionary_encode()
            counts, a, b, _ = B.decode(batch.column("_text"), size)
            group = np.repeat(ids.indices.to_numpy(), counts)
            if (group[1:] < group[:-1]).any():
                order = np.argsort(group, kind="stable")
                group, a, b = group[order], a[order], b[order]
            start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])[:len(group)]
            place = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
            start = np.flatnonzero(place % IB.MOST_RUNS == 0)
            runs = B.pack(np.diff(np.r_[start, len(group)]), a, b, wide).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([ids.dictionary.take(pa.array(group[start])), runs, pa.array(np.full(len(start), wide))], names=[id_col, "_runs", "_wide"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        image = None  # the image that is still open: its id, its runs and, if they are many, its painted columns
        last = None  # the boxes of one name that are still open: (id, rank, row, sum)
        for batch in batches:
            if not batch.num_rows:
                continue
            group, first = IB.groups(batch, [id_col])
            row, a, b = IB.packed_rows(batch)
            of, painted = group[row], None
            if image is not None and image[0] == batch.column(id_col)[0].as_py():
                of, a, b, painted = np.r_[np.zeros(len(image[1]), np.int64), of], np.r_[image[1], a], np.r_[image[2], b], image[3]
            i, col, r0, r1 = IB.cut_columns(a, b, height)
            pieces = np.searchsorted(of[i], np.arange(len(first) + 1))
            at = np.flatnonzero(batch.column("_kind").to_numpy() == 1)
            x0, y0, x1, y1 = (np.clip(batch.column(f"_{c}").fill_null(0).to_numpy()[at], 0, most) for c, most in (("x0", width), ("y0", height), ("x1", width), ("y1", height)))
            own = group[at]
            mass = np.zeros(len(at), np.int64)
            number = np.diff(pieces)
            many = number * np.bincount(own, minlength=len(first)) > size
            if painted is not None:
                many[0] = True
            for g in np.flatnonzero(many).tolist():
                s, some = slice(pieces[g], pieces[g + 1]), np.flatnonzero(own == g)
                if len(some):
                    sums = _running_sums(_painted(painted if g == 0 else None, col[s], r0[s], r1[s], height, width))
                    mass[some] = sums[x1[some], y1[some]] - sums[x0[some], y1[some]] - sums[x1[some], y0[some]] + sums[x0[some], y0[some]]
            few = np.flatnonzero(~many[own] & (number[own] > 0))
            for lo, hi in _up_to(number[own[few]], IB.MOST_OUT):
                j = few[lo:hi]
                n = number[own[j]]
                k = np.repeat(np.arange(len(j)), n)
                p = np.repeat(pieces[own[j]] - (np.cumsum(n) - n), n) + np.arange(len(k))
                c = col[p]
                hit = np.flatnonzero((x0[j][k] <= c) & (c < x1[j][k]))
                k, p = k[hit], p[hit]
                rows = np.minimum(r1[p], y1[j][k]) - np.maximum(r0[p], y0[j][k])
                mass[j] = np.bincount(k, weights=np.maximum(rows, 0), minlength=len(j)).astype(np.int64)  # far below 2**53: a piece and a box meet in at most a column
            if len(at):
                rank = batch.column("_rank").to_numpy()[at]
                head = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (rank[1:] != rank[:-1])])
                total = np.add.reduceat(mass, head)
                found = pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(at[head])) for c in (id_col, "_box")] + [pa.array(total)], names=[id_col, box_col, "mask_area"])
                if last is not None:
                    if (last[0], last[1]) == (found.column(0)[0].as_py(), int(rank[0])):
                        total[0] += last[2].column(2)[0].as_py()
                        found = found.set_column(2, "mask_area", pa.array(total))
                    else:
                        yield last[2]
                n = found.num_rows - 1
                last = found.column(0)[n].as_py(), int(rank[head[n]]), found.slice(n)
                yield found.slice(0, n)
            g = len(first) - 1
            s = slice(pieces[g], pieces[g + 1])
            held = np.searchsorted(of, g)
            painted = painted if g == 0 else None
            if painted is not None or s.stop - s.start > size // 4:
                painted = _painted(painted, col[s], r0[s], r1[s], height, width)
                held = len(of)
            image = batch.column(id_col)[int(first[g])].as_py(), a[held:], b[held:], painted
        if last is not None:
            yield last[2]

    ship_package(annotations.sparkSession)
    packed = texts.mapInArrow(pack, schema).select(id_col, F.lit(0).alias("_kind"), F.lit(None).cast(boxes.schema[box_col].dataType).alias("_box"), "_runs", "_wide",
                                                   *[F.lit(None).cast("bigint").alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    x = boxes.select(F.col(id_col).cast(texts.schema[id_col].dataType), F.lit(1).alias("_kind"), F.col(box_col).alias("_box"), F.lit(None).cast("binary").alias("_runs"), F.lit(False).alias("_wide"),
                     *[F.col(c).cast("bigint").alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    x = x.filter(F.col(id_col).isNotNull() & (F.col("_x1") > F.col("_x0")) & (F.col("_y1") > F.col("_y0")))
    rows = packed.unionByName(x).withColumn("_rank", F.dense_rank().over(Window.partitionBy(id_col).orderBy("_kind", "_box")))
    out = IB.schema_of(rows.select(F.col(id_col), F.col("_box").alias(box_col)), [id_col, box_col], "mask_area bigint")
    return rows.mapInArrow(meet, out).filter("mask_area != 0")


def _painted(base: np.ndarray | None, col: np.ndarray, r0: np.ndarray, r1: np.ndarray, height: int, width: int) -> np.ndarray:
    """Pieces as changes of the count down every column, added to ``base``."""
    out = np.zeros((width, height + 1), np.int64) if base is None else base.copy()
    np.add.at(out, (col, r0), 1)
    np.add.at(out, (col, r1), -1)
    return out


def _running_sums(painted: np.ndarray) -> np.ndarray:
    """``[x, y]``: the mass in the columns before x and the rows before y."""
    out = np.zeros((painted.shape[0] + 1, painted.shape[1]), np.int64)
    np.cumsum(np.cumsum(painted, axis=1)[:, :-1], axis=1, out=out[1:, 1:])
    return np.cumsum(out, axis=0, out=out)


def _up_to(n: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries that add up to about ``most``, at least one entry each."""
    ends = np.cumsum(n)
    lo = 0
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def topk_tiles(tile_areas: DataFrame, k: int, min_area: int = 64, id_col: str = ID) -> DataFrame:
    """W4 + P8: the ``k`` tiles with the largest mask area per image (ties: higher tile index first, the tail of an
    ascending stable sort), kept when the area reaches ``min_area``. The window partition is one image's tiles (at
    most n*n rows)."""
    w = Window.partitionBy(id_col).orderBy(F.desc("mask_area"), F.desc("tile"))
    r = tile_areas.withColumn("tile_rank", F.row_number().over(w))
    return r.filter((F.col("tile_rank") <= k) & (F.col("mask_area") >= min_area))


def resize_nearest_pieces(pieces: DataFrame, target: int, height: int = CANVAS_H, width: int = CANVAS_W,
                          id_col: str = ID, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nearest-neighbour resize of a mask in column pieces to ``target x target``: target pixel (tr, tc)
    samples source (floor(tr * H / T), floor(tc * W / T)). On pieces: a source row range [r0, r1) maps to target
    rows [ceil(r0 T / H), ceil(r1 T / H)) and a source column c to target columns [ceil(c T / W), ceil((c+1) T / W)),
    all in integer arithmetic. (The reference resizes label masks bilinearly; nearest keeps them integral.)"""

    def cdiv(a, b):
        return F.floor((a + F.lit(b - 1)) / F.lit(b)).cast("bigint")

    t = target
    lo = cdiv(F.col("col") * t, width)
    hi = cdiv((F.col("col") + 1) * t, width)
    cols = F.when(hi > lo, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<bigint>"))
    x = pieces.select(
        id_col, *keep,
        cdiv(F.col("r0") * t, height).alias("r0"), cdiv(F.col("r1") * t, height).alias("r1"),
        F.explode(cols).alias("col"),
    )
    return x.filter((F.col("r1") > F.col("r0")) & (F.col("col") >= 0) & (F.col("col") < t)).select(
        id_col, *keep, "col", "r0", "r1"
    )


def resized_masks(masks: DataFrame, target: int, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID) -> DataFrame:
    """:func:`resize_nearest_pieces` of whole masks (``coverage.packed_masks``), one row each."""
    t = target

    def move(image, col, r0, r1):
        lo, hi = -(-col * t // width), -(-(col + 1) * t // width)
        n = np.where(-(-r1 * t // height) > -(-r0 * t // height), hi - lo, 0)  # target columns of a piece that keeps a row
        i = np.repeat(np.arange(len(col)), n)
        to = lo[i] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        return image[i], to, -(-r0[i] * t // height), -(-r1[i] * t // height)

    return IB.moved_masks(masks, move, height, (t, t), id_col)


def tile_select(segments: DataFrame, resize: int, n: int, k: int, tag: str, min_area: int = 64,
                height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID) -> DataFrame:
    """Resize the label raster, measure every tile, keep the top ``k`` with at least ``min_area`` and name them
    ``<id without extension><tag><tile>`` (P6)."""
    seg = segments if resize == height else resize_nearest_pieces(segments, resize, height, width, id_col, keep=("c",))
    return named_tiles(tile_overlap(seg, resize, n, id_col=id_col), k, tag, min_area, id_col)


def named_tiles(tile_areas: DataFrame, k: int, tag: str, min_area: int = 64, id_col: str = ID) -> DataFrame:
    """W4 + P8 + P6: the top ``k`` tiles of an image with at least ``min_area``, named ``<id without extension><tag><tile>``."""
    top = topk_tiles(tile_areas, k, min_area, id_col)
    return top.withColumn("sample", sample_name(id_col, F.concat(F.lit(tag), F.col("tile").cast("string"))))
