"""Whole images in Arrow batches: the sweep over run ends, packing of column pieces and the streams that hand complete images
to a NumPy function (SURVEY M3, M6, W5, W8).

The rows of an image stand together (:func:`beside`), and a task reads them as a stream of Arrow batches. Many images are
handled in one call; what is still open of the last one is carried on in its smallest form -- the summed run ends, or the
runs -- so a task holds one batch and one canvas, however many rows an image has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from maskframe.functions import rle_batch as B
from maskframe.session import ship_package

MOST_RUNS = 8192  # in one packed value: a mask with many runs takes several rows
MOST_OUT = 1 << 20  # runs or segments in one batch that leaves Python


def beside(df: DataFrame, part: Sequence[str], out: str = "_rows") -> DataFrame:
    """The rows with those of the same key next to each other, in one task, as a window needs them (``out``: their
    number). Tables that are already partitioned and sorted by the key are not moved."""
    return df.withColumn(out, F.count(F.lit(1)).over(Window.partitionBy(*part)))


def schema_of(df: DataFrame, names: Sequence[str], more: str = "") -> StructType:
    """The named columns of ``df`` and the columns of the DDL ``more``."""
    fields = [StructField(c, df.schema[c].dataType, True) for c in names]
    return StructType(fields + (StructType.fromDDL(more).fields if more else []))


def groups(batch: pa.RecordBatch, part: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(group of every row, first row of every group)`` of rows that stand together by ``part``; nulls are equal."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for c in part:
        code = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    return np.cumsum(new) - 1, np.flatnonzero(new)


def cut_columns(a: np.ndarray, b: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs cut at column borders: ``(index of the run, col, r0, r1)``."""
    first, last = a // height, (b - 1) // height
    i = np.arange(len(a))
    if (first == last).all():
        return i, first, a - first * height, b - first * height
    n = last - first + 1
    i = np.repeat(i, n)
    col = first[i] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
    base = col * height
    return i, col, np.maximum(a[i], base) - base, np.minimum(b[i], base + height) - base


def summed(key: np.ndarray, delta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Changes added up by key, in order; keys without a change left out."""
    if not len(key):
        return key, delta
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    total = np.empty((len(head), delta.shape[1]), delta.dtype)
    for k in range(delta.shape[1]):  # a layer at a time: rows of one or two numbers are slow to add
        total[:, k] = np.add.reduceat(delta[order, k], head)
    keep = any_layer(total)
    return key[head[keep]], total[keep]


def any_layer(counts: np.ndarray) -> np.ndarray:
    """Rows in which a layer is not zero."""
    some = counts[:, 0] != 0
    for k in range(1, counts.shape[1]):
        some |= counts[:, k] != 0
    return some


Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def sweep(batches: Iterator[pa.RecordBatch], part: Sequence[str], height: int, width: int, layers: int, runs: Callable[[pa.RecordBatch], Runs],
          finish: Callable[..., Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """The sweep of every image: ``runs(batch)`` gives ``(row, a, b, layer, change)``, ``finish(keys, image, col, r0, r1, counts)``
    makes rows of complete images -- ``keys`` has one row per image, also of those without a run, and ``counts`` one column
    per layer on every stretch between two run ends where any layer counts."""
    span = height + 1
    size = width * span
    open_keys, open_key, open_delta = None, None, None

    def done(keys: pa.RecordBatch, key: np.ndarray, delta: np.ndarray) -> Iterator[pa.RecordBatch]:
        count = np.cumsum(delta, axis=0)
        at = np.flatnonzero(any_layer(count))
        image, rest = key[at] // size, key[at] % size
        r0 = rest % span
        yield from finish(keys, image, rest // span, r0, r0 + key[at + 1] - key[at] if len(at) else r0, count[at])

    for batch in batches:
        if not batch.num_rows:
            continue
        group, first = groups(batch, part)
        keys = pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(first)) for c in part], names=list(part))
        row, a, b, layer, change = runs(batch)
        i, col, r0, r1 = cut_columns(a, b, height)
        base = group[row[i]] * size + col * span
        key = np.empty(2 * len(i), np.int64)  # start and end side by side: a row's changes are in order before they are sorted
        key[0::2], key[1::2] = base + r0, base + r1
        delta = np.zeros((len(key), layers), np.int64)
        delta[np.arange(0, len(key), 2), layer[i]] = change[i]
        delta[np.arange(1, len(key), 2), layer[i]] = -change[i]
        if open_keys is not None:
            if open_keys.slice(0, 1).to_pylist() == keys.slice(0, 1).to_pylist():
                key, delta = np.concatenate([open_key, key]), np.concatenate([open_delta, delta])
            else:
                yield from done(open_keys, open_key, open_delta)
        key, delta = summed(key, delta)
        last = keys.num_rows - 1
        cut = int(np.searchsorted(key, last * size))
        if last:
            yield from done(keys.slice(0, last), key[:cut], delta[:cut])
        open_keys, open_key, open_delta = keys.slice(last), key[cut:] - last * size, delta[cut:]
    if open_keys is not None:
        yield from done(open_keys, open_key, open_delta)


def in_slices(n: int, make: Callable[[slice], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for at in range(0, n, MOST_OUT):
        yield make(slice(at, at + MOST_OUT))


# ------------------------------------------------------------------------------------------------------------ packed masks
def packed_pieces(pieces: DataFrame, part: Sequence[str], height: int) -> DataFrame:
    """Disjoint column pieces ``(*part, col, r0, r1)`` -> ``(*part, _runs, _wide)``: the runs of neighbouring rows of one key in
    one binary value, joined where they touch. Rows of one key that are apart give several values."""
    part = list(part)
    p = pieces.select(*part, *[F.col(c).cast("bigint").alias(f"_{c}") for c in ("col", "r0", "r1")]).filter("_r1 > _r0")
    schema = schema_of(p, part, "_runs binary, _wide boolean")

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            group, first = groups(batch, part)
            col, r0, r1 = (batch.column(c).to_numpy() for c in ("_col", "_r0", "_r1"))
            a, b = col * height + r0, col * height + r1
            if ((group[1:] == group[:-1]) & (a[1:] < a[:-1])).any():
                order = np.lexsort((a, group))
                group, a, b = group[order], a[order], b[order]
            head = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (a[1:] != b[:-1])])
            g, a, b = group[head], a[head], b[np.r_[head[1:], len(b)] - 1]
            start = np.r_[0, np.flatnonzero(g[1:] != g[:-1]) + 1]
            place = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
            start = np.flatnonzero(place % MOST_RUNS == 0)
            wide = bool(b.max() >= B.WIDE)
            runs = B.pack(np.diff(np.r_[start, len(g)]), a, b, wide).cast(pa.binary())
            keys = [batch.column(c).take(pa.array(first[g[start]])) for c in part]
            yield pa.RecordBatch.from_arrays([*keys, runs, pa.array(np.full(len(start), wide))], names=[*part, "_runs", "_wide"])

    ship_package(pieces.sparkSession)
    return p.mapInArrow(fn, schema)


def joined(image: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs in order by image, those of one image that touch as one."""
    if not len(image):
        return image, a, b
    head = np.flatnonzero(np.r_[True, (image[1:] != image[:-1]) | (a[1:] != b[:-1])])
    return image[head], a[head], b[np.r_[head[1:], len(b)] - 1]


def packed_images(keys: pa.RecordBatch, image: np.ndarray, a: np.ndarray, b: np.ndarray, wide: bool, id_col: str) -> Iterator[pa.RecordBatch]:
    """``(id, _runs, _wide, _mark)``, one row per image of ``keys`` with its runs, which are in order."""
    for some, own in slices_of(keys.num_rows, image):
        n = some.stop - some.start
        runs = B.pack(np.bincount(image[own] - some.start, minlength=n), a[own], b[own], wide).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([keys.column(0).slice(some.start, n), runs, pa.array(np.full(n, wide)), pa.array(np.ones(n, np.int32))], names=[id_col, "_runs", "_wide", "_mark"])


def moved_masks(masks: DataFrame, move: Callable[..., tuple[np.ndarray, ...]], height: int, to: tuple[int, int], id_col: str) -> DataFrame:
    """Whole masks ``(id, _runs, _wide, _mark)`` with their column pieces changed by ``move(image, col, r0, r1)``, which gives disjoint
    pieces on a canvas of ``to`` (height, width). One row per mask, as before; nothing is shuffled."""
    wide = to[0] * to[1] >= B.WIDE
    rows = masks.select(id_col, "_runs", "_wide", "_mark")

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, a, b = packed_rows(batch)
            for some, own in slices_of(batch.num_rows, row):
                i, col, r0, r1 = cut_columns(a[own], b[own], height)
                image, col, r0, r1 = move(row[own][i] - some.start, col, r0, r1)
                a_, b_ = col * to[0] + r0, col * to[0] + r1
                order = np.argsort(image * (to[0] * to[1]) + a_, kind="stable")
                yield from packed_images(batch.slice(some.start, some.stop - some.start), *joined(image[order], a_[order], b_[order]), wide, id_col)

    ship_package(masks.sparkSession)
    return rows.mapInArrow(fn, schema_of(rows, rows.columns))


def packed_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, a, b)`` of a batch's packed values, ordered by row and run."""
    wide = batch.column("_wide").to_numpy(zero_copy_only=False).astype(bool)
    got = []
    for some, is_wide in ((np.flatnonzero(~wide), False), (np.flatnonzero(wide), True)):
        row, a, b = B.unpack(batch.column("_runs").take(pa.array(some)), is_wide)
        got.append((some[row], a, b))
    if wide.any() and not wide.all():
        row, a, b = (np.concatenate(x) for x in zip(*got))
        order = np.argsort(row, kind="stable")
        return row[order], a[order], b[order]
    return got[1] if wide.any() else got[0]


def rowwise_runs(image: np.ndarray, a: np.ndarray, b: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(image, row, c0, c1)``: the maximal runs along rows (columns c0..c1 inclusive) of masks given as runs, in order.

    Every column piece takes part in two boundaries, the one to its left and the one to its right; one sweep of each boundary
    tells the rows that only its right column covers (a run starts there) and those that only its left one covers (a run has
    ended). Only those rows are written out; along a row starts and ends alternate, so a start's next boundary is its end."""
    i, col, r0, r1 = cut_columns(a, b, height)
    if not len(i):
        return i, i, i, i
    span = height + 1
    edges = int(col.max()) + 2
    # (boundary, position, change right of it, change left of it) at both ends of a piece, for both of its boundaries
    base = (image[i] * edges + col) * span
    key = np.concatenate([base + r0, base + r1, base + span + r0, base + span + r1])
    n = len(base)
    delta = np.zeros((4 * n, 2), np.int64)
    delta[:n, 0], delta[n:2 * n, 0], delta[2 * n:3 * n, 1], delta[3 * n:, 1] = 1, -1, 1, -1
    key, delta = summed(key, delta)
    right, left = (np.cumsum(delta, axis=0) > 0).T
    at = np.flatnonzero(right != left)
    n = key[at + 1] - key[at]
    i = np.repeat(at, n)
    row = key[i] % span + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
    image, edge, start = key[i] // span // edges, key[i] // span % edges, right[i]
    order = np.argsort((image * height + row) * edges + edge, kind="stable")
    image, row, edge, start = image[order], row[order], edge[order], start[order]
    own = np.flatnonzero(start)
    return image[own], row[own], edge[own], edge[own + 1] - 1


def with_ids(packed: DataFrame, ids: DataFrame | None, id_col: str) -> DataFrame:
    """``packed`` with a ``_mark`` of 0, and one row without runs and a mark of 1 per row of ``ids``."""
    packed = packed.withColumn("_mark", F.lit(0))
    if ids is None:
        return packed
    marks = ids.select(F.col(id_col), F.lit(None).cast("binary").alias("_runs"), F.lit(False).alias("_wide"), F.lit(1).alias("_mark"))
    return packed.unionByName(marks)


def complete(batches: Iterator[pa.RecordBatch], part: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(keys, marks, image, a, b)`` of complete images from packed rows that stand together: one row of ``keys`` and one count
    of marked rows per image, and the runs in order, joined where they touch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        group, first = groups(batch, part)
        keys = pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(first)) for c in part], names=list(part))
        marks = np.bincount(group, weights=batch.column("_mark").to_numpy(), minlength=len(first)).astype(np.int64)
        wide = batch.column("_wide").to_numpy(zero_copy_only=False).astype(bool)
        got = []
        for some, is_wide in ((np.flatnonzero(~wide), False), (np.flatnonzero(wide), True)):
            if len(some):
                row, a, b = B.unpack(batch.column("_runs").take(pa.array(some)), is_wide)
                got.append((group[some[row]], a, b))
        image, a, b = (np.concatenate(x) for x in zip(*got))
        if held is not None:
            if held[0].to_pylist() == keys.slice(0, 1).to_pylist():
                marks[0] += held[1][0]
                image, a, b = np.concatenate([held[2], image]), np.concatenate([held[3], a]), np.concatenate([held[4], b])
            else:
                yield held
        order = np.lexsort((a, image))
        image, a, b = image[order], a[order], b[order]
        if len(image):
            head = np.flatnonzero(np.r_[True, (image[1:] != image[:-1]) | (a[1:] != b[:-1])])
            image, a, b = image[head], a[head], b[np.r_[head[1:], len(b)] - 1]
        last = keys.num_rows - 1
        cut = int(np.searchsorted(image, last))
        if last:
            yield keys.slice(0, last), marks[:last], image[:cut], a[:cut], b[:cut]
        held = keys.slice(last), marks[last:], image[cut:] - last, a[cut:], b[cut:]
    if held is not None:
        yield held


def texts(counts: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """The RLE text of every group of runs in order; groups without runs give an empty text."""
    two = pc.binary_join_element_wise(pa.array(a + 1).cast(pa.string()), pa.array(b - a).cast(pa.string()), " ")
    off = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(off, two), " ")


def slices_of(keys: int, image: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Ranges of images, and of their runs, with about ``MOST_OUT`` runs each."""
    at = np.searchsorted(image, np.arange(keys + 1))
    lo = 0
    while lo < keys:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + MOST_OUT, side="right")) - 1)
        yield slice(lo, hi), slice(int(at[lo]), int(at[hi]))
        lo = hi
