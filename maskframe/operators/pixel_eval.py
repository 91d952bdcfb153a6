"""Pixel-wise evaluation of predicted masks against labelled ones, on runs.

Both sides are tables of run-length rows with a class value each. One sweep over the column pieces of both gives, for every
stretch of a column, what was labelled and what was predicted there; a stretch stands for its pixels, so the (label,
prediction) counts of whole images come from runs and no pixel is ever a row.

Plan: the rows of an image stand together; a task sweeps them in Arrow batches, with one layer of counts for the labels, one
per predicted class and one for broken texts, and writes the sums of every image. An image with a third of all rows keeps at
most (H + 1) x W sums between batches. No second read of the sources for their ids, and no join.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.functions import rle_batch as B
from maskframe.functions.classes import CANVAS_H, CANVAS_W, SHIP_IGNORE_LABEL
from maskframe.operators import image_batches as IB
from maskframe.operators import scores as SC
from maskframe.session import ship_package

ID = "ImageId"
ENC = "EncodedPixels"
def pixel_pairs(truth: DataFrame, pred: DataFrame, num_classes: int = 2, ignore_label: int | None = SHIP_IGNORE_LABEL, height: int = CANVAS_H, width: int = CANVAS_W, id_col: str = ID, enc_col: str = ENC, value_col: str | None = None) -> DataFrame:
    """``(id, label, pred, weight)``, the number of pixels of each pair in each image of either
    side; an image that only one side knows is empty on the other.

    A pixel's label is the sum of the values of the truth rows that cover it (``value_col``, or 1 a row: doubly covered pixels
    reach the ignore label); its prediction is the highest class among the rows that cover it, 0 without any. Pixels of the
    ignore label, and of labels outside the classes, have no weight. An image with a text that is not valid on either side
    has none at all (``annotations.quarantine`` reports the row): it is never taken for an empty image. The parts
    of an image are its sums."""
    value = F.col(value_col).cast("int") if value_col else F.lit(1)
    rows = None
    for side, df in enumerate((truth, pred)):
        x = df.select(F.col(id_col), F.lit(side).alias("_side"), value.alias("_value"), F.col(enc_col).alias("_text"))
        x = IB.beside(x, [id_col], "_own")  # each side is partitioned for itself, or is already; their union then is
        rows = x if rows is None else rows.unionByName(x)
    schema = IB.schema_of(rows, [id_col], "label int, pred int, weight bigint")
    canvas = height * width

    def runs(batch):
        """Layers: 0 an invalid text (its whole canvas), 1 the sum of the truth values, 1 + k the rows that predict class k."""
        counts, a, b, valid = B.decode(batch.column("_text"), canvas)
        bad = np.flatnonzero(~valid)
        side = batch.column("_side").to_numpy()
        v = batch.column("_value").fill_null(0).to_numpy().astype(np.int64)
        row = np.repeat(np.arange(batch.num_rows), counts)
        keep = np.where(side[row] == 0, v[row] != 0, (v[row] >= 1) & (v[row] < num_classes))
        row, a, b = row[keep], a[keep], b[keep]
        of_truth = side[row] == 0
        layer, change = np.where(of_truth, 1, 1 + v[row]), np.where(of_truth, v[row], 1)
        whole = np.zeros(len(bad), np.int64)
        return tuple(np.concatenate(x) for x in ((row, bad), (a, whole), (b, whole + canvas), (layer, whole), (change, whole + 1)))

    def finish(keys, image, col, r0, r1, counts):
        n, t = r1 - r0, counts[:, 1]
        guess = np.zeros(len(n), np.int64)
        for k in range(1, num_classes):
            guess[counts[:, 1 + k] > 0] = k
        counted = (counts[:, 0] == 0) & (t >= 0) & (t < num_classes)
        if ignore_label is not None:
            counted &= t != ignore_label
        # every image's canvas is background; a covered stretch takes its pixels from it and counts as its own pair
        cells = num_classes * num_classes
        total = np.zeros(keys.num_rows * cells, np.int64)
        total[::cells] = canvas
        np.add.at(total, image * cells, -n)
        np.add.at(total, (image * cells + t * num_classes + guess)[counted], n[counted])
        at = np.flatnonzero(total)
        cell = at % cells
        yield pa.RecordBatch.from_arrays([keys.column(0).take(pa.array(at // cells)), pa.array(cell // num_classes, pa.int32()), pa.array(cell % num_classes, pa.int32()), pa.array(total[at])],
                                         names=[id_col, "label", "pred", "weight"])

    ship_package(rows.sparkSession)
    return IB.beside(rows, [id_col]).mapInArrow(lambda batches: IB.sweep(batches, [id_col], height, width, num_classes + 1, runs, finish), schema)


def pixel_confusion(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A5 by pixel: ``(*by, label, pred, n)`` of :func:`pixel_pairs`, cells without a pixel left out. ``by=[id]`` gives a table
    per image."""
    return SC.confusion_matrix(pairs, by=by).filter("n != 0")


def pixel_mean_iou(truth: DataFrame, pred: DataFrame, by: Sequence[str] = (), **how) -> DataFrame:
    """A6 by pixel: ``(*by, miou)``, the mean over the classes that occur on either side."""
    return SC.mean_iou(pixel_confusion(pixel_pairs(truth, pred, **how), by), by=by)
