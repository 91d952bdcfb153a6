"""Prediction files -> ensembled submission."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from maskframe.functions.classes import CANVAS_H, CANVAS_W
from maskframe.operators import coverage as V
from maskframe.operators.components import multi_rle_masks

ID = "ImageId"
ENC = "EncodedPixels"


def ensemble(sources: Sequence[DataFrame], k: int = 2, height: int = CANVAS_H, width: int = CANVAS_W) -> DataFrame:
    """Concatenate the submissions, keep pixels covered by at least ``k`` rows (the count is over rows, so overlap
    inside one file also votes), split the kept mask into 8-connected instances and emit one row per instance;
    every id of any source gets at least one row (null when nothing is left).

    Shuffles: the rows by image (none if they are already partitioned so). The kept mask of an image leaves the sweep whole, in
    one row, so neither pieces nor texts are shuffled after it, and the sources are not read again for their ids."""
    masks = V.packed_masks(sources, lambda c, by: c >= k, height, width)
    return multi_rle_masks(masks, height, width).select(ID, ENC)
