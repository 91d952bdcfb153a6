"""Model scoring and the classifier head.

``batch_score`` runs a pluggable ``model_fn`` over Arrow batches with ``mapInPandas``: the model is built once per
Python worker (cached), images of a batch are scored together, and nothing passes through the driver. The default
model is a fixed linear form of the pixels (a stand-in for a frozen network; no deep-learning runtime is available).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.operators import grids as G
from maskframe.session import ship_package

_MODELS: dict[object, object] = {}


class LinearGridModel:
    """Stub model: ``score = sum_i px_i * ((i % 7) - 3)`` over the row-major pixels (integer-valued)."""

    name = "linear-grid"

    def __call__(self, batch: np.ndarray) -> np.ndarray:
        n = batch.shape[1]
        w = (np.arange(n) % 7 - 3).astype(np.float64)
        return batch @ w


def _load(model_fn: Callable[[], Callable[[np.ndarray], np.ndarray]]):
    """The model of a factory, built once per Python worker; two factories never share one."""
    if model_fn not in _MODELS:
        _MODELS[model_fn] = model_fn()
    return _MODELS[model_fn]


def batch_score(grids: DataFrame, model_fn=LinearGridModel, id_col: str = "image_id", data_col: str = "data") -> DataFrame:
    """ML1: ``(image_id, data array<double>)`` -> ``(image_id, score)``; the model is loaded once per worker and gets the
    images of a batch by size, so sizes may differ."""

    def fn(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _load(model_fn)
        for pdf in it:
            if len(pdf) == 0:
                continue
            for _, own in pdf.groupby(pdf[data_col].map(len)):
                x = np.stack([np.asarray(v, dtype=np.float64) for v in own[data_col]])
                yield pd.DataFrame({id_col: own[id_col].to_numpy(), "score": model(x)})

    ship_package(grids.sparkSession)
    id_type = dict(grids.dtypes)[id_col]
    return grids.select(id_col, data_col).filter(F.col(data_col).isNotNull()).mapInPandas(fn, f"{id_col} {id_type}, score double")


class BrightPixels:
    """Stub pixel model: [h, w, channels] -> [h, w, 2] class scores; a pixel is a ship where its channels' mean is above
    ``level``."""

    def __init__(self, level: float = 128.0):
        self.level = level

    def __call__(self, img: np.ndarray) -> np.ndarray:
        ship = img.mean(2) - self.level
        return np.stack([np.zeros_like(ship), ship], axis=2)


def score_masks(images: DataFrame, model_fn=BrightPixels) -> DataFrame:
    """ML1 per pixel: ``(image_id, h, w[, c], data)`` -> ``(image_id, h, w, data)`` with the best class of every pixel (the
    lowest class on ties); images of any sizes, the model loaded once per worker."""
    out = G.cells(images, lambda img: _load(model_fn)(img).argmax(2).astype(np.float64))
    return images.select("image_id", "h", "w", out.alias("data"))


def multi_view_masks(images: DataFrame, model_fn=BrightPixels, scales=G.EVAL_SCALES, orientations=G.ORIENTATIONS) -> DataFrame:
    """ML2 per pixel: every view of an image (J6) is scored, flipped back and resized back; the views' softmax is averaged
    and the best class taken. All views of an image are made and used in one place, so nothing is shuffled."""

    def run(img):
        h, w, _ = img.shape
        total = 0.0
        for s in scales:
            small = G.bilinear(img, int(h * s), int(w * s))
            for o in orientations:
                back = G.bilinear(G._oriented(_load(model_fn)(G._oriented(small, o)), o), h, w)
                e = np.exp(back - back.max(2, keepdims=True))
                total = total + e / e.sum(2, keepdims=True)
        return total.argmax(2).astype(np.float64)

    return images.select("image_id", "h", "w", G.cells(images, run).alias("data"))


def mask_runs(masks: DataFrame, label: float = 1.0) -> DataFrame:
    """``(image_id, h, w, data)`` -> ``(ImageId, EncodedPixels)``: the pixels of ``label`` as run-length text (column by
    column, from 1); null for a mask without any."""

    def run(data: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
        out = []
        for d, y, x in zip(data, h, w, strict=True):
            on = np.flatnonzero(np.asarray(d).reshape(int(y), int(x)).T.ravel() == label)
            # a run starts where the pixel before is not set, and ends where the next is not
            first, last = on[np.diff(on, prepend=-2) > 1], on[np.diff(on, append=on[-1:] + 2) > 1]
            out.append(" ".join(f"{a + 1} {b - a + 1}" for a, b in zip(first, last, strict=True)) or None)
        return pd.Series(out, dtype="object")

    ship_package(masks.sparkSession)
    return masks.select(F.col("image_id").cast("string").alias("ImageId"), F.pandas_udf(run, "string")("data", "h", "w").alias("EncodedPixels"))


def score_submission(images: DataFrame, height: int, width: int, model_fn=BrightPixels) -> DataFrame:
    """The whole batch scoring: images -> masks -> connected instances -> one submission row per instance, a null row for an
    image without any. Masks of other sizes are brought to the height x width canvas first (nearest)."""
    from maskframe.operators.components import multi_rle
    from maskframe.operators.runs import rle_runs, run_pieces

    masks = G.resize_to(score_masks(images, model_fn), height, width, "nearest").withColumn("h", F.lit(height)).withColumn("w", F.lit(width))
    text = mask_runs(masks)
    pieces = run_pieces(rle_runs(text, height, width), height)
    return multi_rle(pieces, text.select("ImageId").distinct(), height, width).select("ImageId", "EncodedPixels")


def image_stats(images: DataFrame) -> DataFrame:
    """Dimensions and channels per image from Spark's ``image`` source."""
    return images.select(
        F.col("image.origin").alias("path"), F.col("image.height").alias("height"), F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"), F.length("image.data").alias("bytes"),
    )


def train_head(features: DataFrame, label_col: str = "label", max_iter: int = 50, held_out: str | None = None):
    """ML4: the classification head as a multinomial logistic regression on pooled feature vectors (data-parallel
    fit; gradients are combined with ``treeAggregate`` inside MLlib). Rows whose ``held_out`` column is true are predicted
    but not learned from. Returns the model and all rows with their ``prediction``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    data = features.withColumn("fv", array_to_vector("features"))
    lr = LogisticRegression(featuresCol="fv", labelCol=label_col, family="multinomial", maxIter=max_iter, regParam=0.01)
    model = lr.fit(data.filter(~F.col(held_out)) if held_out else data)
    return model, model.transform(data)


def evaluate_classifier(predictions: DataFrame, label_col: str = "label") -> DataFrame:
    """ML5: confusion table and accuracy of the head's predictions (one row per (label, prediction))."""
    p = predictions.select(F.col(label_col).cast("int").alias("label"), F.col("prediction").cast("int").alias("pred"))
    cm = p.groupBy("label", "pred").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    tot = p.agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"))
    return cm.crossJoin(tot)
