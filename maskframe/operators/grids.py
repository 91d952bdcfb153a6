"""Image preparation over tables of images.

An image is one row ``(image_id, h, w, c, data array<double>)``: row-major with the channels of a cell side by side, so cell
(row, col) of channel ch is ``data[(row * w + col) * c + ch]``; without a column ``c`` images have one channel. Sizes, offsets
and random draws are native columns (``md5(seed:tag:id)`` draws, the same in SQL); cells are moved by NumPy in Arrow batches,
which Spark bounds in bytes, one image at a time. No operator shuffles an image. A null ``data`` stays null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskframe.functions.keys import md5_unit
from maskframe.operators.ranking import attach
from maskframe.session import ship_package

# Mean pixel of the mean-subtracting extractors, the value that maps to 0 in the others, and how each
# extractor variant prepares its input.
MEAN_RGB = (123.15, 115.90, 103.06)
HALF_RANGE_PAD = 127.5
VARIANT_INPUT = {
    "mobilenet_v2": "half_range",
    "resnet_v1_50": "mean",
    "resnet_v1_50_beta": "half_range",
    "resnet_v1_101": "mean",
    "resnet_v1_101_beta": "half_range",
    "xception_41": "half_range",
    "xception_65": "half_range",
    "xception_71": "half_range",
}


def input_kind(variant: str | None) -> str:
    """``half_range`` or ``mean``: a variant's own, a kind as it is; None is ``mean``."""
    if variant is None:
        return "mean"
    kind = VARIANT_INPUT.get(variant, variant)
    if kind not in ("half_range", "mean"):
        raise ValueError(f"unknown variant {variant}")
    return kind


def mean_pixel(variant: str | None) -> tuple[float, float, float]:
    """The pixel that a variant's input preparation maps to 0; images are padded with it."""
    return MEAN_RGB if input_kind(variant) == "mean" else (HALF_RANGE_PAD,) * 3


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def channels(df: DataFrame) -> Column:
    return F.col("c") if "c" in df.columns else F.lit(1)


def cells(df: DataFrame, fn, *args, col: str = "data", c=None) -> Column:
    """``fn(image[h, w, c], *args)`` of every row as an array column; ``args`` are columns or values of the row. Where
    ``fn`` returns None (sizes that do not fit) the result is null."""
    ship_package(df.sparkSession)

    def run(data: pd.Series, h: pd.Series, w: pd.Series, ch: pd.Series, *rest: pd.Series) -> pd.Series:
        out = []
        for d, y, x, k, *own in zip(data, h, w, ch, *rest, strict=True):
            got = None if d is None else fn(np.asarray(d, np.float64).reshape(int(y), int(x), int(k)), *own)
            out.append(None if got is None else np.ascontiguousarray(got).ravel())
        return pd.Series(out, dtype="object")

    return F.pandas_udf(run, "array<double>")(F.col(col), F.col("h"), F.col("w"), channels(df) if c is None else c, *map(_col, args))


def _pixel(value, c: int) -> np.ndarray:
    """A pad value for ``c`` channels: one number for all, or one per channel."""
    v = np.atleast_1d(np.asarray(value, np.float64))
    return v[:c] if len(v) >= c else np.full(c, v[0])


def padded(img: np.ndarray, oy: int, ox: int, th: int, tw: int, value) -> np.ndarray | None:
    h, w, c = img.shape
    if oy < 0 or ox < 0 or oy + h > th or ox + w > tw:
        return None
    out = np.empty((th, tw, c))
    out[:] = _pixel(value, c)
    out[oy : oy + h, ox : ox + w] = img
    return out


def cut(img: np.ndarray, oy: int, ox: int, h: int, w: int) -> np.ndarray | None:
    ok = 0 <= oy and 0 <= ox and oy + h <= img.shape[0] and ox + w <= img.shape[1]
    return img[oy : oy + h, ox : ox + w] if ok else None


def bilinear(img: np.ndarray, oh: int, ow: int) -> np.ndarray:
    """Corners aligned: output i reads the source at i (in - 1) / (out - 1)."""
    h, w, _ = img.shape
    sy, sx = np.arange(oh) * (h - 1) / max(oh - 1, 1), np.arange(ow) * (w - 1) / max(ow - 1, 1)
    y0, x0 = np.floor(sy).astype(int), np.floor(sx).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    dy, dx = (sy - y0)[:, None, None], (sx - x0)[None, :, None]
    top, low = img[y0], img[y1]
    return (1 - dy) * (1 - dx) * top[:, x0] + (1 - dy) * dx * top[:, x1] + dy * (1 - dx) * low[:, x0] + dy * dx * low[:, x1]


def nearest(img: np.ndarray, oh: int, ow: int) -> np.ndarray:
    """Corners aligned, half up, in whole numbers."""
    h, w, _ = img.shape
    at = lambda n, m: (2 * np.arange(m) * (n - 1) + max(m - 1, 1)) // (2 * max(m - 1, 1))
    return img[at(h, oh)][:, at(w, ow)]


RESIZE = {"bilinear": bilinear, "nearest": nearest}


def _checked(value: Column, ok: Column, message: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(message)).cast("array<double>"))


def flip(df: DataFrame, seed, prob: float = 0.5, dim: str = "w") -> DataFrame:
    """Flip left-right (``dim='w'``) or up-down when ``u <= prob``; adds the ``flipped`` flag."""
    axis = 1 if dim == "w" else 0
    x = df.withColumn("flipped", md5_unit(seed, F.lit("flip"), "image_id") <= F.lit(prob))
    return x.withColumn("data", cells(x, lambda img, f: np.flip(img, axis) if f else img, "flipped"))


def pad_to_box(df: DataFrame, off_h: int, off_w: int, th: int, tw: int, pad_value) -> DataFrame:
    """Place the image at (off_h, off_w) inside a th x tw canvas filled with ``pad_value`` (a number, or one per
    channel); a target smaller than the placed image fails the job."""
    ok = (F.col("h") + off_h <= th) & (F.col("w") + off_w <= tw)
    g = _checked(cells(df, lambda img: padded(img, off_h, off_w, th, tw, pad_value)), ok, "target size smaller than image")
    return df.withColumn("data", g).withColumn("h", F.lit(th)).withColumn("w", F.lit(tw))


def _window(x: DataFrame, oh, ow, ch, cw, cols) -> DataFrame:
    ok = (_col(oh) >= 0) & (_col(ow) >= 0) & (_col(oh) + _col(ch) <= F.col("h")) & (_col(ow) + _col(cw) <= F.col("w"))
    for name, c in cols:
        g = cells(x, lambda img, a, b, p, q: cut(img, int(a), int(b), int(p), int(q)), oh, ow, ch, cw, col=name, c=c)
        x = x.withColumn(name, _checked(g, ok, "crop window larger than image"))
    return x.withColumn("h", _col(ch).cast("int")).withColumn("w", _col(cw).cast("int"))


def crop(df: DataFrame, off_h, off_w, ch, cw) -> DataFrame:
    """Window of ch x cw at (off_h, off_w) (columns or ints); a window beyond the image fails the job."""
    return _window(df, off_h, off_w, ch, cw, [("data", None)])


def random_crop(df: DataFrame, seed, ch: int, cw: int, label: str | None = None) -> DataFrame:
    """I4: one window, offsets in [0, size - crop] drawn per image id, cut from the image and, if named, from its
    one-channel ``label``; a label of another size fails the job."""
    oh = F.floor(md5_unit(seed, F.lit("h"), "image_id") * (F.col("h") - ch + 1)).cast("int")
    ow = F.floor(md5_unit(seed, F.lit("w"), "image_id") * (F.col("w") - cw + 1)).cast("int")
    x = df.withColumn("_y", oh).withColumn("_x", ow)
    cols = [("data", None)]
    if label:
        same = F.size(label) == F.col("h") * F.col("w")
        x = x.withColumn(label, _checked(F.col(label), same, "image and label differ in size"))
        cols.append((label, F.lit(1)))
    return _window(x, "_y", "_x", ch, cw, cols).drop("_y", "_x")


def resize_to(df: DataFrame, oh, ow, method: str = "bilinear", data_col: str = "data", c=None) -> DataFrame:
    """I6 / I7 / I8 with per-row output sizes (``oh``/``ow`` columns or ints), corners aligned; h and w stay."""
    f = RESIZE[method]
    return df.withColumn(data_col, cells(df, lambda img, a, b: f(img, int(a), int(b)), oh, ow, col=data_col, c=c))


def resize_bilinear(df: DataFrame, oh: int, ow: int) -> DataFrame:
    """I7 / I14."""
    return resize_to(df, oh, ow, "bilinear").withColumn("h", F.lit(oh)).withColumn("w", F.lit(ow))


def resize_nearest(df: DataFrame, oh: int, ow: int) -> DataFrame:
    """I8."""
    return resize_to(df, oh, ow, "nearest").withColumn("h", F.lit(oh)).withColumn("w", F.lit(ow))


def normalise(df: DataFrame, variant: str | None = "half_range") -> DataFrame:
    """``2/255 * x - 1``, or each channel less its mean, as the extractor variant (or kind) asks."""
    if input_kind(variant) == "half_range":
        return df.withColumn("data", F.transform("data", lambda x: x * (2.0 / 255.0) - 1.0))
    return df.withColumn("data", cells(df, lambda img: img - _pixel(MEAN_RGB, img.shape[2])))


def global_pool(df: DataFrame) -> DataFrame:
    """The average over the grid of every channel, ``pooled array<double>``."""
    return df.select("image_id", cells(df, lambda img: img.mean((0, 1))).alias("pooled"))


def checksum(df: DataFrame) -> DataFrame:
    """Compact, order-sensitive digest of each grid: ``sum(v_i * (i + 1))`` rounded to 6 places."""
    return df.select("image_id", "h", "w", F.round(digest("data"), 6).alias("checksum"))


def digest(data) -> Column:
    x = F.zip_with(_col(data), F.sequence(F.lit(1), F.size(_col(data))), lambda v, i: v * i)
    return F.aggregate(x, F.lit(0.0), lambda a, y: a + y)


def scale_dimension(dim: Column, scale: float) -> Column:
    """``int((dim - 1) * scale + 1)``."""
    return ((dim - 1).cast("double") * F.lit(scale) + 1).cast("int")


def resize_plan(dims: DataFrame, min_size: int, max_size: int | None, factor: int | None) -> DataFrame:
    """The size that resizing to a range gives, in float32 steps: the shorter side becomes ``min_size``, but where the
    longer one would pass ``max_size``, that one becomes ``max_size``. With a ``factor``, sides go up to the next number
    of the form ``k * factor + 1``; ``max_size`` first goes one such step below the next one."""

    def up(x):
        """Smallest k * factor + 1 not below x."""
        return F.ceil((x - 1) / factor).cast("int") * factor + 1 if isinstance(x, Column) else -(-(x - 1) // factor) * factor + 1

    def sized(edge: Column, target: int) -> tuple[Column, Column]:
        ratio = (F.lit(target).cast("float") / edge.cast("float")).cast("float")
        return tuple(F.ceil(F.col(d).cast("float") * ratio).cast("int") for d in ("h", "w"))

    nh, nw = sized(F.least("h", "w"), min_size)
    if max_size is not None:
        limit = max_size if factor is None else up(max_size) - factor
        over = F.greatest(nh, nw) > limit
        sh, sw = sized(F.greatest("h", "w"), limit)
        nh, nw = F.when(over, sh).otherwise(nh), F.when(over, sw).otherwise(nw)
    if factor is not None:
        nh, nw = up(nh), up(nw)
    return dims.withColumn("new_h", nh.cast("int")).withColumn("new_w", nw.cast("int"))


def layered_nearest(img: np.ndarray, oh: int, ow: int) -> np.ndarray:
    """Nearest resize of label layers stored one after the other."""
    h, w, k = img.shape
    side_by_side = np.moveaxis(img.ravel().reshape(k, h, w), 0, 2)
    return np.moveaxis(nearest(side_by_side, oh, ow), 2, 0)


def resize_to_range(df: DataFrame, min_size: int, max_size: int | None, factor: int | None, label: str | None = None, layers=None) -> DataFrame:
    """I9 on data: the image (bilinear) and, if named, its ``label`` (nearest, so labels stay labels) at the size of
    :func:`resize_plan`. The label has one channel, or ``layers`` (a column or number) of them, such as one per instance,
    stored layer after layer; each layer is resized by itself."""
    x = resize_to(resize_plan(df, min_size, max_size, factor), "new_h", "new_w", "bilinear")
    if label and layers is None:
        x = resize_to(x, "new_h", "new_w", "nearest", label, F.lit(1))
    elif label:
        x = x.withColumn(label, cells(x, lambda img, a, b: layered_nearest(img, int(a), int(b)), "new_h", "new_w", col=label, c=_col(layers)))
    return x.withColumn("h", F.col("new_h")).withColumn("w", F.col("new_w")).drop("new_h", "new_w")


def random_scale(df: DataFrame, seed, min_scale: float, max_scale: float, step: float) -> DataFrame:
    """min == max -> that value; step 0 -> uniform in [min, max); else one of ``int((max-min)/step + 1)`` values
    ``min + k*step``. A range with min > max fails."""
    if min_scale > max_scale:
        raise ValueError("min_scale must not exceed max_scale")
    u = md5_unit(seed, F.lit("scale"), "image_id")
    if min_scale == max_scale:
        s = F.lit(float(min_scale))
    elif step == 0:
        s = F.lit(min_scale) + u * F.lit(max_scale - min_scale)
    else:
        n = int((max_scale - min_scale) / step + 1)
        vals = F.array(*[F.lit(min_scale + k * step) for k in range(n)])
        s = F.element_at(vals, (F.floor(u * n) + 1).cast("int"))
    return df.withColumn("scale", s)


def batch_pad(df: DataFrame, batch_col: str, pad_value) -> DataFrame:
    """Pad each member to the largest height and width of its batch; only sizes are aggregated, and the images meet
    them in one join."""
    most = df.groupBy(batch_col).agg(F.max("h").alias("_th"), F.max("w").alias("_tw"))
    x = attach(df, most, [batch_col])
    g = cells(x, lambda img, a, b: padded(img, 0, 0, int(a), int(b), pad_value), "_th", "_tw")
    return x.withColumn("data", g).withColumn("h", F.col("_th")).withColumn("w", F.col("_tw")).drop("_th", "_tw")


def preprocess(images: DataFrame, seed, crop_h: int, crop_w: int, is_training: bool, variant: str | None = "half_range",
               ignore_label: float = 2.0, min_scale: float = 0.75, max_scale: float = 2.0, step: float = 0.25,
               min_size: int | None = None, max_size: int | None = None, factor: int | None = None) -> DataFrame:
    """I12 on ``(image_id, h, w[, c], data, label_data)``: an optional resize to a range (I9); training: random scale (I5),
    image bilinear and label nearest to ``trunc(dim * scale)`` (I6), pad both to at least the crop size (image with the
    variant's mean pixel, label with the ignore label, I2), one random window (I4) and one left-right flip (I1) for both;
    evaluation: pad the same way and resize to the crop size, the image bilinear, the label nearest."""
    x = images if min_size is None else resize_to_range(images, min_size, max_size, factor, "label_data")
    if is_training:
        x = random_scale(x, seed, min_scale, max_scale, step)
        x = x.withColumn("_nh", (F.col("h") * F.col("scale")).cast("int")).withColumn("_nw", (F.col("w") * F.col("scale")).cast("int")).drop("scale")
    else:
        x = x.withColumn("_nh", F.col("h")).withColumn("_nw", F.col("w"))
    x = x.withColumn("_th", F.greatest("_nh", F.lit(crop_h))).withColumn("_tw", F.greatest("_nw", F.lit(crop_w)))
    draw = lambda tag, n: F.floor(md5_unit(seed, F.lit(tag), "image_id") * n).cast("int") if is_training else F.lit(0)
    x = x.withColumn("_y", draw("h", F.col("_th") - crop_h + 1)).withColumn("_x", draw("w", F.col("_tw") - crop_w + 1))
    x = x.withColumn("flipped", md5_unit(seed, F.lit("flip"), "image_id") <= F.lit(0.5) if is_training else F.lit(False))

    def one(method: str, value):
        f = RESIZE[method]

        def run(img, nh, nw, th, tw, y, x, mirrored):
            if img.shape[:2] != (nh, nw):
                img = f(img, int(nh), int(nw))
            img = padded(img, 0, 0, int(th), int(tw), value)
            img = cut(img, int(y), int(x), crop_h, crop_w) if is_training else img if (th, tw) == (crop_h, crop_w) else f(img, crop_h, crop_w)
            return np.flip(img, 1) if mirrored else img

        return run

    args = ("_nh", "_nw", "_th", "_tw", "_y", "_x", "flipped")
    data = cells(x, one("bilinear", mean_pixel(variant)), *args)
    label = cells(x, one("nearest", ignore_label), *args, col="label_data", c=F.lit(1))
    x = x.withColumns({"data": data, "label_data": label, "h": F.lit(crop_h), "w": F.lit(crop_w)}).drop(*args[:-1])
    return x if is_training else x.drop("flipped")


def _turned(img: np.ndarray, quarters: int) -> np.ndarray:
    """``img`` turned counter-clockwise by one or two quarters about (w div 2, h div 2), the point that masks turn about
    (``runs.rotate_90``, ``runs.rotate_180``): the size stays, what leaves it is lost, and what nothing reaches is 0."""
    h, w = img.shape[:2]
    cx, cy = w // 2, h // 2
    y, x = np.mgrid[:h, :w]
    sy, sx = (2 * cy - y, 2 * cx - x) if quarters == 2 else (x - cx + cy, cx + cy - y)
    there = (sy >= 0) & (sy < h) & (sx >= 0) & (sx < w)
    out = np.zeros_like(img)
    out[there] = img[sy[there], sx[there]]
    return out


# fixed values: what the augmented copies of a training image are, by suffix in write order
AUGMENTED = {"": lambda a: a, "_a": lambda a: _turned(a, 2), "_b": lambda a: _turned(a, 1), "_f": lambda a: a[::-1]}


def augment(df: DataFrame, label: str | None = None) -> DataFrame:
    """I17 on images: one row per image and suffix (as it is, turned by 180 and 90 degrees, upside down), the one-channel
    ``label``, if named, along with it; image and mask turn about the same point and keep their size."""
    x = df.withColumn("suffix", F.explode(F.array(*[F.lit(s) for s in AUGMENTED])))
    out = {"data": cells(x, lambda img, s: AUGMENTED[s](img), "suffix")}
    if label:
        out[label] = cells(x, lambda img, s: AUGMENTED[s](img), "suffix", col=label, c=F.lit(1))
    return x.withColumns(out)


def validate_samples(images: DataFrame, label_h: str = "label_h", label_w: str = "label_w",
                     label_c: str | None = None) -> DataFrame:
    """Reason codes instead of exceptions: ``shape_mismatch`` (image and label sizes differ),
    ``bad_channels`` (not 1 or 3), ``bad_label_rank`` (a label with more than one channel, i.e. not [h, w] or
    [h, w, 1]), else ``ok``; ``strict_validate`` turns any failure into a job error."""
    reason = (F.when((F.col("h") != F.col(label_h)) | (F.col("w") != F.col(label_w)), "shape_mismatch")
              .when(~F.col("c").isin(1, 3), "bad_channels"))
    if label_c is not None:
        reason = reason.when(F.coalesce(F.col(label_c), F.lit(1)) != 1, "bad_label_rank")
    reason = reason.otherwise("ok")
    return images.withColumn("reason", reason)


def strict_validate(checked: DataFrame) -> DataFrame:
    return checked.withColumn("reason", F.when(F.col("reason") != "ok", F.raise_error(F.concat(F.lit("invalid sample: "), F.col("reason")))).otherwise(F.col("reason")))


# fixed values: evaluation scales and orientations of the multi-view inference
EVAL_SCALES = (0.75, 1.25, 1.75)
ORIENTATIONS = ("none", "lr", "ud")


def _oriented(img: np.ndarray, orientation: str) -> np.ndarray:
    return img[:, ::-1] if orientation == "lr" else img[::-1] if orientation == "ud" else img


def cross_views(images: DataFrame, scales=EVAL_SCALES, orientations=ORIENTATIONS) -> DataFrame:
    """Every image in every (scale, orientation) view, made in place (no join): resized to ``trunc(dim * scale)``
    (bilinear, corners aligned) and flipped left-right / up-down. The source size is kept as ``source_h``, ``source_w``."""
    views = [F.struct(F.lit(i * len(orientations) + j).alias("view"), F.lit(float(s)).alias("scale"), F.lit(o).alias("orientation"))
             for i, s in enumerate(scales) for j, o in enumerate(orientations)]
    x = images.withColumn("_v", F.explode(F.array(*views))).select("*", "_v.*").drop("_v")
    x = x.withColumn("_nh", (F.col("h") * F.col("scale")).cast("int")).withColumn("_nw", (F.col("w") * F.col("scale")).cast("int"))
    g = cells(x, lambda img, a, b, o: _oriented(bilinear(img, int(a), int(b)), o), "_nh", "_nw", "orientation")
    return x.withColumns({"data": g, "source_h": F.col("h"), "source_w": F.col("w"), "h": F.col("_nh"), "w": F.col("_nw")}).drop("_nh", "_nw")


def views_back(scored: DataFrame) -> DataFrame:
    """The way back of :func:`cross_views` for score maps (channels are classes): flipped back, resized to the source."""
    g = cells(scored, lambda img, a, b, o: bilinear(_oriented(img, o), int(a), int(b)), "source_h", "source_w", "orientation")
    return scored.withColumns({"data": g, "h": F.col("source_h"), "w": F.col("source_w")}).drop("source_h", "source_w")
