"""Bridge views: the driver's tables re-shaped into the reference's inputs (FIXTURES.md section C).

Every view is derived by Spark from the given tables, so its size grows with them. The reference's own inputs
(annotation CSV, submission CSVs, image folders, records) are read by ``maskframe.sources.io``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskframe.functions.classes import CANVAS_H, CANVAS_W
from maskframe.functions.rle import let


ROWS_A_PART = 400_000  # instances in a partition of a large table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rectangular ship per lineitem: columns x0..x0+w-1, rows y0..y0+h-1."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"),
        F.col("l_quantity").cast("bigint").alias("w"),
        (F.lit(1) + F.col("l_partkey") % 97).alias("h"),
        ((F.col("l_suppkey") * 37 + F.col("l_linenumber") * 101) % 719).alias("x0"),
        ((F.col("l_partkey") * 53) % 672).alias("y0"),
    )


def rect_rle(x0, y0, w, h, height: int = CANVAS_H, max_col: int = CANVAS_W):
    """RLE text of a rectangle, one run per column, columns at or beyond ``max_col`` dropped. The starts are a sequence in steps
    of the height, joined by the length: no lambda runs per column. Rows that reach the border, have no column or lack a
    value go by :func:`rect_rle_columns`. The text is never null, which Spark can see, so a test for null builds none."""
    first = x0 * height + y0 + 1
    starts = F.sequence(first, first + (w - 1) * height, F.lit(height).cast("bigint"))
    length = F.concat(F.lit(" "), h.cast("string"))
    plain = F.concat(F.call_function("concat_ws", F.concat(length, F.lit(" ")), starts.cast("array<string>")), length)
    usual = (w >= 1) & (x0 + w <= max_col) & y0.isNotNull() & h.isNotNull()
    return F.concat_ws("", F.when(usual, plain).otherwise(rect_rle_columns(x0, y0, w, h, height, max_col)))


def rect_rle_columns(x0, y0, w, h, height: int = CANVAS_H, max_col: int = CANVAS_W):
    """:func:`rect_rle` of any row. One lambda writes a column's pair; the length is written once a row, and columns are
    filtered only in rows that reach the border."""
    def body(v):
        cols = F.transform(F.sequence(F.lit(0).cast("bigint"), v["w"] - 1), lambda i: v["x0"] + i)
        inside = F.when(v["x0"] + F.greatest(v["w"], F.lit(2)) <= max_col, cols).otherwise(F.filter(cols, lambda c: c < max_col))
        return F.concat_ws(" ", F.transform(inside, lambda c: F.concat((c * height + v["y1"]).cast("string"), v["h"])))

    row = F.struct(x0.alias("x0"), (y0 + 1).alias("y1"), w.alias("w"), F.concat(F.lit(" "), h.cast("string")).alias("h"))
    return let(row, body)


def _with_all_images(spark: SparkSession, sf_dir: str, inst: DataFrame, encoded) -> DataFrame:
    """orders LEFT JOIN instances. Both sides are hash-partitioned on the image name before the join: the inputs are
    single-row-group files (one scan task), and the text built after the join is the CPU-heavy part. Only the narrow
    columns travel; the rows of an image stay together (and in a sort-merge join in order), so that what groups by the image
    afterwards needs no exchange of texts or runs. The rows grow many times where the text is built, so large tables (their
    rows are counted from the files' footers) get a partition per ``ROWS_A_PART`` rows; for small ones the number is the
    session's, and adaptive execution fits it to the data."""
    rows = table(spark, sf_dir, "lineitem").count()
    parts = [-(-rows // ROWS_A_PART)] if rows >= 8 * ROWS_A_PART else []
    name = lambda key: F.concat(F.col(key).cast("string"), F.lit(".jpg"))
    orders = table(spark, sf_dir, "orders").select(name("o_orderkey").alias("ImageId")).repartition(*parts, "ImageId")
    inst = inst.withColumn("_image", name("k")).repartition(*parts, "_image")
    j = orders.join(inst, orders["ImageId"] == inst["_image"], "left")
    return j.select(
        "ImageId",
        F.when(F.col("_image").isNull(), F.lit(None).cast("string")).otherwise(encoded).alias("EncodedPixels"),
    )


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ImageId, EncodedPixels)``: one row per instance, one null row per image without ships."""
    inst = instances(spark, sf_dir)
    return _with_all_images(spark, sf_dir, inst, rect_rle(F.col("x0"), F.col("y0"), F.col("w"), F.col("h")))


def submission(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Two prediction files: ``a`` = instances with line number <= 4, ``b`` = line number >= 3."""
    inst = instances(spark, sf_dir)
    inst = inst.filter(F.col("ln") <= 4) if which == "a" else inst.filter(F.col("ln") >= 3)
    return _with_all_images(spark, sf_dir, inst, rect_rle(F.col("x0"), F.col("y0"), F.col("w"), F.col("h")))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotations(spark, sf_dir)


def prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifted instances (``x0 + ln % 3``, clipped to the canvas), line 7 left out; null row when none."""
    inst = instances(spark, sf_dir).filter(F.col("ln") != 7)
    enc = rect_rle(F.col("x0") + F.col("ln") % 3, F.col("y0"), F.col("w"), F.col("h"))
    return _with_all_images(spark, sf_dir, inst, enc)


def grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding as an 8x8 one-channel image in long form ``(image_id, row, col, v, px, label)``."""
    emb = table(spark, sf_dir, "embeddings")
    e = emb.select("vec_id", "label", F.posexplode("embedding").alias("pos", "val"))
    return e.select(
        F.col("vec_id").alias("image_id"),
        (F.col("pos") / 8).cast("int").alias("row"),
        (F.col("pos") % 8).alias("col"),
        F.col("val").cast("double").alias("v"),
        F.floor((F.col("val").cast("double") + 1) * 127.5).cast("int").alias("px"),
        F.col("label"),
    )


def grid_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same 8x8 images as one row each: ``(image_id, h, w, c, data array<double>, label)``, row-major."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("image_id"),
        F.lit(8).alias("h"),
        F.lit(8).alias("w"),
        F.lit(1).alias("c"),
        F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 127.5).cast("double")).alias(
            "data"
        ),
        F.col("label"),
    )


def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine views of ten class logits per embedding: ``(image_id, view, class, logit, label)``. Each logit is a sum over
    ALL values of the vector, in 1/1024 steps and with whole weights, so it is exact in any order of addition."""
    emb = table(spark, sf_dir, "embeddings")
    q = emb.select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024).cast("bigint")).alias("q"))
    e = q.select("vec_id", "label", "q", F.explode(F.sequence(F.lit(0), F.lit(89))).alias("n"))
    e = e.select("vec_id", "label", "q", F.floor(F.col("n") / 10).cast("int").alias("view"), (F.col("n") % 10).alias("class"))
    terms = F.transform("q", lambda x, i: x * ((i * (F.col("view") + 1) + F.col("class") * (F.col("class") + 3) + F.col("view") * F.col("class")) % 7 - 3))
    total = F.aggregate(terms, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return e.select(F.col("vec_id").alias("image_id"), "view", "class", (total / F.lit(1024.0)).alias("logit"), "label")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("image_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("features"),
        F.col("label"),
    )


def metric_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("ts"), F.col("event_type").alias("tag"), F.col("value"))
