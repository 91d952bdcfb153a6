"""Sources and sinks.

Reads use explicit schemas (no inference pass over 100 TB), writes are partitioned so that split / shard pruning
happens at the file listing, and every writer is deterministic so a retried task rewrites identical output.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from maskframe.functions.names import shard_name

ANNOTATION_SCHEMA = "ImageId string, EncodedPixels string"

# fixed values: the dataset descriptors (name, split, samples, classes, ignore label)
REGISTRY = (
    ("cityscapes", "train", 2975, 19, 255),
    ("cityscapes", "val", 500, 19, 255),
    ("pascal_voc_seg", "train", 1464, 21, 255),
    ("pascal_voc_seg", "train_aug", 10582, 21, 255),
    ("pascal_voc_seg", "trainval", 2913, 21, 255),
    ("pascal_voc_seg", "val", 1449, 21, 255),
    ("ship", "train", 19875, 2, 2),
    ("ship", "val", 852, 2, 2),
    ("ade20k", "train", 20210, 151, 0),
    ("ade20k", "val", 2000, 151, 0),
    ("ship_classification", "train", 13738, 2, None),
    ("ship_classification", "val", 724, 2, None),
)
REGISTRY_SCHEMA = "name string, split string, num_samples bigint, num_classes int, ignore_label int"

# fixed values: record field names and their read-back defaults
FIELD_TYPES = {"image/encoded": "binary", "image/filename": "string", "image/format": "string", "image/height": "bigint",
               "image/width": "bigint", "image/channels": "bigint", "image/segmentation/class/encoded": "binary",
               "image/segmentation/class/format": "string", "image/label": "bigint"}
READ_DEFAULTS = {"image/encoded": b"", "image/filename": "", "image/format": "jpeg", "image/height": 0,
                 "image/width": 0, "image/segmentation/class/encoded": b"", "image/segmentation/class/format": "png"}


def read_annotations(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Annotation CSV with a header; an empty field is null (no ship)."""
    return spark.read.schema(ANNOTATION_SCHEMA).option("header", True).csv(path)


def read_submissions(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several prediction CSVs with a ``source`` tag (the file's position in ``paths``)."""
    out = None
    for i, p in enumerate(paths):
        df = read_annotations(spark, p).withColumn("source", F.lit(i))
        out = df if out is None else out.unionByName(df)
    return out


def write_submission(df: DataFrame, path: str) -> None:
    """Two-column CSV with a header; null stays an empty field."""
    df.select("ImageId", "EncodedPixels").write.mode("overwrite").option("header", True).csv(path)


def scan_image_files(spark: SparkSession, folder: str, glob: str = "*.{jpg,jpeg,png}") -> DataFrame:
    """S3: list and read a folder of image files (``binaryFile``: path, modificationTime, length, content)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)


def scan_images(spark: SparkSession, folder: str) -> DataFrame:
    """S3 with decoding by Spark's ``image`` source (origin, height, width, nChannels, mode, data; BGR order). Files that
    cannot be decoded are the rows of :func:`undecodable_images` instead."""
    return spark.read.format("image").load(folder).filter(F.col("image.height") >= 0)


def image_path() -> F.Column:
    """The file's path as ``binaryFile`` names it; the ``image`` source escapes it, and differs in slashes after the scheme."""
    plain = F.url_decode(F.replace(F.col("image.origin"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, r"^(\w+):/+", "$1:/")


def undecodable_images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, reason): the files of ``folder`` that :func:`scan_images` leaves out."""
    bad = spark.read.format("image").load(folder).filter(F.col("image.height") < 0)
    return bad.select(image_path().alias("path"), F.lit("undecodable").alias("reason"))


def image_files(spark: SparkSession, folder: str, glob: str = "*.{jpg,jpeg,png}") -> DataFrame:
    """S3 + S9: (image_id, filename, height, width, channels, image_bytes) of every decodable file that ``glob`` matches,
    ``image_bytes`` being the file as it is. The two scans meet by path."""
    i = F.col("image")
    dims = scan_images(spark, folder).select(image_path().alias("path"), i["height"].alias("height"), i["width"].alias("width"), i["nChannels"].alias("channels"))
    files = scan_image_files(spark, folder, glob).select(F.regexp_replace("path", r"^(\w+):/+", "$1:/").alias("path"), F.col("content").alias("image_bytes"))
    name = F.element_at(F.split("path", "/"), -1)
    both = files.join(dims, "path").withColumn("filename", name)
    return both.select(F.regexp_extract("filename", r"^(.+?)(\.[^.]*)?$", 1).alias("image_id"), "filename", "height", "width", "channels", "image_bytes")


def image_grids(images: DataFrame) -> DataFrame:
    """Decoded images (``scan_images``) as grids ``(image_id, h, w, c, data array<double>)``; the id is the file's stem, the
    channels come in red, green, blue order. The bytes become numbers in Arrow batches."""
    def run(data: pd.Series, c: pd.Series) -> pd.Series:
        px = [np.frombuffer(bytes(d), np.uint8).reshape(-1, int(k)) for d, k in zip(data, c, strict=True)]
        return pd.Series([(p[:, 2::-1] if p.shape[1] == 3 else p).astype(np.float64).ravel() for p in px], dtype="object")

    i = F.col("image")
    stem = F.regexp_extract(image_path(), r"([^/]+?)(\.[^./]*)?$", 1)
    return images.select(stem.alias("image_id"), i["height"].alias("h"), i["width"].alias("w"), i["nChannels"].alias("c"),
                         F.pandas_udf(run, "array<double>")(i["data"], i["nChannels"]).alias("data"))


def dataset_registry(spark: SparkSession) -> DataFrame:
    """The dataset descriptors as a tiny table (broadcast when joined)."""
    return spark.createDataFrame(list(REGISTRY), REGISTRY_SCHEMA)


def check_dataset(spark: SparkSession, name: str, split: str) -> DataFrame:
    """S7 lookup: the descriptor row; an unknown name or split is an error. The registry is a fixed constant, so the
    check runs on the driver against it before any job is planned."""
    if not any(r[0] == name and r[1] == split for r in REGISTRY):
        raise ValueError(f"unknown dataset or split: {name}/{split}")
    reg = dataset_registry(spark)
    return reg.filter((F.col("name") == name) & (F.col("split") == split))


def audit_split_sizes(samples: DataFrame, registry: DataFrame, name: str, split_col: str = "split") -> DataFrame:
    """Declared split sizes (hand-kept in the reference) against actual counts; full outer join on split."""
    actual = samples.groupBy(F.col(split_col).alias("split")).agg(F.count(F.lit(1)).cast("bigint").alias("actual"))
    declared = registry.filter(F.col("name") == name).select("split", F.col("num_samples").alias("declared"))
    j = F.broadcast(declared).join(actual, "split", "full")
    return j.select(F.lit(name).alias("name"), "split", "declared", "actual",
                    (F.coalesce("actual", F.lit(0)) - F.coalesce("declared", F.lit(0))).alias("diff"))


# what a shard set's manifest holds; the row without a split speaks for the whole version
MANIFEST_SCHEMA = "version string, written_at bigint, schema string, split string, shard_id int, shard_name string, n bigint"


def write_shards(records: DataFrame, root: str, num_shards: int | dict[str, int], split_col: str = "split", shard_col: str = "shard_id",
                 order_col: str = "seq") -> DataFrame:
    """One folder per (split, shard). Rows are range-partitioned by (split, shard, sequence), so a shard is written by
    as many tasks as its rows need, each file a sorted stretch of the sequence and the files in its order. ``num_shards`` is
    one number, or a number for each split.

    A set is written as a new version under ``root`` and becomes visible, as a whole, with its manifest: one small file,
    appended last. A write that dies before leaves the set that was there, and a rerun starts a version of its own. The rows
    written are counted as they pass and must be those the files hold. Returns the manifest ``(split, shard_id, n,
    shard_name)``, shards without rows included; versions of before stay until their folders are removed."""
    spark, version = records.sparkSession, uuid.uuid4().hex
    data, passed = f"{root}/data/version={version}", Observation()
    out = records.repartitionByRange(split_col, shard_col, order_col).sortWithinPartitions(split_col, shard_col, order_col)
    out.observe(passed, F.count(F.lit(1)).alias("rows")).write.partitionBy(split_col, shard_col).parquet(data)
    held = spark.read.schema(records.schema).parquet(data)  # no column is read: the footers count
    done = held.groupBy(F.col(split_col).alias("split"), F.col(shard_col).cast("int").alias("shard_id")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    rows = done.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if rows != passed.get["rows"]:
        raise RuntimeError(f"{data}: {passed.get['rows']} rows were written and {rows} are there; the version is not committed")
    if isinstance(num_shards, dict):
        splits = spark.createDataFrame(list(num_shards.items()), "split string, shards int")
    else:
        splits = done.select("split").distinct().withColumn("shards", F.lit(num_shards))
    want = splits.filter("shards > 0").select("split", "shards", F.explode(F.expr("sequence(0, shards - 1)")).alias("shard_id"))
    of = F.coalesce("shards", F.col("shard_id") + 1)
    listed = want.join(done, ["split", "shard_id"], "full").select(
        F.lit(None).cast("string").alias("schema"), "split", "shard_id", shard_name("split", "shard_id", of).alias("shard_name"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    head = spark.createDataFrame([(json.dumps(records.schema.jsonValue()), None, None, None, rows)], "schema string, split string, shard_id int, shard_name string, n bigint")
    both = head.unionByName(listed).select(F.lit(version).alias("version"), F.lit(time.time_ns() // 1000).alias("written_at"), "*")
    both.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return shard_manifest(spark, root, version).withColumnsRenamed({"split": split_col, "shard_id": shard_col})


def committed(spark: SparkSession, root: str) -> tuple[str, StructType]:
    """The newest committed version under ``root`` and the schema of its rows."""
    heads = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/manifest").filter("schema IS NOT NULL")
    head = heads.orderBy(F.desc("written_at"), F.desc("version")).first()
    if head is None:
        raise FileNotFoundError(f"no committed shard set under {root}")
    return head["version"], StructType.fromJson(json.loads(head["schema"]))


def shard_manifest(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """(split, shard_id, n, shard_name) of a version, by default the newest committed one."""
    version = version or committed(spark, root)[0]
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/manifest")
    return rows.filter((F.col("version") == version) & F.col("schema").isNull()).select("split", "shard_id", "n", "shard_name")


def read_shards(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the newest committed version, with the schema they were written with (no file is read for it)."""
    version, schema = committed(spark, root)
    return spark.read.schema(schema).parquet(f"{root}/data/version={version}")


def read_samples(spark: SparkSession, root: str, split: str, fields: Sequence[str] = ()) -> DataFrame:
    """One split of the shards (partition pruning on ``split``). Of ``fields``, those without a value, or absent from
    the set altogether, read as their defaults (null where a field has none)."""
    df = read_shards(spark, root).filter(F.col("split") == split)
    for f in fields:
        default = F.lit(READ_DEFAULTS.get(f)).cast(FIELD_TYPES.get(f, "string"))
        df = df.withColumn(f, F.coalesce(F.col(f"`{f}`"), default) if f in df.columns else default)
    return df


def image_format(name_col) -> F.Column:
    """File format normalised from the name: jpg / jpeg -> 'jpeg', png -> 'png'."""
    ext = F.lower(F.regexp_extract(name_col, r"\.([A-Za-z]+)$", 1))
    return F.when(ext.isin("jpg", "jpeg"), "jpeg").when(ext == "png", "png").otherwise(ext)


def assemble_record(images: DataFrame, masks: DataFrame | None, id_col: str = "image_id") -> DataFrame:
    """S9 + J7: image (+ mask) -> one training record with the reference's field names. A left join keeps images
    whose mask is missing, so the gap is reported (``mask_missing``) instead of silently dropped."""
    j = images if masks is None else images.join(masks, id_col, "left")
    cols = [
        F.col("image_bytes").alias("image/encoded"), F.col("filename").alias("image/filename"),
        image_format(F.col("filename")).alias("image/format"), F.col("height").cast("bigint").alias("image/height"),
        F.col("width").cast("bigint").alias("image/width"),
        (F.col("channels") if "channels" in images.columns else F.lit(3)).cast("bigint").alias("image/channels"),
    ]
    if masks is not None:
        cols += [F.col("mask_bytes").alias("image/segmentation/class/encoded"),
                 F.lit("png").alias("image/segmentation/class/format"), F.col("mask_bytes").isNull().alias("mask_missing")]
    return j.select(id_col, *cols)


def assemble_classification_record(images: DataFrame, labels: DataFrame, id_col: str = "image_id") -> DataFrame:
    """Image joined to its ``label`` -> one classification record; images without a label are not records."""
    rec = assemble_record(images, None, id_col)
    return rec.join(labels.select(id_col, F.col("label").cast("bigint").alias("image/label")), id_col)


def split_projection(samples: DataFrame, label_cols, split_col: str = "split", name_col: str | None = None) -> DataFrame:
    """The ``test`` split carries no labels (set to null), and a missing sample name becomes ``''``."""
    out = samples
    for c in label_cols:
        out = out.withColumn(c, F.when(F.col(split_col) == "test", F.lit(None)).otherwise(F.col(c)))
    if name_col:
        out = out.withColumn(name_col, F.coalesce(F.col(name_col), F.lit("")))
    return out
