"""Round trips through files written by the test itself."""

import os
import struct
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskframe.operators import model as ML
from maskframe.sources import io as IO


def test_annotation_csv_round_trip(spark):
    d = tempfile.mkdtemp(prefix="mf-csv-")
    p = os.path.join(d, "train.csv")
    with open(p, "w") as fh:
        fh.write("ImageId,EncodedPixels\na.jpg,1 2 5 1\nb.jpg,\nc.jpg,3 4\n")
    ann = IO.read_annotations(spark, p)
    rows = {r["ImageId"]: r["EncodedPixels"] for r in ann.collect()}
    assert rows == {"a.jpg": "1 2 5 1", "b.jpg": None, "c.jpg": "3 4"}
    out = os.path.join(d, "sub")
    IO.write_submission(ann, out)
    back = {r["ImageId"]: r["EncodedPixels"] for r in IO.read_annotations(spark, out).collect()}
    assert back == rows
    subs = IO.read_submissions(spark, [p, p])
    assert subs.groupBy("source").count().count() == 2


def test_shards_round_trip_and_pruning(spark):
    d = tempfile.mkdtemp(prefix="mf-shards-")
    recs = spark.range(23).select(F.when(F.col("id") < 15, "train").otherwise("val").alias("split"),
                                  F.col("id").alias("seq"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("sample"))
    recs = recs.withColumn("shard_id", (F.col("seq") % 4).cast("int"))
    man = IO.write_shards(recs, d, 4).collect()
    assert sum(r["n"] for r in man) == 23
    assert {r["shard_name"] for r in man if r["split"] == "val"} <= {f"val-{i:05d}-of-00004" for i in range(4)}
    val = IO.read_samples(spark, d, "val")
    assert val.count() == 8
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "split" in plan


def records(spark, n, split="train", extra=False):
    r = spark.range(n).select(F.lit(split).alias("split"), (F.col("id") % 2 * 2).cast("int").alias("shard_id"), F.col("id").alias("seq"),
                              F.concat(F.lit("s"), "id").alias("sample"))
    return r.withColumn("image/height", F.when(F.col("seq") % 3 == 0, 7).cast("bigint")) if extra else r


def test_shard_set_lists_empty_shards_and_keeps_its_schema(spark, tmp_path):
    root = str(tmp_path)
    man = {(r["split"], r["shard_id"]): (r["n"], r["shard_name"]) for r in IO.write_shards(records(spark, 9, "train-1", True), root, 4).collect()}
    assert man == {("train-1", i): ([5, 0, 4, 0][i], f"train-1-{i:05d}-of-00004") for i in range(4)}
    rows = IO.read_samples(spark, root, "train-1", ["image/height", "image/format", "image/label"])
    assert sorted(r["image/height"] for r in rows.collect()) == [0] * 6 + [7] * 3
    assert {(r["image/format"], r["image/label"]) for r in rows.collect()} == {("jpeg", None)}
    assert dict(rows.dtypes)["shard_id"] == "int" and dict(rows.dtypes)["split"] == "string"
    # a number of shards for each split, one of them without a row
    man = IO.write_shards(records(spark, 3), root, {"train": 3, "val": 2}).collect()
    assert sorted((r["split"], r["shard_id"], r["n"]) for r in man) == [("train", 0, 2), ("train", 1, 0), ("train", 2, 1), ("val", 0, 0), ("val", 1, 0)]
    assert IO.read_shards(spark, root).count() == 3 and "image/height" not in IO.read_shards(spark, root).columns
    assert IO.write_shards(records(spark, 0), root, 2).count() == 0 and IO.read_shards(spark, root).count() == 0


def test_a_write_that_dies_leaves_the_set_as_it_was(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(Exception):
        IO.read_shards(spark, root)
    IO.write_shards(records(spark, 8), root, 3)
    dies = records(spark, 500).withColumn("sample", F.when(F.col("seq") < 490, F.col("sample")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        IO.write_shards(dies, root, 3)
    # files of a version that never got its manifest
    records(spark, 40).write.partitionBy("split", "shard_id").parquet(f"{root}/data/version=dead")
    assert IO.read_shards(spark, root).count() == 8 and sum(r["n"] for r in IO.shard_manifest(spark, root).collect()) == 8
    IO.write_shards(records(spark, 500), root, 3)
    assert IO.read_shards(spark, root).count() == 500


def test_registry_lookup(spark):
    ok = IO.check_dataset(spark, "ship", "val").collect()
    assert ok[0]["num_samples"] == 852 and ok[0]["ignore_label"] == 2
    with pytest.raises(Exception):
        IO.check_dataset(spark, "ship", "test").collect()


def png(img):
    """A PNG file of an 8-bit image [h, w, c]: the container's fields, one unfiltered line after the other."""
    h, w, c = img.shape
    lines = b"".join(b"\0" + row.tobytes() for row in img)
    parts = [(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2}[c], 0, 0, 0)), (b"IDAT", zlib.compress(lines)), (b"IEND", b"")]
    return b"\x89PNG\r\n\x1a\n" + b"".join(struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d)) for t, d in parts)


def test_image_source_to_grids(spark):
    d = tempfile.mkdtemp(prefix="mf-png-")
    rng = np.random.default_rng(3)
    imgs = {"a": rng.integers(0, 256, (4, 6, 1), dtype=np.uint8), "00021ddc3": rng.integers(0, 256, (3, 5, 3), dtype=np.uint8)}
    for k, v in imgs.items():
        with open(os.path.join(d, f"{k}.png"), "wb") as fh:
            fh.write(png(v))
    st = {os.path.basename(r["path"]): (r["height"], r["width"], r["channels"], r["bytes"])
          for r in ML.image_stats(IO.scan_images(spark, d)).collect()}
    assert st == {"a.png": (4, 6, 1, 24), "00021ddc3.png": (3, 5, 3, 45)}
    got = {r["image_id"]: r for r in IO.image_grids(IO.scan_images(spark, d)).collect()}
    for k, v in imgs.items():
        assert (got[k]["h"], got[k]["w"], got[k]["c"]) == v.shape
        assert got[k]["data"] == v.astype(float).ravel().tolist()
    # images of different sizes are scored together, by text id
    masks = {r["image_id"]: r["data"] for r in ML.score_masks(IO.image_grids(IO.scan_images(spark, d))).collect()}
    for k, v in imgs.items():
        assert masks[k] == (v.mean(2) > 128).astype(float).ravel().tolist()


def test_image_files_to_records_to_shards_and_back(spark, tmp_path):
    rng = np.random.default_rng(4)
    files = {f"im {i}+%20.v{i}": png(rng.integers(0, 256, (2 + i, 3, 1 if i % 2 else 3), dtype=np.uint8)) for i in range(6)}
    folder = tmp_path / "images"
    folder.mkdir()
    for k, v in files.items():
        (folder / f"{k}.png").write_bytes(v)
    (folder / "torn.png").write_bytes(files["im 0+%20.v0"][:20])
    (folder / "notes.txt").write_text("no image")
    bad = IO.undecodable_images(spark, str(folder)).collect()
    assert sorted(os.path.basename(r["path"]) for r in bad) == ["notes.txt", "torn.png"] and {r["reason"] for r in bad} == {"undecodable"}
    images = IO.image_files(spark, str(folder))
    masks = images.filter("height < 6").select("image_id", F.concat("image_bytes", "image_bytes").alias("mask_bytes"))
    rec = IO.assemble_record(images, masks)
    rec = rec.withColumns({"split": F.lit("train"), "shard_id": F.col("image/height").cast("int") % 3, "seq": F.col("image/height")})
    root = str(tmp_path / "set")
    assert {r["shard_id"]: r["n"] for r in IO.write_shards(rec, root, 4).collect()} == {0: 2, 1: 2, 2: 2, 3: 0}
    got = {r["image_id"]: r for r in IO.read_samples(spark, root, "train", ["image/segmentation/class/encoded", "image/label"]).collect()}
    assert got.keys() == files.keys()
    for i, (k, v) in enumerate(files.items()):
        r = got[k]
        assert bytes(r["image/encoded"]) == v and r["image/format"] == "png" and r["image/filename"] == f"{k}.png"
        assert (r["image/height"], r["image/width"], r["image/channels"]) == (2 + i, 3, 1 if i % 2 else 3)
        assert bytes(r["image/segmentation/class/encoded"]) == (v + v if i < 4 else b"") and r["mask_missing"] == (i >= 4)
    labels = images.filter("height > 3").select("image_id", (F.col("height") % 2).alias("label"))
    own = {r["image_id"]: r for r in IO.assemble_classification_record(images, labels).collect()}
    assert {k: (bytes(r["image/encoded"]) == files[k], r["image/label"]) for k, r in own.items()} == {f"im {i}+%20.v{i}": (True, i % 2) for i in range(2, 6)}
