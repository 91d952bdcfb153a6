"""Streaming queries resume from their checkpoint: a restart reprocesses nothing and keeps the result; new files are
picked up incrementally and the running state stays exact."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

from maskframe.streaming import streams as ST


def test_running_confusion_resumes(spark):
    src = tempfile.mkdtemp(prefix="mf-stream-src-")
    base = tempfile.mkdtemp(prefix="mf-stream-ckpt-")
    rows = spark.range(300).select((F.col("id") % 3).cast("int").alias("checkpoint"), (F.col("id") % 4).cast("int").alias("label"),
                                   (F.col("id") % 5).cast("int").alias("pred"))
    rows.filter(F.col("id") < 150).coalesce(1).write.parquet(os.path.join(src, "part1"))
    stage = tempfile.mkdtemp(prefix="mf-stream-stage-")
    # the stream reads one flat folder; move the first file in, run, then add the second
    def add(sub):
        for f in os.listdir(os.path.join(src, sub)):
            if f.endswith(".parquet"):
                shutil.copy(os.path.join(src, sub, f), os.path.join(stage, f"{sub}-{f}"))
    add("part1")
    schema_src = spark.read.parquet(stage)
    def run():
        st = spark.readStream.schema(schema_src.schema).parquet(stage)
        return ST.run_available_now(ST.running_confusion(st), ["checkpoint", "label", "pred"], "t", base=base)
    first = {tuple(r[:3]): r["n"] for r in run().collect()}
    again = {tuple(r[:3]): r["n"] for r in run().collect()}
    assert first == again and sum(first.values()) == 150
    rows.filter(F.col("id") >= 150).coalesce(1).write.parquet(os.path.join(src, "part2"))
    add("part2")
    final = {tuple(r[:3]): r["n"] for r in run().collect()}
    want = {tuple(r[:3]): r["n"] for r in rows.groupBy("checkpoint", "label", "pred").count().withColumnRenamed("count", "n").collect()}
    assert final == want


def test_merged_sink_stays_small_and_late_rows_are_counted(spark):
    """More batches than a query remembers: every row read is in a result or late, and the sink keeps few folders."""
    src, base = tempfile.mkdtemp(prefix="mf-stream-many-"), tempfile.mkdtemp(prefix="mf-stream-sink-")
    n = 110
    ids = spark.range(n * 4).withColumn("file", (F.col("id") / 4).cast("int"))
    # each file is 300 s on; from the 20th on, one of its four rows is as old as the first file
    at = F.when((F.col("id") % 4 == 3) & (F.col("file") >= 20), 0).otherwise(F.col("file") * 300)
    rows = ids.select(F.timestamp_seconds(F.lit(1_700_000_400) + at).alias("ts"), F.lit("a").alias("tag"), F.col("id").cast("double").alias("value"), "file")
    for i, part in enumerate(rows.toPandas().groupby("file", sort=True)):
        spark_rows = part[1].drop(columns="file")
        spark_rows.astype({"ts": "datetime64[us]"}).to_parquet(os.path.join(src, f"{i:04d}.parquet"), index=False)
        os.utime(os.path.join(src, f"{i:04d}.parquet"), (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema("ts timestamp_ntz, tag string, value double").option("maxFilesPerTrigger", 1).parquet(src)
    stats = {}
    out = ST.run_available_now(ST.metric_windows(stream), ["window_start", "tag"], "many", base=base, stats=stats, merge_every=20).collect()
    late = n - 20
    assert stats["batches"] > 100 and stats["input_rows"] == n * 4
    assert sum(r["n"] for r in out) == n * 4 - late and stats["late_sums"] == late
    assert len({r["window_start"] for r in out}) == len(out) == n * 300 // 600
    kept = {k: os.listdir(os.path.join(base, "out", f"_kind={k}")) for k in ("batch", "merged")}
    assert len(kept["merged"]) == 2 and len(kept["batch"]) <= 40
    again = ST.run_available_now(ST.metric_windows(stream), ["window_start", "tag"], "many", base=base, merge_every=20).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))
