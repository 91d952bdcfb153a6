"""Structured Streaming versions of scoring and metrics.

The reference polls: it re-evaluates every 300 s and summarises scalars every 600 s. Here each is a streaming query
with a checkpoint under the shared folder of ``spark.checkpoint.dir``, so a restarted driver or lost executor resumes
from the last committed micro-batch. Sinks are idempotent per batch (``foreachBatch`` writes a folder per batch id,
and readers keep the newest row per key), which makes re-delivery after a failure harmless.

``run_available_now`` drains the current input and stops (tests, back-fills); production uses a processing-time
trigger.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from maskframe.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("_batch"))
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


def _batch_writer(out: str, keys: list[str], every: int | None, merge: Callable[[DataFrame], DataFrame] | None = None):
    """Writes a folder per batch. With ``every``, each batch whose number completes so many also merges (``merge``; without
    it, keeps the newest row of every key) the merge before and the batches since, and removes what the merge before that
    had replaced: at most 2 * ``every`` batches and two merges are there at any time. A replayed batch overwrites its
    folders with the same rows."""
    merge = merge or (lambda rows: _newest(rows, keys))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/_kind=batch/_part={batch_id}")
        if not every or (batch_id + 1) % every:
            return
        before = batch_id - every
        schema = StructType(list(batch.schema.fields)).add("_batch", "integer").add("_kind", "string").add("_part", "integer")
        rows = spark.read.schema(schema).parquet(out)
        since = F.col("_kind").eqNullSafe("merged") & (F.col("_part") == before) | (F.col("_kind") == "batch") & (F.col("_part") > before) & (F.col("_part") <= batch_id)
        merge(rows.filter(since).drop("_kind", "_part")).write.mode("overwrite").parquet(f"{out}/_kind=merged/_part={batch_id}")
        _remove(spark, f"{out}/_kind=merged/_part={before - every}")
        for b in range(max(before - every + 1, 0), before + 1):
            _remove(spark, f"{out}/_kind=batch/_part={b}")

    return write


def _current(out: str, spark: SparkSession) -> DataFrame:
    """The rows of a per-batch sink: the newest merge, if there is one, and the batches after it."""
    df = spark.read.parquet(out)
    merged = df.filter("_kind = 'merged'").agg(F.max("_part")).first()[0]
    if merged is not None:
        df = df.filter((F.col("_kind") == "merged") & (F.col("_part") == merged) | (F.col("_kind") == "batch") & (F.col("_part") > merged))
    return df.drop("_kind", "_part")


def latest_per_key(out: str, keys: list[str], spark: SparkSession) -> DataFrame:
    """Read a per-batch sink and keep the newest value of every key (update-mode semantics)."""
    return _newest(_current(out, spark), keys).drop("_batch")


class _Totals(StreamingQueryListener):
    """Counts over every batch of the queries started under ``name`` (a query itself remembers its last 100 only)."""

    def __init__(self, name: str):
        self.name, self.input_rows, self.late, self.batches, self.ended = name, 0, 0, 0, threading.Event()
        self.run = None

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event):
        p = event.progress
        if p.name == self.name:
            self.batches += 1
            self.input_rows += p.numInputRows
            self.late += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId == self.run:
            self.ended.set()


def metric_windows(stream: DataFrame, ts_col: str = "ts", tag_col: str = "tag", value_col: str = "value",
                   window: str = "600 seconds", watermark: str = "10 minutes", edges: tuple[float, ...] = ()) -> DataFrame:
    """Tumbling-window summaries of scalar metrics per tag; with ``edges`` also a histogram: ``bins[i]`` counts values
    from edge i - 1 up to edge i (the first and last are open). The watermark is an addition of ours (the reference has no
    late-data rule) so the aggregation state stays bounded; ``run_available_now`` counts the rows read, and those in no ``n`` came too late."""
    ts = F.col(ts_col)
    if dict(stream.dtypes)[ts_col] == "timestamp_ntz":
        # event time must be an instant: read the wall clock as UTC explicitly (independent of the session zone)
        ts = F.to_timestamp(F.concat(F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00")),
                            "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    stream = stream.withColumn("_et", ts)
    w = stream.withWatermark("_et", watermark).groupBy(F.window("_et", window).alias("w"), F.col(tag_col))
    v, bounds = F.col(value_col), [None, *edges, None]
    inside = [(F.lit(True) if lo is None else v >= lo) & (F.lit(True) if hi is None else v < hi) for lo, hi in zip(bounds[:-1], bounds[1:])]
    bins = [F.sum(F.coalesce(c, F.lit(False)).cast("bigint")).alias(f"_bin{i}") for i, c in enumerate(inside)] if edges else []
    shown = [F.array(*[F.col(f"_bin{i}") for i in range(len(bins))]).alias("bins")] if edges else []
    return w.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.avg(value_col).alias("avg_value"),
        F.min(value_col).alias("min_value"),
        F.max(value_col).alias("max_value"),
        *bins,
    ).select(F.unix_timestamp("w.start").alias("window_start"), tag_col, "n", "avg_value", "min_value", "max_value", *shown)


def running_confusion(stream: DataFrame, ckpt_col: str = "checkpoint", label_col: str = "label",
                      pred_col: str = "pred") -> DataFrame:
    """Running confusion counts per evaluated checkpoint (state = one counter per (checkpoint, label, pred))."""
    return stream.groupBy(ckpt_col, label_col, pred_col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def run_available_now(df: DataFrame, keys: list[str], name: str, mode: str = "update", base: str | None = None,
                      stats: dict | None = None, merge_every: int | None = 50) -> DataFrame:
    """Run a streaming aggregation to completion of the current input with a checkpoint, then return its result.
    Passing the same ``base`` again resumes from the committed offsets and state (a restart processes only new
    files). In update mode the sink is merged every ``merge_every`` batches, so its files stay bounded.

    ``stats``, if given, gets this run's ``batches``, ``input_rows`` (rows read) and ``late_sums``: the aggregation sees what
    is late only after adding it up within a task, so those are partial sums, of one row or more each. The rows themselves
    are the rows read less those counted in the results."""
    spark = df.sparkSession
    base = base or scratch(spark, name)
    title = f"{name}-{uuid.uuid4().hex[:12]}"
    totals = _Totals(title)
    if stats is not None:
        spark.streams.addListener(totals)
    try:
        q = (
            df.writeStream.outputMode(mode)
            .queryName(title)
            .option("checkpointLocation", f"{base}/_checkpoint")
            .foreachBatch(_batch_writer(f"{base}/out", keys, merge_every if mode == "update" else None))
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        if stats is not None:
            if not totals.ended.wait(60):
                raise TimeoutError(f"{title}: the listener did not see the end of the query")
            stats.update(batches=totals.batches, input_rows=totals.input_rows, late_sums=totals.late)
    finally:
        if stats is not None:
            spark.streams.removeListener(totals)
    return latest_per_key(f"{base}/out", keys, spark)


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None,
                glob: str | None = None) -> DataFrame:
    """A file source over a folder (optionally only files matching ``glob``) with the schema taken from the files
    already present (streaming sources need one)."""
    schema = spark.read.format(fmt).load(f"{path.rstrip('/')}/{glob}" if glob else path).schema
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def stream_score(spark: SparkSession, image_dir: str, model_fn, name: str = "stream-score") -> DataFrame:
    """Images arrive as Parquet chunks ``(image_id, data)`` in a shared folder and are scored as they come, with the
    batch scorer, checkpointed. (Folders of image files are turned into such chunks by Spark's ``image`` source.)"""
    from maskframe.operators.model import batch_score

    return run_available_now(batch_score(file_stream(spark, image_dir), model_fn), ["image_id"], name, mode="append")
