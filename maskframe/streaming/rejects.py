"""Windowed metrics that keep what they leave out: late and broken rows are an output, not a loss.

Spark's own aggregation drops a late row inside the operator, where only partial sums of it are counted. Here each
micro-batch is split before it is added up: rows on time go into partial sums by window, all others into a table of rejects
with their reason. The clock is the latest event time of the batches before, kept as one row a batch, so a replayed batch is
split as it was the first time and overwrites its own folders: rows read = rows in windows + rows in rejects, always.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskframe.streaming.streams import _batch_writer, _current, scratch

CLOCK = "top long, n_rows long, n_kept long"


def _partials(rows: DataFrame) -> DataFrame:
    """Partial sums of one window and tag added up."""
    sums = [F.sum(c).alias(c) for c in ("n", "total")]
    return rows.groupBy("window_start", "tag").agg(*sums, F.min("least").alias("least"), F.max("most").alias("most"), F.max("_batch").alias("_batch"))


def _splitter(base: str, ts_col: str, tag_col: str, value_col: str, window: int, delay: int, merge_every: int | None):
    add = _batch_writer(f"{base}/out", ["window_start", "tag"], merge_every, _partials)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(CLOCK).parquet(f"{base}/clock/_part={batch_id - 1}").first()["top"] if batch_id else None
        second = F.unix_timestamp(F.col(ts_col))
        start = F.floor(second / window) * window
        reason = F.when(second.isNull(), "no_time").when(F.col(value_col).isNull() | F.isnan(F.col(value_col).cast("double")), "no_value")
        if before is not None:
            reason = reason.when(start + window <= before - delay, "late")
        marked = batch.select(F.struct(*batch.columns).alias("row"), second.alias("second"), start.cast("bigint").alias("start"), reason.alias("reason")).persist()
        try:
            kept = marked.filter("reason IS NULL")
            v = F.col("row").getField(value_col).cast("double")
            sums = [F.count(F.lit(1)).alias("n"), F.sum(v).alias("total"), F.min(v).alias("least"), F.max(v).alias("most")]
            add(kept.groupBy(F.col("start").alias("window_start"), F.col("row").getField(tag_col).alias("tag")).agg(*sums), batch_id)
            out = marked.filter("reason IS NOT NULL").select("row", "reason", F.lit(batch_id).cast("bigint").alias("batch"))
            out.write.mode("overwrite").parquet(f"{base}/rejects/_part={batch_id}")
            top = F.greatest(F.max(F.when(F.col("reason").isNull(), F.col("second"))), F.lit(before).cast("bigint"))
            clock = marked.agg(top.alias("top"), F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("reason").isNull(), 1)).alias("n_kept"))
            clock.write.mode("overwrite").parquet(f"{base}/clock/_part={batch_id}")
        finally:
            marked.unpersist()

    return write


def windows_and_rejects(stream: DataFrame, ts_col: str = "ts", tag_col: str = "tag", value_col: str = "value", window: int = 600, delay: int = 600,
                        base: str | None = None, merge_every: int | None = 50) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs the stream to the end of its present input (again with the same ``base``: only what is new) and returns
    (windows, rejects, batches).

    * windows: (window_start in epoch seconds, tag, n, avg_value, min_value, max_value), windows aligned to the epoch. A null
      tag is a tag of its own.
    * rejects: (row, reason, batch), ``row`` the whole row as it came, whatever its columns are called. Reasons, the first
      that holds: ``no_time``, ``no_value`` (null or not a number), ``late`` (the window had ended ``delay`` seconds or more
      before the latest time on time of the batches before; rows of one batch are not late for each other).
    * batches: (n_rows, n_kept, top) by ``_part``; summed, n_rows - n_kept is the number of rejects.

    Partial sums are merged every ``merge_every`` batches. ``ts_col`` is an instant, or a wall clock read in the session's zone.
    """
    spark = stream.sparkSession
    base = base or scratch(spark, "windows-rejects")
    schema = stream.schema
    write = _splitter(base, ts_col, tag_col, value_col, window, delay, merge_every)
    q = stream.writeStream.option("checkpointLocation", f"{base}/_checkpoint").foreachBatch(write).trigger(availableNow=True).start()
    q.awaitTermination()
    return _results(spark, base, schema, tag_col)


def _results(spark: SparkSession, base: str, schema, tag_col: str):
    row = schema.simpleString()
    tag = next(f.dataType.simpleString() for f in schema.fields if f.name == tag_col)
    if not _exists(spark, f"{base}/out"):  # a stream without a batch
        return (
            spark.createDataFrame([], f"window_start long, tag {tag}, n long, avg_value double, min_value double, max_value double"),
            spark.createDataFrame([], f"row {row}, reason string, batch long"),
            spark.createDataFrame([], CLOCK + ", _part int"),
        )
    sums = _partials(_current(f"{base}/out", spark))
    windows = sums.select("window_start", "tag", "n", (F.col("total") / F.col("n")).alias("avg_value"), F.col("least").alias("min_value"), F.col("most").alias("max_value"))
    rejects = spark.read.schema(f"row {row}, reason string, batch long").parquet(*_parts(spark, f"{base}/rejects"))
    return windows, rejects, spark.read.schema(CLOCK + ", _part int").parquet(f"{base}/clock")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _parts(spark: SparkSession, path: str) -> Sequence[str]:
    return [f"{path}/*"] if _exists(spark, path) else []
