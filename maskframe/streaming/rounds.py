"""Timed evaluation rounds over a stream of predictions (SURVEY T2 and ML6 with the reference's clock).

A checkpoint is evaluated every ``every`` seconds, ``most`` times, and then no more. The clock is event time: a round's
result depends on the rows and not on when or in which batches they came, and a restart repeats nothing. Predictions are
added up within each task to cells (checkpoint, interval, label, prediction), so that a checkpoint with most of the rows
reaches its state as few of them; the state of a checkpoint is one confusion table, one more for each interval not yet
closed, and after its last round only the number of rounds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from maskframe.session import ship_package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: cells a task holds before it hands them on
HELD_CELLS = 100_000


def miou(cells: np.ndarray, classes: int) -> float | None:
    """Mean over the classes that occur in labels or predictions; None without any."""
    cm = cells[: classes * classes].reshape(classes, classes)
    hit, seen = np.diag(cm), cm.sum(0) + cm.sum(1) - np.diag(cm)
    return float((hit[seen > 0] / seen[seen > 0]).mean()) if seen.any() else None


class Rounds(StatefulProcessor):
    """Per checkpoint: counts by interval until the interval ends, then a round over everything so far."""

    def __init__(self, classes: int, every: int, most: int):
        self.classes, self.every, self.most = classes, every, most

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "at long", "cells array<long>")
        self.so_far = handle.getValueState("so_far", "cells array<long>")
        #: rounds given, and the start of the interval that the next one closes
        self.place = handle.getValueState("place", "given int, at long")

    def handleInputRows(self, key, rows, timerValues):
        given, due = self.place.get() if self.place.exists() else (0, None)
        batch: dict[int, np.ndarray] = {}
        for part in rows:
            for at, cell, n in zip(part["at"].to_numpy(np.int64), part["cell"].to_numpy(np.int64), part["n"].to_numpy(np.int64)):
                batch.setdefault(int(at), np.zeros(self.classes**2 + 1, np.int64))[cell] += n
        if given >= self.most:
            return
        if due is None or (given == 0 and min(batch) < due):
            if due is not None:
                self.handle.deleteTimer((due + self.every) * 1000)
            due = min(batch)
            self.handle.registerTimer((due + self.every) * 1000)
            self.place.update((given, due))
        for at, cells in batch.items():
            held = self.open.getValue((at,)) if self.open.containsKey((at,)) else None
            self.open.updateValue((at,), ((cells + np.array(held[0], np.int64) if held else cells).tolist(),))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        given, due = self.place.get()
        now = timerValues.getCurrentWatermarkInMs()
        total = np.array(self.so_far.get()[0], np.int64) if self.so_far.exists() else np.zeros(self.classes**2 + 1, np.int64)
        out = []
        while given < self.most and (due + self.every) * 1000 <= now:
            if self.open.containsKey((due,)):
                total = total + np.array(self.open.getValue((due,))[0], np.int64)
                self.open.removeKey((due,))
            given, due = given + 1, due + self.every
            out.append((key[0], given, due, int(total[:-1].sum()), int(total[-1]), miou(total, self.classes)))
        if given < self.most:
            self.handle.registerTimer((due + self.every) * 1000)
            self.so_far.update((total.tolist(),))
        else:
            self.open.clear()
            self.so_far.clear()
        self.place.update((given, due))
        frame = pd.DataFrame(out, columns=["checkpoint", "round", "until", "n", "left_out", "miou"])
        yield frame.astype({"round": "int32", "until": "int64", "n": "int64", "left_out": "int64", "miou": "float64"})

    def close(self) -> None:
        pass


def cells_by_task(rows: DataFrame, every: int) -> DataFrame:
    """``rows`` (checkpoint, second, cell) added up within each task: (checkpoint, at, event, cell, n). The checkpoint travels as
    text: pandas would turn long ids beside a null into doubles."""

    def add(batches):
        held = None
        for b in batches:
            b["at"] = b["second"] // every * every
            part = b.groupby(["checkpoint", "at", "cell"], dropna=False, sort=False).size().rename("n").reset_index()
            held = part if held is None else pd.concat([held, part]).groupby(["checkpoint", "at", "cell"], dropna=False, sort=False)["n"].sum().reset_index()
            if len(held) > HELD_CELLS:
                yield held
                held = None
        if held is not None:
            yield held

    return rows.withColumn("checkpoint", F.col("checkpoint").cast("string")).mapInPandas(add, "checkpoint string, at long, cell int, n long").withColumn("event", F.timestamp_seconds("at"))


def evaluation_rounds(stream: DataFrame, classes: int, checkpoint_col: str = "checkpoint", ts_col: str = "ts", label_col: str = "label",
                      pred_col: str = "pred", ignore_label: int | None = None, every: int = 300, most: int = 5, watermark: str = "10 minutes") -> DataFrame:
    """ML6 / T2: (checkpoint, round, until, n, left_out, miou), appended as rounds end.

    Intervals are ``every`` seconds, aligned to the epoch; the first round of a checkpoint closes the interval of its earliest
    row, and each takes in all its rows before ``until`` (epoch seconds). An interval without rows has its round too. After
    ``most`` rounds a checkpoint is closed and further rows of it change nothing. ``n`` counts the rows that weigh;
    ``left_out`` those of the ignored label and those whose label or prediction is null or no class. ``miou`` is null while
    ``n`` is 0. A null checkpoint is one of its own. Rows without a time belong to no interval and are not read; rows whose
    interval began before the watermark are late (``rejects`` keeps such rows of a metric stream).
    ``ts_col`` is an instant, or a wall clock read as UTC.

    Run it with ``state_store`` around the start: timers and maps need the RocksDB state store.
    """
    ship_package(stream.sparkSession)
    ts = F.col(ts_col)
    if dict(stream.dtypes)[ts_col] == "timestamp_ntz":
        ts = F.to_timestamp(F.concat(F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00")), "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    label, pred = F.col(label_col), F.col(pred_col)
    counts = label.between(0, classes - 1) & pred.between(0, classes - 1)
    if ignore_label is not None:
        counts = counts & (label != ignore_label)
    cell = F.when(counts, label * classes + pred).otherwise(classes * classes).cast("int")
    rows = stream.select(F.col(checkpoint_col).alias("checkpoint"), F.unix_timestamp(ts).alias("second"), cell.alias("cell")).filter("second IS NOT NULL")
    key = rows.schema["checkpoint"].dataType
    cells = cells_by_task(rows, every).withWatermark("event", watermark)
    schema = "checkpoint string, round int, until long, n long, left_out long, miou double"
    out = cells.groupBy("checkpoint").transformWithStateInPandas(Rounds(classes, every, most), schema, "Append", "EventTime")
    return out.withColumn("checkpoint", F.col("checkpoint").cast(key))


class state_store:
    """The RocksDB state store for the streaming queries started inside; the session's own choice is back afterwards."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(PROVIDER, None)
        self.spark.conf.set(PROVIDER, ROCKSDB)

    def __exit__(self, *_):
        if self.before is None:
            self.spark.conf.unset(PROVIDER)
        else:
            self.spark.conf.set(PROVIDER, self.before)
