"""Late and broken rows come out with their reason: rows read = rows in windows + rows in rejects, over restarts too."""

import math
import os
import tempfile

import pandas as pd

from maskframe.streaming import rejects as RJ

T0 = 1_700_000_400
SCHEMA = "ts timestamp, tag string, value double, reason string, second long, row string"


def arrive(src, n, rows):
    f = pd.DataFrame(rows, columns=["ts", "tag", "value"])
    f["ts"] = pd.to_datetime(f["ts"], unit="s", utc=True).astype("datetime64[us, UTC]")
    f["reason"], f["second"], f["row"] = "its own", 7, f["value"].astype(str)
    f.to_parquet(f"{src}/{n:04d}.parquet", index=False)
    os.utime(f"{src}/{n:04d}.parquet", (T0 + n, T0 + n))


def plain(batches, window=600, delay=600):
    """The wording of the split, batch by batch: ({(window, tag): values}, [(value, reason)])."""
    top, kept, out = None, {}, []
    for rows in batches:
        seen = top
        for ts, tag, value in rows:
            if ts is None:
                out.append((value, "no_time"))
            elif value is None or math.isnan(value):
                out.append((value, "no_value"))
            elif seen is not None and ts // window * window + window <= seen - delay:
                out.append((value, "late"))
            else:
                kept.setdefault((ts // window * window, tag), []).append(value)
                top = ts if top is None else max(top, ts)
    return kept, out


def check(got, batches):
    windows, rejects, clocks = got
    kept, out = plain(batches)
    w = {(r["window_start"], r["tag"]): (r["n"], r["avg_value"], r["min_value"], r["max_value"]) for r in windows.collect()}
    assert w == {k: (len(v), sum(v) / len(v), min(v), max(v)) for k, v in kept.items()}
    key = lambda x: (str(x[0]), x[1])
    assert sorted(((r["row"]["value"], r["reason"]) for r in rejects.collect()), key=key) == sorted(out, key=key)
    c = clocks.toPandas()
    assert c["n_rows"].sum() == sum(map(len, batches)) == c["n_kept"].sum() + len(out)


def test_every_row_is_in_a_window_or_a_reject(spark):
    src, base = tempfile.mkdtemp(prefix="mf-rejects-src-"), tempfile.mkdtemp(prefix="mf-rejects-")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    batches = []
    for i in range(24):
        rows = [(T0 + i * 300, "a", float(i)), (T0 + i * 300 - 1500 * (i % 3), "b", 0.5), (T0 + i * 300, None, 2.0)]
        if i == 0:
            rows = [(None, "a", 1.0), (T0, "a", None)]  # a first batch without one row on time
        if i % 7 == 5:
            rows += [(None, "a", 4.0), (T0 + i * 300, "a", None), (T0, "a", -1.0), (None, "b", None)]
        batches.append(rows)
        arrive(src, i, rows)
        if i == 9:
            check(RJ.windows_and_rejects(stream, base=base, merge_every=5), batches)
    got = RJ.windows_and_rejects(stream, base=base, merge_every=5)
    check(got, batches)
    assert {r["reason"] for r in got[1].collect()} == {"no_time", "no_value", "late"}
    assert set(got[1].select("row.*").columns) == {"ts", "tag", "value", "reason", "second", "row"}
    assert len(os.listdir(f"{base}/out/_kind=merged")) <= 2
    check(RJ.windows_and_rejects(stream, base=base, merge_every=5), batches)  # nothing new: nothing twice


def test_a_replayed_batch_changes_nothing(spark):
    """A batch written twice, as after a driver lost between its write and its commit."""
    src, base = tempfile.mkdtemp(prefix="mf-rejects-re-"), tempfile.mkdtemp(prefix="mf-rejects-re-out-")
    write = RJ._splitter(base, "ts", "tag", "value", 600, 600, None)
    batches = [[(T0 + 3000, "a", 1.0)], [(T0, "a", 2.0), (T0 + 3001, "a", 3.0)], [(T0 + 9000, "a", 4.0)]]
    for i, rows in enumerate(batches):
        arrive(src, i, rows)
        b = spark.read.schema(SCHEMA).parquet(f"{src}/{i:04d}.parquet")
        write(b, i)
        write(b, i)
    check(RJ._results(spark, base, b.schema, "tag"), batches)


def test_empty_stream(spark):
    src = tempfile.mkdtemp(prefix="mf-rejects-none-")
    got = RJ.windows_and_rejects(spark.readStream.schema(SCHEMA).parquet(src), base=tempfile.mkdtemp(prefix="mf-rejects-no-"))
    assert [d.count() for d in got] == [0, 0, 0]
    assert got[0].columns == ["window_start", "tag", "n", "avg_value", "min_value", "max_value"]
