"""Timed evaluation rounds: the same results whatever the batches and restarts, five a checkpoint, then closed."""

import os
import tempfile

import numpy as np
import pandas as pd
import pytest

from maskframe.streaming import rounds as R
from maskframe.streaming import streams as ST

T0, EVERY, CLASSES = 1_700_000_400, 300, 3
SCHEMA = "checkpoint string, ts timestamp_ntz, label int, pred int"


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def plain(rows, last, most=5):
    """The wording of the rounds on a list of (checkpoint, second, label, pred); ``last``: the watermark at the end."""
    out = []
    for c in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == c]
        first = min(r[1] for r in mine) // EVERY * EVERY
        for k in range(1, most + 1):
            until = first + k * EVERY
            if until > last:
                break
            seen = [r[2:] for r in mine if r[1] < until]
            used = [(a, b) for a, b in seen if a is not None and b is not None and 0 <= a < CLASSES and 0 <= b < CLASSES]
            ious = [sum(a == b == x for a, b in used) / n for x in range(CLASSES) if (n := sum(x in (a, b) for a, b in used))]
            out.append((c, k, until, len(used), len(seen) - len(used), round(float(np.mean(ious)), 9) if ious else None))
    return sorted(out, key=str)


def test_rounds_survive_restarts_and_close(spark, few_partitions):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):  # checkpoint a reports for ten intervals, b starts later and pauses, the null one has one row
        rows.append(("a", T0 + int(i * 7.5), int(rng.integers(0, 4)), int(rng.integers(0, 3))))
    rows += [("b", T0 + 700 + s, int(rng.integers(0, 3)), int(rng.integers(0, 3))) for s in (0, 5, 1300, 1301)]
    rows += [(None, T0 + 10, None, 1), ("end", T0 + 9000, 1, 1)]
    order = sorted(rows, key=lambda r: r[1] + (200 if r[2] == 0 else 0))  # some come up to 200 s after their neighbours
    src, base = tempfile.mkdtemp(prefix="mf-rounds-src-"), tempfile.mkdtemp(prefix="mf-rounds-")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)

    def arrive(n, part):
        f = pd.DataFrame(part, columns=["checkpoint", "ts", "label", "pred"])
        f["ts"] = pd.to_datetime(f["ts"], unit="s").astype("datetime64[us]")
        f.astype({"label": "Int32", "pred": "Int32"}).to_parquet(f"{src}/{n}.parquet", index=False)
        os.utime(f"{src}/{n}.parquet", (T0 + n, T0 + n))

    def run():
        with R.state_store(spark):
            df = R.evaluation_rounds(stream, CLASSES, every=EVERY, watermark="600 seconds")
            return ST.run_available_now(df, ["checkpoint", "round"], "rounds", mode="append", base=base).collect()

    cut = [0, 150, 300, len(order)]
    seen = []
    for n in range(3):  # three runs, each a restart from the checkpoint folder, of one or two batches
        part = order[cut[n] : cut[n + 1]]
        arrive(2 * n, part[: len(part) // 2])
        arrive(2 * n + 1, part[len(part) // 2 :])
        seen.append(run())
    got = sorted(((r["checkpoint"], r["round"], r["until"], r["n"], r["left_out"], None if r["miou"] is None else round(r["miou"], 9)) for r in seen[-1]), key=str)
    assert got == plain(rows, T0 + 9000 // EVERY * EVERY - 600)
    assert {c: sum(r[0] == c for r in got) for c in ("a", "b", None)} == {"a": 5, "b": 5, None: 5}
    assert 0 < len(seen[0]) < len(seen[-1])
    arrive(9, [("a", T0 + 9100, 1, 1), ("a", T0 + 30_000, 1, 1)])  # a closed checkpoint stays closed
    again = [r for r in run() if r["checkpoint"] == "a"]
    assert len(again) == 5


def test_no_rows_no_rounds(spark, few_partitions):
    src = tempfile.mkdtemp(prefix="mf-rounds-none-")
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(src)
    with R.state_store(spark):
        df = R.evaluation_rounds(spark.readStream.schema(SCHEMA).parquet(src), CLASSES)
        assert ST.run_available_now(df, ["checkpoint", "round"], "rounds", mode="append").count() == 0


def test_long_ids_beside_a_null_stay_exact(spark):
    rows = spark.createDataFrame([(2**60 + 1, T0, 1), (2**60 + 1, T0 + 1, 1), (None, T0 + 400, 2)], "checkpoint long, second long, cell int")
    got = {(r["checkpoint"], r["at"], r["cell"], r["n"]) for r in R.cells_by_task(rows.coalesce(1), EVERY).collect()}
    assert got == {(str(2**60 + 1), T0, 1, 2), (None, T0 + 300, 2, 1)}
