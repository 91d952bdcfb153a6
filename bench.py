"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Each query is built fresh (no shuffle reuse between runs) and executed in full through the ``noop`` sink, so the
time covers the whole plan without collecting results to the driver. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from maskframe.plans.catalog import QUERIES  # noqa: E402
from maskframe.session import get_session  # noqa: E402

HEADLINE = [
    "class_histogram",      # E1 front: parse, rollup, classes
    "stratified_split",     # R1 with bucketed ranks
    "coverage_hist",        # M3 sweep
    "label_raster_stats",   # M9
    "rle_encode",           # W5 + M6
    "mask_vote2",           # M4
    "mask_iou_per_image",   # M15
    "ensemble_submissions", # E2: vote + components + encode
    "tile_overlap",         # J5
    "topk_tiles",           # W4
    "mean_iou",             # E3 metric
    "tta_score",            # ML2
    "drop_first_negatives", # R4 + O1
    "make_training_set",    # R8
    "augment_set",          # I17
    "rgb_resize_bilinear",  # I7, three channels
    "score_submission",     # ML1 end to end
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="maskframe-bench")
    # warm-up: JVM, Python workers and codegen on the smallest fixture when it is there
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        QUERIES["class_histogram"](spark, warm).collect()
    times, failed = {}, {}
    for k in keys:
        t0 = time.time()
        try:
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[k] = round(time.time() - t0, 3)
        except Exception as e:  # keep measuring the others; report the failure in the JSON line
            times[k] = None
            failed[k] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = sf_dir.rstrip("/").split("sf")[-1]
    out = {"metric": "headline_total", "value": round(sum(v for v in times.values() if v is not None), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
