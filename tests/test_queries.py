"""The driver contract on the smallest fixture: entry() and a sample of queries against their DuckDB oracles."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import rows_of

SF = "/root/testdata/sf0.001"
TABLES = ("orders", "lineitem", "embeddings", "events")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_class_counts(spark):
    got = {r["class"]: r["n"] for r in E.entry(spark).collect()}
    assert got == {0: 27, 1: 465, 2: 836, 3: 162, 4: 10}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 90


@pytest.mark.parametrize("key", ["coverage_hist", "mask_vote2", "stratified_split", "tile_overlap", "mean_iou",
                                 "make_training_set", "grid_resize_bilinear", "stream_metric_windows", "pixel_confusion",
                                 "pixel_iou_per_image", "box_overlap", "make_tiled_set", "tile_select_1024", "quarantine_build",
                                 "augment_set", "rgb_augment", "rle_pixels_sql", "stream_rejects"])
def test_query_matches_oracle(spark, con, key):
    s = E.queries()[key](spark, SF).toPandas()
    o = con.execute(E.oracle_sql()[key]).df()
    assert rows_of(s) == rows_of(o)
