"""Area classes and other fixed values that must equal the reference's for equal results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference) -------------------------------------------------------------------
CANVAS_H = 768
CANVAS_W = 768
# Upper bounds of the half-open area-share bins; class 0 is "area == 0", the last class is "everything above".
MAIN_BINS = (0.005, 0.015, 0.025, 0.035, 0.045)
BINS_A = (0.0005, 0.001, 0.002, 0.005, 0.025)
BINS_B = (0.0001, 0.0002, 0.001, 0.015, 0.025)
# Classification pretraining: 0 when empty, 1 when share >= 0.01, otherwise 2 (small ship; used by neither list).
PRETRAIN_LARGE = 0.01
SHIP_IGNORE_LABEL = 2
# Image ids dropped up front as corrupt.
BLOCKED_IDS = ("6384c3e78.jpg", "00021ddc3.jpg")
# -----------------------------------------------------------------------------------------------------------------


def area_class(area, bins=MAIN_BINS, canvas: int = CANVAS_H * CANVAS_W) -> Column:
    """Bin an integer area by its share of the canvas: 0 for zero, then 1..len(bins) for share < bin, else
    len(bins)+1. The share is a double division exactly as the oracle computes it."""
    a = F.col(area) if isinstance(area, str) else area
    share = a.cast("double") / F.lit(float(canvas))
    expr = F.when(a == 0, F.lit(0))
    for i, b in enumerate(bins, start=1):
        expr = expr.when(share < F.lit(float(b)), F.lit(i))
    return expr.otherwise(F.lit(len(bins) + 1)).cast("int")


def pretrain_class(area, canvas: int = CANVAS_H * CANVAS_W) -> Column:
    a = F.col(area) if isinstance(area, str) else area
    share = a.cast("double") / F.lit(float(canvas))
    return F.when(a == 0, 0).when(share >= PRETRAIN_LARGE, 1).otherwise(2).cast("int")


def area_class_sql(area: str, bins=MAIN_BINS, canvas: int = CANVAS_H * CANVAS_W) -> str:
    """The same binning as a SQL CASE (used by the oracle side)."""
    parts = [f"WHEN {area} = 0 THEN 0"]
    for i, b in enumerate(bins, start=1):
        parts.append(f"WHEN CAST({area} AS DOUBLE) / {float(canvas)} < {float(b)} THEN {i}")
    return "CAST(CASE " + " ".join(parts) + f" ELSE {len(bins) + 1} END AS INTEGER)"
