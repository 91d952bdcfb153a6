"""DuckDB formulations used as the correctness oracle. They work on rectangles and pixels of the bridge views,
independently of the run/sweep formulation on the Spark side. Counts are cast to BIGINT (DuckDB sums are HUGEINT),
doubles rounded to 6 digits."""

from __future__ import annotations

from maskframe.functions.classes import BINS_A, BINS_B, MAIN_BINS, area_class_sql

INSTANCES = """instances AS (
  SELECT l_orderkey AS k, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk,
         CAST(l_quantity AS BIGINT) AS w, 1 + l_partkey % 97 AS h,
         (l_suppkey*37 + l_linenumber*101) % 719 AS x0, (l_partkey*53) % 672 AS y0
  FROM lineitem)"""

# one row per image with its summed text area
IMAGE_AREA = """img AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) || '.jpg' AS ImageId,
         CAST(COALESCE(SUM(i.w * i.h), 0) AS BIGINT) AS area,
         CAST(SUM(CASE WHEN i.k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS isnan,
         CAST(COUNT(i.k) AS BIGINT) AS instances
  FROM orders o LEFT JOIN instances i ON o.o_orderkey = i.k
  GROUP BY o.o_orderkey)"""

# annotation text, built like the Spark bridge (used only where the text itself is the answer)
ANNOTATIONS = """ann AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) || '.jpg' AS ImageId,
         CASE WHEN i.k IS NULL THEN NULL ELSE
           array_to_string(flatten(list_transform(range(i.w), lambda j: [CAST((i.x0 + j) * 768 + i.y0 + 1 AS VARCHAR), CAST(i.h AS VARCHAR)])), ' ')
         END AS EncodedPixels
  FROM orders o LEFT JOIN instances i ON o.o_orderkey = i.k)"""

# every covered pixel of every instance (p = col*768 + row), with the source rows
PIXELS = """px AS (
  SELECT i.k, i.ln, i.pk, i.sk, (i.x0 + cx.c) * 768 + i.y0 + ry.r AS p
  FROM instances i, LATERAL (SELECT unnest(range(i.w)) AS c) cx, LATERAL (SELECT unnest(range(i.h)) AS r) ry)"""


def q_class_histogram() -> str:
    return f"""WITH {INSTANCES}, {IMAGE_AREA}
SELECT {area_class_sql('area', MAIN_BINS)} AS class, CAST(COUNT(*) AS BIGINT) AS n FROM img GROUP BY 1"""


def q_image_rollup() -> str:
    return f"""WITH {INSTANCES}, {IMAGE_AREA}
SELECT ImageId, area, isnan, instances, {area_class_sql('area', MAIN_BINS)} AS class FROM img"""


def q_area_classes(bins, name: str) -> str:
    return f"""WITH {INSTANCES}, {IMAGE_AREA}
SELECT {area_class_sql('area', bins)} AS {name}, CAST(COUNT(*) AS BIGINT) AS n FROM img GROUP BY 1"""


ORACLES_BINS = {"area_class_a": BINS_A, "area_class_b": BINS_B}
