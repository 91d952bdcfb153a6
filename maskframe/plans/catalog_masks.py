"""Catalog entries on masks that need operators of their own: pixel-wise evaluation, boxes as data, the tiled build, components
as tables, the pixel table function and the quarantined build."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskframe.operators import coverage as V
from maskframe.operators import pixel_eval as PE
from maskframe.operators import runs as R
from maskframe.operators import tiles as T
from maskframe.plans import fixtures as X
from maskframe.plans import oracle as O
from maskframe.plans.catalog import _pixels_of, register

# ------------------------------------------------------------------------------------------- pixel-wise evaluation
# every covered pixel of every image with the number of truth rows and whether it is predicted; the rest is background
PIXEL_PAIRS = f"""{O.INSTANCES}, {O.PIXELS},
tr AS (SELECT k, p, COUNT(*) AS c FROM px GROUP BY k, p), {_pixels_of('i.ln <> 7', shift='i.ln % 3', name='pp')},
j AS (SELECT COALESCE(tr.k, pp.k) AS k, COALESCE(tr.c, 0) AS t, CASE WHEN pp.p IS NULL THEN 0 ELSE 1 END AS pred
      FROM tr FULL JOIN pp ON tr.k = pp.k AND tr.p = pp.p),
cells AS (SELECT k, t AS label, pred, COUNT(*) AS n FROM j WHERE t < 2 GROUP BY ALL
          UNION ALL SELECT o.o_orderkey, 0, 0, 768 * 768 - COALESCE(a.n, 0) FROM orders o LEFT JOIN (SELECT k, COUNT(*) AS n FROM j GROUP BY k) a ON a.k = o.o_orderkey)"""


def _pairs(spark, sf_dir):
    return PE.pixel_pairs(X.truth(spark, sf_dir), X.prediction(spark, sf_dir))


@register(
    "pixel_confusion",
    f"""WITH {PIXEL_PAIRS}
SELECT CAST(label AS INTEGER) AS label, CAST(pred AS INTEGER) AS pred, CAST(SUM(n) AS BIGINT) AS n FROM cells GROUP BY label, pred HAVING SUM(n) <> 0""",
)
def pixel_confusion(spark, sf_dir):
    """J8 + A5 + P9: pixels of all images by (label, prediction); doubly covered pixels are ignored."""
    return PE.pixel_confusion(_pairs(spark, sf_dir))


IOU_OF_CELLS = """summed AS (SELECT {by} label, pred, SUM(n) AS n FROM cells GROUP BY ALL HAVING SUM(n) <> 0),
cls AS (SELECT {by} c AS class, SUM(CASE WHEN label = pred THEN n ELSE 0 END) AS tp, SUM(n) AS den
        FROM summed, range(2) r(c) WHERE label = c OR pred = c GROUP BY ALL)"""


@register("pixel_mean_iou", f"WITH {PIXEL_PAIRS}, {IOU_OF_CELLS.format(by='')} SELECT round(avg(tp / den), 6) AS miou FROM cls")
def pixel_mean_iou(spark, sf_dir):
    """J8 + A6: mean IoU over all pixels."""
    out = PE.pixel_mean_iou(X.truth(spark, sf_dir), X.prediction(spark, sf_dir))
    return out.select(F.round("miou", 6).alias("miou"))


@register(
    "pixel_iou_per_image",
    f"""WITH {PIXEL_PAIRS}, {IOU_OF_CELLS.format(by='k,')}
SELECT CAST(k AS VARCHAR) || '.jpg' AS ImageId, round(avg(tp / den), 6) AS miou FROM cls GROUP BY k""",
)
def pixel_iou_per_image(spark, sf_dir):
    """J8 + A6 image by image: mean IoU over the classes that occur in the image."""
    out = PE.pixel_mean_iou(X.truth(spark, sf_dir), X.prediction(spark, sf_dir), by=["ImageId"])
    return out.select("ImageId", F.round("miou", 6).alias("miou"))


# ------------------------------------------------------------------------------------------------- boxes as data
def _boxes(spark, sf_dir):
    """A detection box per line: its ship grown by 40 pixels to the left and 200 below, whatever lies in it."""
    i = X.instances(spark, sf_dir)
    return i.select(F.concat(F.col("k").cast("string"), F.lit(".jpg")).alias("ImageId"), F.col("ln").alias("box"),
                    (F.col("x0") - 40).alias("x0"), F.col("y0").alias("y0"), (F.col("x0") + F.col("w")).alias("x1"), (F.col("y0") + F.col("h") + 200).alias("y1"))


@register(
    "box_overlap",
    f"""WITH {O.INSTANCES},
s AS (SELECT k, x0, y0, least(x0 + w, 768) AS x1, y0 + h AS y1 FROM instances),
b AS (SELECT k, ln, x0 - 40 AS x0, y0, x0 + w AS x1, y0 + h + 200 AS y1 FROM instances)
SELECT CAST(b.k AS VARCHAR) || '.jpg' AS ImageId, b.ln AS box,
  CAST(SUM((least(s.x1, b.x1) - greatest(s.x0, b.x0)) * (least(s.y1, b.y1) - greatest(s.y0, b.y0))) AS BIGINT) AS mask_area
FROM b JOIN s ON s.k = b.k AND s.x0 < b.x1 AND b.x0 < s.x1 AND s.y0 < b.y1 AND b.y0 < s.y1 GROUP BY b.k, b.ln""",
)
def box_overlap(spark, sf_dir):
    """M1 + J5 with boxes from a table: label raster mass in the detection boxes of each image, measured from the texts."""
    return T.box_masses(X.annotations(spark, sf_dir), _boxes(spark, sf_dir))


# ------------------------------------------------------------------------------------------------- the tiled build
from maskframe.functions import classes as C  # noqa: E402
from maskframe.plans import tiled_set as TS  # noqa: E402
from maskframe.plans.catalog import MD5, SEED, SPLIT_SQL  # noqa: E402

# rectangles on the three canvases (nearest sampling maps a rectangle to a rectangle) and their mass in every tile
CANVAS_TILES = f"""canvas AS (SELECT * FROM (VALUES ('gp3', 512, 3, 1, '_4_'), ('gp2', 768, 5, 2, '_3_'), ('gp1', 1024, 7, 2, '_2_')) t(cohort, t, n, keep, tag)),
cr AS (SELECT k, cohort, t, n, keep, tag, (x0 * t + 767) // 768 AS x0, (least(x0 + w, 768) * t + 767) // 768 AS x1, (y0 * t + 767) // 768 AS y0, ((y0 + h) * t + 767) // 768 AS y1
       FROM instances, canvas),
ct AS (SELECT k, cohort, t, keep, tag, iy.i * n + ix.i AS tile,
         SUM((least(x1, ix.i * 128 + 256) - greatest(x0, ix.i * 128)) * (least(y1, iy.i * 128 + 256) - greatest(y0, iy.i * 128))) AS mask_area
       FROM cr, range(7) ix(i), range(7) iy(i)
       WHERE ix.i < n AND iy.i < n AND x0 < ix.i * 128 + 256 AND ix.i * 128 < x1 AND y0 < iy.i * 128 + 256 AND iy.i * 128 < y1 GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY k, cohort ORDER BY mask_area DESC, tile DESC) AS place FROM ct),
picked AS (SELECT * FROM top WHERE place <= keep AND mask_area >= 64)"""


def _tile_query(cohort: str):
    """M13 on one canvas, for all images."""

    def q(spark, sf_dir):
        areas = TS.annotated_tiles(X.annotations(spark, sf_dir), [c for c in TS.CANVASES if c[0] == cohort])
        return TS.tile_names(areas).select("ImageId", "sample", "tile", "mask_area")

    return q


for _cohort, _t, _n, _k, _tag in TS.CANVASES[1:]:
    register(
        f"tile_select_{_t}",
        f"""WITH {O.INSTANCES}, {CANVAS_TILES}
SELECT CAST(k AS VARCHAR) || '.jpg' AS ImageId, CAST(k AS VARCHAR) || tag || CAST(tile AS VARCHAR) AS sample, CAST(tile AS INTEGER) AS tile, CAST(mask_area AS BIGINT) AS mask_area
FROM picked WHERE cohort = '{_cohort}'""",
    )(_tile_query(_cohort))

TILED_SQL = f"""WITH {O.INSTANCES}, {O.IMAGE_AREA},
imgc AS (SELECT ImageId, area, c AS class, c AS sclass FROM (SELECT ImageId, area, {C.area_class_sql('area', C.BINS_A)} AS c FROM img WHERE instances > 0)),
{SPLIT_SQL},
neg AS (SELECT ImageId, row_number() OVER (ORDER BY {MD5}, ImageId) AS rn FROM img WHERE instances = 0),
pos AS (SELECT ImageId, row_number() OVER (ORDER BY {MD5}, ImageId) AS rn FROM split WHERE split = 'val'),
m AS (SELECT least((SELECT COUNT(*) FROM pos), (SELECT COUNT(*) FROM neg)) AS m),
kb AS (SELECT k, {C.area_class_sql('w * h', C.BINS_B)} AS b FROM instances),
flag AS (SELECT CAST(k AS VARCHAR) || '.jpg' AS ImageId, bool_or(b >= 4) AS gp4, bool_or(b >= 3) AS gp3, bool_or(b BETWEEN 2 AND 5) AS gp2, bool_or(b BETWEEN 1 AND 4) AS gp1
         FROM kb GROUP BY k),
tr AS (SELECT flag.* FROM flag JOIN split USING (ImageId) WHERE split = 'train'),
{CANVAS_TILES},
lists AS (
  SELECT 'train-1' AS split, substr(ImageId, 1, length(ImageId) - 4) || '_1' AS sample, ImageId, 256 AS resize, CAST(NULL AS INTEGER) AS tile FROM neg, m
  WHERE rn > greatest(m.m, (SELECT COUNT(*) FROM neg) - 10000)
  UNION ALL SELECT 'train-5', substr(ImageId, 1, length(ImageId) - 4) || '_5', ImageId, 256, NULL FROM tr WHERE gp4
  UNION ALL SELECT 'train', CAST(k AS VARCHAR) || tag || CAST(tile AS VARCHAR), tr.ImageId, t, CAST(tile AS INTEGER)
  FROM picked JOIN tr ON tr.ImageId = CAST(k AS VARCHAR) || '.jpg' WHERE CASE cohort WHEN 'gp3' THEN gp3 WHEN 'gp2' THEN gp2 ELSE gp1 END),
rks AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('{SEED}:' || sample), sample) AS rn, COUNT(*) OVER (PARTITION BY split) AS N,
          CASE split WHEN 'train-1' THEN 1 WHEN 'train' THEN 12 ELSE 4 END AS sh FROM lists),
vals AS (SELECT ImageId, rn, 0 AS o FROM pos, m WHERE rn <= m.m UNION ALL SELECT ImageId, rn, 1 FROM neg, m WHERE rn <= m.m)
SELECT split, CAST((rn - 1) // CAST(ceil(N / sh) AS BIGINT) AS INTEGER) AS shard_id, CAST(rn - 1 AS BIGINT) AS seq, sample, ImageId, CAST(resize AS INTEGER) AS resize, tile FROM rks
UNION ALL SELECT 'val', CAST((rn - 1) // CAST(ceil(m.m / 4.0) AS BIGINT) AS INTEGER), CAST((rn - 1) * 2 + o AS BIGINT), substr(ImageId, 1, length(ImageId) - 4), ImageId, 768, NULL FROM vals, m"""


@register("make_tiled_set", TILED_SQL)
def make_tiled_set(spark, sf_dir):
    """R8, third build: cohorts by ship size, tiles of three canvases, whole large ships, negatives and validation pairs, each list
    in its own shards."""
    return TS.make_tiled_set(X.annotations(spark, sf_dir), SEED)


# ------------------------------------------------------------------------------- builds from tables with broken texts
from maskframe.operators import annotations as A  # noqa: E402
from maskframe.plans.catalog import DROP_NEGATIVES  # noqa: E402
from maskframe.plans.classification_set import make_classification_set  # noqa: E402

BROKEN = "l_linenumber = 5 AND l_partkey % 3 = 0"


def _with_broken(spark, sf_dir):
    """The annotations with the texts of some rows spoilt: a word among the numbers (line 5 of parts divisible by 3)."""
    i = X.instances(spark, sf_dir)
    text = X.rect_rle(F.col("x0"), F.col("y0"), F.col("w"), F.col("h"))
    spoilt = (F.col("ln") == 5) & (F.col("pk") % 3 == 0)
    return X._with_all_images(spark, sf_dir, i, F.when(spoilt, F.concat(F.lit("x "), text)).otherwise(text))


@register(
    "quarantine_build",
    """WITH r AS (SELECT o_orderkey AS k, l_linenumber AS ln, COALESCE(l_linenumber = 5 AND l_partkey % 3 = 0, FALSE) AS bad FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey),
b AS (SELECT DISTINCT k FROM r WHERE bad),
s AS (SELECT CASE WHEN bad THEN 'non_numeric_token' WHEN k IN (SELECT k FROM b) THEN 'image_has_broken_row' ELSE 'used' END AS status, k FROM r)
SELECT status, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(DISTINCT k) AS BIGINT) AS images, CAST(0 AS BIGINT) AS in_build FROM s GROUP BY status""",
)
def quarantine_build(spark, sf_dir):
    """Rows of a spoilt annotation table by what becomes of them (rows in = rows used + rows reported), and how many of the
    reported images the classification build holds all the same: none."""
    ann = _with_broken(spark, sf_dir)
    used, reported = A.usable_images(ann)
    rows = used.select("ImageId", F.lit("used").alias("status")).unionByName(reported.select("ImageId", F.col("reason").alias("status")))
    built = make_classification_set(ann, SEED, DROP_NEGATIVES).select("ImageId").distinct().withColumn("built", F.lit(1))
    held = F.sum(F.when(F.col("status") != "used", F.coalesce("built", F.lit(0))).otherwise(0)).cast("bigint").alias("in_build")
    return rows.join(built, "ImageId", "left").groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.countDistinct("ImageId").cast("bigint").alias("images"), held)


# --------------------------------------------------------------- components as tables, the pixel functions of SQL
from maskframe.functions.table_functions import register_table_functions  # noqa: E402
from maskframe.operators.components import connected_components_strips as _components  # noqa: E402
from maskframe.plans.catalog import ORACLES  # noqa: E402


@register("connected_components_tables", ORACLES["connected_components"])
def connected_components_tables(spark, sf_dir):
    """M5 + W8, second form: components by star contraction over strips of column pieces, no image in one task."""
    strips = V.packed_strips(X.annotations(spark, sf_dir), lambda c, by: c >= 1)
    return _components(strips).groupBy("ImageId", "instance_id").agg(
        F.sum(F.col("r1") - F.col("r0")).cast("bigint").alias("pixels"), F.min(F.col("r0") * 768 + F.col("col")).cast("bigint").alias("first_pixel"))


@register("rle_pixels_sql", ORACLES["rle_pixels"])
def rle_pixels_sql(spark, sf_dir):
    """M2 as a table function, through a lateral join in SQL."""
    register_table_functions(spark)
    return spark.sql(
        """SELECT a.ImageId, count(*) AS pixels, sum(p.row) AS sum_row, sum(p.col) AS sum_col
           FROM {ann} a, LATERAL rle_pixels(a.EncodedPixels, 768, 768) p GROUP BY a.ImageId""", ann=X.annotations(spark, sf_dir))
