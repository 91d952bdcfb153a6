"""Catalog entries on streams that come in parts: timed evaluation rounds, and windows that keep what they leave out. Each
part is appended to the folder the stream reads and the stream is started again from its checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskframe.operators import scores as SC
from maskframe.plans import fixtures as X
from maskframe.plans.catalog import CS, register
from maskframe.session import saved
from maskframe.streaming import rejects, rounds
from maskframe.streaming import streams as ST

#: second of the first prediction; seconds between images, images of a checkpoint and of what comes late; label that has no weight
START, STEP, IMAGES, BEHIND, IGNORED = 1_700_000_400, 30, 50, 14, 9


def _in_parts(rows, part, parts: int, name: str):
    """``rows`` by ``part`` (0 to parts - 1): yields the folder after each part has been appended."""
    spark = rows.sparkSession
    held, folder = saved(rows.withColumn("_part_of", part), name), ST.scratch(spark, name)
    for i in range(parts):
        held.filter(F.col("_part_of") == i).drop("_part_of").write.mode("append").parquet(folder)
        yield folder


@register(
    "stream_eval_rounds",
    f"""WITH {CS}, p AS (SELECT image_id, view, arg_max(class, (logit, -class)) AS pred, ANY_VALUE(label) AS label FROM cs GROUP BY 1, 2),
e AS (SELECT image_id // {IMAGES} AS checkpoint, {START} + {STEP} * image_id + view AS s, label, pred, COALESCE(label BETWEEN 0 AND 9 AND label <> {IGNORED}, FALSE) AS used FROM p),
f AS (SELECT checkpoint, MIN(s) // 300 * 300 AS first FROM e GROUP BY 1), w AS (SELECT MAX(s) // 300 * 300 - 900 AS top FROM e),
r AS (SELECT checkpoint, k AS round, first + 300 * k AS until FROM f, range(1, 6) t(k), w WHERE first + 300 * k <= top),
m AS (SELECT r.*, e.label, e.pred, e.used FROM r JOIN e ON e.checkpoint = r.checkpoint AND e.s < r.until),
n AS (SELECT checkpoint, round, until, COUNT(*) FILTER (used) AS n, COUNT(*) FILTER (NOT used) AS left_out FROM m GROUP BY ALL),
c AS (SELECT checkpoint, round, c, COUNT(*) FILTER (label = c AND pred = c) / COUNT(*) AS iou FROM m, range(10) t(c) WHERE used AND (label = c OR pred = c) GROUP BY ALL),
i AS (SELECT checkpoint, round, AVG(iou) AS miou FROM c GROUP BY ALL)
SELECT CAST(n.checkpoint AS INTEGER) AS checkpoint, CAST(n.round AS INTEGER) AS round, n.until, n.n, n.left_out, round(i.miou, 6) AS miou
FROM n LEFT JOIN i ON i.checkpoint = n.checkpoint AND i.round = n.round""",
)
def stream_eval_rounds(spark, sf_dir):
    """T2 + ML6 on the reference's clock: mean IoU of every checkpoint each 300 s of event time, five times. A checkpoint is
    evaluated on 50 images, 30 s each; some come up to seven minutes after their neighbours; the second half comes after a
    restart."""
    cs = X.class_scores(spark, sf_dir)
    pred = SC.argmax_class(cs, ["image_id", "view"], score_col="logit").join(cs.select("image_id", "label").distinct(), "image_id")
    second = F.lit(START) + STEP * F.col("image_id") + F.col("view")
    rows = pred.select((F.col("image_id") / IMAGES).cast("int").alias("checkpoint"), F.timestamp_seconds(second).alias("ts"), "label", "pred", "image_id")
    half = X.table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0] or 0
    place = F.col("image_id") + F.when(F.col("image_id") % 3 == 0, BEHIND).otherwise(0)
    base, out = ST.scratch(spark, "rounds"), None
    for src in _in_parts(rows, (place * 2 > half).cast("int"), 2, "rounds-in"):
        with rounds.state_store(spark):
            stream = rounds.evaluation_rounds(ST.file_stream(spark, src), 10, ignore_label=IGNORED, watermark="900 seconds")
            out = ST.run_available_now(stream, ["checkpoint", "round"], "rounds", mode="append", base=base)
    return out.select("checkpoint", "round", "until", "n", "left_out", F.round("miou", 6).alias("miou"))


@register(
    "stream_rejects",
    """WITH e AS (SELECT event_type AS tag, CAST(floor(epoch(ts)) AS BIGINT) AS s, CASE WHEN event_id % 97 <> 0 THEN value END AS v,
       CAST(floor(epoch(ts)) AS BIGINT) + CASE WHEN event_id % 10 = 0 THEN 432000 ELSE 0 END AS a FROM events),
p AS (SELECT *, (a - (SELECT MIN(a) FROM e)) * 4 // (SELECT MAX(a) - MIN(a) + 1 FROM e) AS part FROM e),
t AS (SELECT k AS part, (SELECT MAX(s) FROM p WHERE v IS NOT NULL AND p.part < k) AS top FROM range(4) r(k)),
m AS (SELECT p.*, s // 600 * 600 AS window_start, CASE WHEN v IS NULL THEN 'no_value' WHEN s // 600 * 600 + 600 <= top - 600 THEN 'late' ELSE 'kept' END AS status
      FROM p JOIN t ON t.part = p.part)
SELECT status, tag, window_start, CAST(COUNT(*) AS BIGINT) AS n, CASE WHEN status = 'kept' THEN round(AVG(v), 6) END AS avg_value,
  CASE WHEN status = 'kept' THEN MIN(v) END AS min_value, CASE WHEN status = 'kept' THEN MAX(v) END AS max_value
FROM m GROUP BY status, tag, window_start""",
)
def stream_rejects(spark, sf_dir):
    """T3 + P10: windows of the metric stream and the rows that are in none, by reason. The stream comes in four parts with a
    restart between them; a tenth of the rows comes five days late, and some have lost their value."""
    ev = X.table(spark, sf_dir, "events")
    behind = F.when(F.col("event_id") % 10 == 0, 432_000).otherwise(0)
    value = F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("value")
    rows = ev.select("ts", F.col("event_type").alias("tag"), value, (F.unix_timestamp("ts") + behind).alias("arrival"))
    lo, hi = rows.agg(F.min("arrival"), F.max("arrival")).first()
    lo, hi = (lo, hi) if lo is not None else (0, 0)
    part = F.floor((F.col("arrival") - lo) * 4 / F.lit(hi - lo + 1)).cast("int")
    base, out = ST.scratch(spark, "rejects"), None
    for src in _in_parts(rows, part, 4, "rejects-in"):
        out = rejects.windows_and_rejects(ST.file_stream(spark, src), base=base)
    windows, rest, _ = out
    start = F.floor(F.unix_timestamp("row.ts") / 600) * 600
    rest = rest.groupBy(F.col("reason").alias("status"), F.col("row.tag").alias("tag"), start.cast("bigint").alias("window_start")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("double")
    rest = rest.select("*", none.alias("avg_value"), none.alias("min_value"), none.alias("max_value"))
    return windows.select(F.lit("kept").alias("status"), "tag", "window_start", "n", F.round("avg_value", 6).alias("avg_value"), "min_value", "max_value").unionByName(rest)
