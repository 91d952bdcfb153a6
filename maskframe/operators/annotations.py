"""Annotation-table operators.

Input shape: ``(ImageId string, EncodedPixels string)``, one row per instance and a null row for an image
without ships. All operators are narrow projections / filters except the rollups, which are hash aggregates
with map-side partial aggregation (a hot image collapses to one partial row per task before the shuffle).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.functions import classes as C
from maskframe.functions.rle import let, rle_area, rle_valid
from maskframe.functions.rle_batch import area_valid

ID = "ImageId"
ENC = "EncodedPixels"


def drop_blocked(df: DataFrame, ids: Iterable[str] = C.BLOCKED_IDS, id_col: str = ID) -> DataFrame:
    """Remove known-corrupt image ids. The list is a literal of fixed size, so ``NOT IN`` folds into the scan
    filter (and pushes to Parquet) instead of planning a join."""
    ids = list(ids)
    if not ids:
        return df
    return df.filter(~F.col(id_col).isin(ids))


def null_flag(df: DataFrame, enc_col: str = ENC) -> DataFrame:
    """``isnan`` = 1 when the encoding is null, else 0."""
    return df.withColumn("isnan", F.col(enc_col).isNull().cast("int"))


def ships(df: DataFrame, enc_col: str = ENC) -> DataFrame:
    """P2 split: rows with a ship."""
    return df.filter(F.col(enc_col).isNotNull())


def no_ships(df: DataFrame, enc_col: str = ENC) -> DataFrame:
    """P2 split: rows without a ship."""
    return df.filter(F.col(enc_col).isNull())


def with_area(df: DataFrame, enc_col: str = ENC) -> DataFrame:
    """``area`` = sum of the length tokens (text area, bigint) and ``valid`` (all used tokens are digits). Plain texts are
    measured in Arrow batches; the expressions read only those that are not."""
    rest = let(F.col(enc_col), lambda e: F.struct(rle_area(e).alias("area"), rle_valid(e).alias("valid")))
    plain = df.withColumn("_plain", area_valid(F.col(enc_col)))
    both = F.when(F.col("_plain").isNull(), rest).otherwise(F.col("_plain"))
    return plain.withColumn("_av", both).withColumn("area", F.col("_av.area")).withColumn("valid", F.col("_av.valid")).drop("_av", "_plain")


def quarantine(df: DataFrame) -> DataFrame:
    """Rows the reference would fail on (non-numeric tokens), with a reason code."""
    return with_area(df).filter(~F.col("valid")).select(ID, ENC, F.lit("non_numeric_token").alias("reason"))


def usable_images(df: DataFrame, id_col: str = ID, enc_col: str = ENC) -> tuple[DataFrame, DataFrame]:
    """(rows, reported): the rows of images whose texts are all sound, and all others with a ``reason``: the broken row itself
    (``non_numeric_token``) or a row beside it (``image_has_broken_row``). Every row is in exactly one of them; an image is
    never used in part, so a broken text cannot pass for an empty image. The broken images' ids are joined without a hint: Spark
    broadcasts them only if they are few."""
    checked = sound_texts(df, enc_col)  # told before the join, so that no text is shuffled unless it is asked for
    # by an aggregate: Spark would push a filter on the batches' verdict to where it cannot be evaluated
    bad = checked.groupBy(F.col(id_col).alias("_bad")).agg(F.min("_sound").alias("_whole")).filter(~F.col("_whole")).select("_bad")
    on = F.col(id_col).eqNullSafe(F.col("_bad"))
    reason = F.when(F.col("_sound"), "image_has_broken_row").otherwise("non_numeric_token")
    rest = checked.join(bad, on, "left_semi").withColumn("reason", reason).drop("_sound")
    return df.join(bad, on, "left_anti"), rest


def sound_texts(df: DataFrame, enc_col: str = ENC, out: str = "_sound") -> DataFrame:
    """``out``: :func:`rle_valid` of the text. Plain texts are told in Arrow batches; the expression reads only those that are not."""
    plain = df.withColumn("_plain", area_valid(F.col(enc_col)))
    return plain.withColumn(out, F.when(F.col("_plain").isNull(), rle_valid(F.col(enc_col))).otherwise(True)).drop("_plain")


def with_class(df: DataFrame, area_col: str = "area", bins=C.MAIN_BINS, out: str = "class") -> DataFrame:
    """P5 on any binning table of SURVEY 1.1-10."""
    return df.withColumn(out, C.area_class(F.col(area_col), bins))


def with_pretrain_class(df: DataFrame, area_col: str = "area", out: str = "class") -> DataFrame:
    return df.withColumn(out, C.pretrain_class(F.col(area_col)))


def image_rollup(df: DataFrame, id_col: str = ID, enc_col: str = ENC) -> DataFrame:
    """A1: per image ``area`` (sum of valid text areas), ``isnan`` (null rows), ``instances`` (non-null rows).

    Invalid rows contribute no area (they are reported by :func:`quarantine`)."""
    a = with_area(df, enc_col)
    return a.groupBy(id_col).agg(
        F.sum(F.when(F.col("valid"), F.col("area")).otherwise(0)).cast("bigint").alias("area"),
        F.sum(F.col(enc_col).isNull().cast("bigint")).cast("bigint").alias("isnan"),
        F.count(F.col(enc_col)).cast("bigint").alias("instances"),
    )


def class_histogram(rollup: DataFrame, class_col: str = "class") -> DataFrame:
    """A2: rows per class. Ordering is a presentation concern (``orderBy(desc('n'))``); the result has at most one
    row per class, so sorting it is free."""
    return rollup.groupBy(class_col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def distinct_ids(df: DataFrame, id_col: str = ID) -> DataFrame:
    """A3: distinct image ids (shuffle with partial distinct on the map side)."""
    return df.select(id_col).distinct()


def class_range(df: DataFrame, lo: int | None = None, hi: int | None = None, class_col: str = "class") -> DataFrame:
    """Cohort predicate ``lo <= class <= hi`` (either bound optional)."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(class_col) >= lo)
    if hi is not None:
        cond = cond & (F.col(class_col) <= hi)
    return df.filter(cond)


# fixed values: the cohorts of the preprocessing notebook (name, lo, hi) and of the tiling script's variant
COHORTS_MAIN = (("gp5", 3, None), ("gp4", 2, None), ("gp3", 2, 3), ("gp2", 1, 2), ("gp1", 1, 1))
COHORTS_TILING = (("gp4", 4, None), ("gp3", 3, None), ("gp2", 2, 5), ("gp1", 1, 4))


def cohort_rollups(instances_with_class: DataFrame, cohorts=COHORTS_MAIN, id_col: str = ID) -> DataFrame:
    """A4: every cohort rolled up per image in ONE pass: each instance row is exploded into the ids of the cohorts
    it belongs to (a tiny literal array), then a single ``groupBy(cohort, image)``; no per-cohort rescans."""
    matches = []
    for name, lo, hi in cohorts:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("class") >= lo)
        if hi is not None:
            cond = cond & (F.col("class") <= hi)
        matches.append(F.when(cond, F.lit(name)))
    tagged = instances_with_class.withColumn("cohort", F.explode(F.filter(F.array(*matches), lambda x: x.isNotNull())))
    return tagged.groupBy("cohort", id_col).agg(
        F.sum("area").cast("bigint").alias("area"), F.count(F.lit(1)).cast("bigint").alias("instances")
    )


def min_area_filter(df: DataFrame, min_area: int = 64, area_col: str = "mask_area") -> DataFrame:
    """Keep rows with enough mask."""
    return df.filter(F.col(area_col) >= min_area)
