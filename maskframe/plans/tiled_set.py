"""Composition: annotations -> records of the tiled training set.

Images with ships are split by area class A. Every training image goes, by the classes B of its single ships, into up to four
overlapping cohorts: large ships are read whole at 256 x 256; the other three cohorts are resized to 512, 768 and 1024 pixels and
give their fullest tiles. Empty images fill the negative list and the validation pairs. Each list is shuffled as a whole and
dealt to its own number of shards.

Plan: one aggregate of the rows by image (areas, cohort flags, broken texts), checkpointed because every list reads it. The
tiles come from one pass over the texts: the pieces of an Arrow batch are cut at the tiles' borders on the three canvases, summed
by (image, canvas, tile) in the task, and only the tiles kept, at most five an image, meet the image's flags. The lists are
written to the shared folder, as ranks and counts read them. Texts are shuffled only if the table is not partitioned by image.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskframe.functions import classes as C
from maskframe.functions.keys import md5_key
from maskframe.functions.names import sample_name
from maskframe.operators import annotations as A
from maskframe.operators import sampling as S
from maskframe.operators import tiles as T
from maskframe.operators.ranking import attach, bucket_rank, group_counts
from maskframe.operators.tiles import tile_masses, tile_ranges
from maskframe.plans.training_set import _pairs_to_records
from maskframe.session import cut_lineage, saved
from maskframe.sources import io as IO

# fixed values: (cohort, canvas side, tiles a side, tiles kept, name tag), shards by list, negatives kept, side of whole images
CANVASES = (("gp3", 512, 3, 1, "_4_"), ("gp2", 768, 5, 2, "_3_"), ("gp1", 1024, 7, 2, "_2_"))
WHOLE = ("gp4", "_5")
SHARDS = {"train-1": 1, "train": 12, "train-5": 4, "val": 4}
LAST_NEGATIVES = 10_000
WHOLE_SIZE = 256


def image_table(ann: DataFrame) -> DataFrame:
    """Per image: area, empty rows, ships, whether a text is broken, and one flag per cohort."""
    a = A.with_area(A.null_flag(A.drop_blocked(ann)))
    cls = C.area_class(F.col("area"), C.BINS_B)
    ship = (F.col("isnan") == 0) & F.col("valid")

    def member(lo: int, hi: int | None) -> Column:
        inside = ship & (cls >= lo)
        return inside if hi is None else inside & (cls <= hi)

    return a.groupBy("ImageId").agg(
        F.sum(F.when(F.col("valid"), F.col("area")).otherwise(0)).cast("bigint").alias("area"),
        F.sum(ship.cast("int")).alias("ships"),
        F.max(~F.col("valid")).alias("broken"),
        *[F.max(member(lo, hi)).alias(name) for name, lo, hi in A.COHORTS_TILING],
    )


def canvas_tiles(pieces: DataFrame, canvases=CANVASES, size: int = 256, height: int = C.CANVAS_H, width: int = C.CANVAS_W) -> DataFrame:
    """J5 on several canvases at once: ``(ImageId, cohort, tile, mask_area)``, the mass of each tile that meets the mask, the
    raster resized by nearest sampling. A source rectangle is a rectangle of the target (as in ``resize_nearest_pieces``),
    so a piece is measured without its target pixels. All canvases have the same stride between tiles."""
    steps = {b[1] - a[1] for _, t, n, _, _ in canvases for r in [tile_ranges(t, n, size)] for a, b in zip(r[:-1], r[1:])}
    if len(steps) != 1:
        raise ValueError("the canvases' tiles have different strides")
    step = steps.pop()
    table = F.array(*[F.struct(F.lit(c).alias("cohort"), F.lit(t).cast("bigint").alias("t"), F.lit(n).alias("n")) for c, t, n, _, _ in canvases])

    def cdiv(x: Column, by: int) -> Column:
        return F.floor((x * F.col("v.t") + F.lit(by - 1)) / F.lit(by)).cast("bigint")

    def tiles(lo: str, hi: str) -> Column:
        first = F.greatest(F.floor((F.col(lo) - size) / F.lit(step)).cast("int") + 1, F.lit(0))
        last = F.least(F.ceil(F.col(hi) / F.lit(step)).cast("int") - 1, F.col("n") - 1)
        return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    def part(lo: str, hi: str, i: str) -> Column:
        return F.least(F.col(hi), F.col(i) * step + size) - F.greatest(F.col(lo), F.col(i) * step)

    x = pieces.select("ImageId", "col", "r0", "r1", F.explode(table).alias("v"))
    x = x.select("ImageId", "v.cohort", "v.n", cdiv(F.col("col"), width).alias("x0"), cdiv(F.col("col") + 1, width).alias("x1"),
                 cdiv(F.col("r0"), height).alias("y0"), cdiv(F.col("r1"), height).alias("y1"))
    x = x.filter((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))
    x = x.withColumn("ix", F.explode(tiles("x0", "x1"))).withColumn("iy", F.explode(tiles("y0", "y1")))
    mass = part("x0", "x1", "ix") * part("y0", "y1", "iy")
    return x.groupBy("ImageId", "cohort", (F.col("iy") * F.col("n") + F.col("ix")).cast("int").alias("tile")).agg(F.sum(mass).cast("bigint").alias("mask_area"))


def annotated_tiles(ann: DataFrame, canvases=CANVASES, size: int = 256, height: int = C.CANVAS_H, width: int = C.CANVAS_W) -> DataFrame:
    """:func:`canvas_tiles` of the annotations' texts, measured where they are read (``tiles.tile_masses``)."""
    return tile_masses(ann, [(c[0], c[1], c[2]) for c in canvases], size, height, width).withColumnRenamed("canvas", "cohort")


def tile_names(areas: DataFrame, canvases=CANVASES, min_area: int = 64) -> DataFrame:
    """W4 + P8 + P6: each canvas's fullest tiles of an image, with their names: ``(ImageId, cohort, resize, tile, mask_area, sample)``."""
    w = Window.partitionBy("ImageId", "cohort").orderBy(F.desc("mask_area"), F.desc("tile"))
    top = areas.withColumn("place", F.row_number().over(w)).filter(F.col("mask_area") >= min_area)
    return _named(top.filter(F.col("place") <= _canvas_value(canvases, 3)), canvases)


def fullest_tiles(ann: DataFrame, canvases=CANVASES, min_area: int = 64, size: int = 256, height: int = C.CANVAS_H, width: int = C.CANVAS_W) -> DataFrame:
    """:func:`tile_names` of the annotations' texts, chosen where they are measured (``tiles.fullest_tiles``)."""
    top = T.fullest_tiles(ann, [c[:4] for c in canvases], min_area, size, height, width)
    return _named(top.withColumnRenamed("canvas", "cohort"), canvases)


def _canvas_value(canvases, i: int) -> Column:
    """Field ``i`` of the cohort's canvas."""
    out = F.lit(None)
    for c in canvases:
        out = F.when(F.col("cohort") == c[0], F.lit(c[i])).otherwise(out)
    return out


def _named(top: DataFrame, canvases) -> DataFrame:
    sample = sample_name("ImageId", F.concat(_canvas_value(canvases, 4), F.col("tile").cast("string")))
    return top.select("ImageId", "cohort", _canvas_value(canvases, 1).alias("resize"), "tile", "mask_area", sample.alias("sample"))


def dealt(records: DataFrame, seed, shards: dict[str, int]) -> DataFrame:
    """O2 + W2 per list: seeded order of the samples, then contiguous shards of ceil(N / shards) samples."""
    ranked = bucket_rank(records, md5_key(seed, "sample"), ["sample"], groups=["split"])
    n = F.lit(None)
    for split, k in shards.items():
        n = F.when(F.col("split") == split, F.lit(k)).otherwise(n)
    j = attach(ranked, group_counts(records, ["split"], "_N"), ["split"])
    per = F.ceil(F.col("_N") / n)
    return j.select(*records.columns, F.floor((F.col("rn") - 1) / per).cast("int").alias("shard_id"), (F.col("rn") - 1).cast("bigint").alias("seq"))


def make_tiled_set(ann: DataFrame, seed, val_frac: float = 0.05, last_negatives: int = LAST_NEGATIVES, shards: dict[str, int] = SHARDS, min_area: int = 64) -> DataFrame:
    """Records ``(split, shard_id, seq, sample, ImageId, resize, tile)``; ``seq`` is the order inside the list, ``tile`` null for
    images read whole. Validation images are in no training list; an image with a broken text is in no list at all
    (``annotations.quarantine`` reports its rows)."""
    img = cut_lineage(image_table(ann), eager=False).filter("NOT broken")
    ships = img.filter("ships > 0")
    sp = S.stratified_split(ships.withColumn("class", C.area_class(F.col("area"), C.BINS_A)), val_frac, seed)
    sp = cut_lineage(sp.select("ImageId", "split", *[c[0] for c in A.COHORTS_TILING]), eager=False)
    val, train = sp.filter("split = 'val'"), sp.filter("split = 'train'")
    empty = img.filter("ships = 0").select("ImageId")
    pairs = S.balance_pair(val.select("ImageId"), empty, seed)
    used = pairs.filter("list = 'b'").select("ImageId")
    negatives = S.last_n(S.shuffled(S.anti(empty, used), seed), last_negatives).select("ImageId")
    none, whole = F.lit(None).cast("int"), F.lit(WHOLE_SIZE)
    lists = negatives.select(F.lit("train-1").alias("split"), sample_name("ImageId", "_1").alias("sample"), "ImageId", whole.alias("resize"), none.alias("tile"))
    lists = lists.unionByName(train.filter(WHOLE[0]).select(F.lit("train-5").alias("split"), sample_name("ImageId", WHOLE[1]).alias("sample"), "ImageId", whole.alias("resize"), none.alias("tile")))
    # the tiles of an image and its one row of flags meet by image alone
    member = train.select("ImageId", *[F.col(c[0]).alias(f"_{c[0]}") for c in CANVASES])
    own = F.lit(False)
    for c in CANVASES:
        own = own | ((F.col("cohort") == c[0]) & F.col(f"_{c[0]}"))
    tiles = fullest_tiles(A.drop_blocked(ann), min_area=min_area).join(member, "ImageId").filter(own)
    lists = lists.unionByName(tiles.select(F.lit("train").alias("split"), "sample", "ImageId", "resize", "tile"))
    out = dealt(saved(lists, "lists"), seed, shards)  # ranks and counts read them several times
    names = pairs.select("ImageId", sample_name("ImageId", "").alias("sample"))
    checked = _pairs_to_records(pairs, "val", 2, shards["val"]).join(names, "sample")
    checked = checked.select("split", "sample", "ImageId", F.lit(C.CANVAS_H).alias("resize"), none.alias("tile"), "shard_id", "seq")
    return out.unionByName(checked).select("split", "shard_id", "seq", "sample", "ImageId", "resize", "tile")


def write_tiled_set(records: DataFrame, root: str, shards: dict[str, int] = SHARDS) -> DataFrame:
    """All lists in one write, each with its own number of shards; returns the manifest, empty shards included."""
    return IO.write_shards(records, root, shards).select("split", "shard_id", "shard_name", "n")
