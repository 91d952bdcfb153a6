"""Deterministic sampling, splitting and ordering.

Every random choice of the reference (``random.sample``, ``random.shuffle``, ``train_test_split``) is unseeded there.
Here the order is ``md5(seed ':' id)`` with the id as tie-break: the same membership on every run, under any
partitioning, and computable by the same expression in SQL. Ranks come from :func:`ranking.bucket_rank`, so no step
runs a whole class or list in one task. Totals are one-row tables and broadcast; counts and quotas by group are joined
null-safely, broadcast only if Spark finds them small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskframe.functions.keys import md5_key
from maskframe.operators.ranking import attach, bucket_rank, group_counts

ID = "ImageId"


def shuffle_key(seed, id_col: str = ID, epoch=None):
    """O2: the order key ``md5(seed:id)`` (O5 adds the epoch: ``md5(seed:epoch:id)``)."""
    return md5_key(seed, id_col) if epoch is None else md5_key(seed, epoch, id_col)


def shuffled(df: DataFrame, seed, id_col: str = ID, out: str = "rn") -> DataFrame:
    """O2: global position in the seeded shuffle (1-based)."""
    return bucket_rank(df, shuffle_key(seed, id_col), [id_col], out=out)


def reader_shuffle(df: DataFrame, seed, epochs: int, id_col: str = ID) -> DataFrame:
    """One seeded order per epoch, every row repeated ``epochs`` times in place."""
    x = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    return bucket_rank(x, md5_key(seed, "epoch", id_col), [id_col], groups=["epoch"], out="pos")


def nulls_first_rank(df: DataFrame, seed, flag_col: str = "isnan", id_col: str = ID, out: str = "rn") -> DataFrame:
    """O1: order by the null flag descending, then by the seeded key (the reference's sort is unstable, so the
    order within a flag value is arbitrary there; here it is the seeded one)."""
    key = F.concat((F.lit(1) - F.col(flag_col)).cast("string"), shuffle_key(seed, id_col))
    return bucket_rank(df, key, [id_col], prefix_len=4, out=out)


def drop_first(df: DataFrame, n: int, rank_col: str = "rn") -> DataFrame:
    """All but the first ``n`` rows by rank (if there are fewer than n flagged rows, others go too)."""
    return df.filter(F.col(rank_col) > n)


def first_n(df: DataFrame, n: int, rank_col: str = "rn") -> DataFrame:
    """The first ``n`` rows by rank."""
    return df.filter(F.col(rank_col) <= n)


def last_n(df: DataFrame, n: int, rank_col: str = "rn", groups=()) -> DataFrame:
    """The last ``n`` rows by rank (total from the tiny count table)."""
    cnt = group_counts(df, list(groups), "_total") if groups else df.agg(F.count(F.lit(1)).alias("_total"))
    j = attach(df, cnt, list(groups)) if groups else df.crossJoin(F.broadcast(cnt))
    return j.filter(F.col(rank_col) > F.col("_total") - n).drop("_total")


def drop_first_negatives(rows: DataFrame, n: int, seed, flag_col: str = "isnan", id_col: str = ID) -> DataFrame:
    """Sort by the null flag descending, then by the seeded key, and drop the first ``n`` rows.

    Only flagged rows are ranked (they carry no text). The others pass the scan untouched unless ``n`` exceeds the
    number of flagged rows: then their keys alone are ranked, and the key of the last row to go, one value, is the
    bound below which the scan drops them (rows of the id at the bound go together)."""
    flagged = rows.filter(F.col(flag_col) == 1)
    rest = rows.filter(F.coalesce(F.col(flag_col), F.lit(0)) != 1)
    left = drop_first(bucket_rank(flagged, shuffle_key(seed, id_col), [id_col], out="_rn"), n, "_rn").drop("_rn")
    more = flagged.agg((F.lit(n) - F.count(F.lit(1))).alias("_more"))
    keys = rest.select(shuffle_key(seed, id_col).alias("_key")).crossJoin(F.broadcast(more)).filter("_more > 0")
    last = bucket_rank(keys, "_key", [], out="_rn").filter(F.col("_rn") <= F.col("_more")).agg(F.max("_key").alias("_last"))
    passed = rest.crossJoin(F.broadcast(last)).filter(F.col("_last").isNull() | (shuffle_key(seed, id_col) > F.col("_last")))
    return left.unionByName(passed.drop("_last"))


def stratified_split(images: DataFrame, frac: float, seed, class_col: str = "class", id_col: str = ID) -> DataFrame:
    """Add ``split`` in {'train', 'val'} keeping class shares.

    n_val = ceil(frac * N); class c gets floor(n_val * n_c / N) plus one of the remaining places by largest
    remainder (ties: lower class first) -- scikit-learn breaks remainder ties at random, a documented deviation.
    A class with fewer than two members fails the job, as in the reference. Inside a class the first ``quota`` ids
    in md5 order go to validation."""
    counts = group_counts(images, [class_col], "n_c")
    tot = Window.partitionBy(F.lit(0))
    q = counts.withColumn("N", F.sum("n_c").over(tot))
    q = q.withColumn("n_val", F.ceil(F.lit(frac) * F.col("N")).cast("bigint"))
    q = q.withColumn("prod", F.col("n_val") * F.col("n_c"))
    q = q.withColumn("fl", F.floor(F.col("prod") / F.col("N")).cast("bigint"))
    q = q.withColumn("rem", F.col("prod") - F.col("fl") * F.col("N"))
    q = q.withColumn("extra", F.col("n_val") - F.sum("fl").over(tot))
    q = q.withColumn("rr", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("rem"), F.asc(class_col))))
    q = q.withColumn("quota", F.col("fl") + (F.col("rr") <= F.col("extra")).cast("bigint"))
    q = q.withColumn(
        "quota",
        F.when(F.col("n_c") < 2, F.raise_error(F.lit("stratified split: a class has fewer than 2 members"))).otherwise(
            F.col("quota")
        ),
    ).select(class_col, "quota")
    ranked = bucket_rank(images, shuffle_key(seed, id_col), [id_col], groups=[class_col], out="_rn")
    j = attach(ranked, q, [class_col])
    return j.withColumn("split", F.when(F.col("_rn") <= F.col("quota"), "val").otherwise("train")).drop("_rn", "quota")


def split_quota(images: DataFrame, frac: float, class_col: str = "class") -> DataFrame:
    """The R1 quota table itself (class, n_c, quota)."""
    s = stratified_split(images.select(ID, class_col), frac, 0, class_col)
    return s.groupBy(class_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_c"),
        F.sum((F.col("split") == "val").cast("bigint")).cast("bigint").alias("quota"),
    )


def sample_n(ids: DataFrame, n: int, seed, id_col: str = ID, groups=()) -> DataFrame:
    """``n`` ids without replacement (per group); more than available fails the job, as ``random.sample`` does."""
    g = list(groups)
    cnt = group_counts(ids, g, "_n") if g else ids.agg(F.count(F.lit(1)).alias("_n"))
    r = bucket_rank(ids, shuffle_key(seed, id_col), [id_col], groups=g, out="_rn")
    j = attach(r, cnt, g) if g else r.crossJoin(F.broadcast(cnt))
    limit = F.when(F.col("_n") < n, F.raise_error(F.lit("sample larger than population"))).otherwise(F.lit(n))
    return j.filter(F.col("_rn") <= limit).drop("_rn", "_n")


def balance_pair(a: DataFrame, b: DataFrame, seed, id_col: str = ID) -> DataFrame:
    """R2: down-sample two id lists to the size of the smaller; returns ``(id, list, rn)`` with list in {a, b} and
    ``rn`` the 1-based position inside the kept sample (pairs are formed by equal ``rn``)."""
    u = a.select(id_col, F.lit("a").alias("list")).unionByName(b.select(id_col, F.lit("b").alias("list")))
    r = bucket_rank(u, shuffle_key(seed, id_col), [id_col], groups=["list"], out="rn")
    m = u.agg(F.least(F.sum((F.col("list") == "a").cast("bigint")), F.sum((F.col("list") == "b").cast("bigint"))).alias("_m"))
    return r.crossJoin(F.broadcast(m)).filter(F.col("rn") <= F.col("_m")).drop("_m")


def ship_class_lists(images: DataFrame, seed, class_col: str = "class", id_col: str = ID) -> DataFrame:
    """``lot`` = class > 2; ``few`` = a sample of classes 1 and 2 together, as large as ``lot``."""
    lot = images.filter(F.col(class_col) > 2).select(id_col, F.lit("lot").alias("list"))
    pool = images.filter(F.col(class_col).isin(1, 2)).select(id_col)
    n_lot = lot.agg(F.count(F.lit(1)).alias("_m"))
    r = bucket_rank(pool, shuffle_key(seed, id_col), [id_col], out="_rn")
    few = r.crossJoin(F.broadcast(n_lot)).filter(F.col("_rn") <= F.col("_m")).select(id_col, F.lit("few").alias("list"))
    return lot.unionByName(few)


def split_term(images: DataFrame, seed, class_col: str = "class", id_col: str = ID) -> DataFrame:
    """``lot`` = class > 2 plus the first half of class 2; ``few`` = the rest of class 2 plus a sample of
    class 1 as large as the original ``lot`` (before the class-2 half was added)."""
    c = images.select(id_col, class_col)
    r2 = bucket_rank(c.filter(F.col(class_col) == 2), shuffle_key(seed, id_col), [id_col], out="_rn")
    n2 = c.filter(F.col(class_col) == 2).agg(F.floor(F.count(F.lit(1)) / 2).cast("bigint").alias("_half"))
    half = r2.crossJoin(F.broadcast(n2)).select(
        id_col, F.when(F.col("_rn") <= F.col("_half"), "lot").otherwise("few").alias("list")
    )
    lot = c.filter(F.col(class_col) > 2).select(id_col, F.lit("lot").alias("list"))
    n_lot = c.filter(F.col(class_col) > 2).agg(F.count(F.lit(1)).alias("_m"))
    r1 = bucket_rank(c.filter(F.col(class_col) == 1), shuffle_key(seed, id_col), [id_col], out="_rn")
    few1 = r1.crossJoin(F.broadcast(n_lot)).filter(F.col("_rn") <= F.col("_m")).select(id_col, F.lit("few").alias("list"))
    return lot.unionByName(half).unionByName(few1)


def val_negative_quota(images: DataFrame, val_positive_ids: DataFrame, seed, id_col: str = ID) -> DataFrame:
    """As many negative images (area 0) for validation as there are validation positives; the rest of the
    negatives stay in training. Returns the negatives with ``split``."""
    neg = images.filter(F.col("area") == 0).select(id_col)
    n_pos = val_positive_ids.agg(F.count(F.lit(1)).alias("_m"))
    r = bucket_rank(neg, shuffle_key(seed, id_col), [id_col], out="_rn")
    return r.crossJoin(F.broadcast(n_pos)).select(
        id_col, F.when(F.col("_rn") <= F.col("_m"), "val").otherwise("train").alias("split")
    )


def shard_assign(rows: DataFrame, num_shards: int, rank_col: str = "rn", groups=()) -> DataFrame:
    """Contiguous blocks of ``ceil(N / n)`` rows per shard (the last may be short or empty)."""
    g = list(groups)
    cnt = group_counts(rows, g, "_N") if g else rows.agg(F.count(F.lit(1)).alias("_N"))
    j = attach(rows, cnt, g) if g else rows.crossJoin(F.broadcast(cnt))
    per = F.ceil(F.col("_N") / F.lit(num_shards))
    return j.withColumn("shard_id", F.floor((F.col(rank_col) - 1) / per).cast("int")).drop("_N")


def batch_assign(rows: DataFrame, batch_size: int, training: bool, rank_col: str = "rn") -> DataFrame:
    """``batch_id = (rn - 1) div batch``; when training the short last batch is dropped."""
    cnt = rows.agg(F.count(F.lit(1)).alias("_N"))
    j = rows.crossJoin(F.broadcast(cnt)).withColumn("batch_id", F.floor((F.col(rank_col) - 1) / batch_size).cast("bigint"))
    if training:
        j = j.filter(F.col("batch_id") < F.floor(F.col("_N") / batch_size))
    return j.withColumn("pos_in_batch", ((F.col(rank_col) - 1) % batch_size).cast("int")).drop("_N")


def semi(rows: DataFrame, ids: DataFrame, id_col: str = ID) -> DataFrame:
    """Rows whose image is in ``ids``."""
    return rows.join(ids.select(id_col), id_col, "left_semi")


def anti(rows: DataFrame, ids: DataFrame, id_col: str = ID) -> DataFrame:
    """Rows whose image is not in ``ids``. (The reference's ``drop`` discards its result, so validation
    images stay in training there; this is the intended behaviour.)"""
    return rows.join(ids.select(id_col), id_col, "left_anti")


def split_leakage(train: DataFrame, val: DataFrame, id_col: str = ID) -> DataFrame:
    """Ids present in both splits (must be empty after J3)."""
    return train.select(id_col).distinct().join(val.select(id_col).distinct(), id_col, "inner")
