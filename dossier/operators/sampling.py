"""Reproducible splits, samples and shuffles by a digest of the record key.

The order of md5(seed:key) is random but fixed, on any partitioning. The key must be
unique. The leading 16 bits of the digest cut that order into 65,536 even buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.operators.skew import running_before

TEST_FRACTION = 0.1
SPLIT_SEED = 42
HOLDOUT_SEED = 1234
EVAL_ROWS = 100
SAMPLE_ROWS = 1500


def digest(key: str, *salt) -> Column:
    """md5 of the salt values and the key."""
    return F.md5(F.concat_ws(":", *[F.lit(str(s)) for s in salt], F.col(key).cast("string")))


def _hashed(df: DataFrame, key: str, *salt) -> DataFrame:
    hashed = df.withColumn("_hash", digest(key, *salt))
    return hashed.withColumn("_bucket", F.conv(F.substring("_hash", 1, 4), 16, 10).cast("int"))


def _bucket_starts(hashed: DataFrame) -> DataFrame:
    """Rows before each bucket and in it: at most 65,536 rows, so one task may order them."""
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy()
    return running_before(counts, "_bucket", "_n", "_start").withColumn("_total", F.sum("_n").over(everything))


def _flag_first(df: DataFrame, key: str, seed: int, size, out: str) -> DataFrame:
    """Mark the first ``size(total)`` rows in digest order.

    Whole buckets are decided by their counts. Only the rows of the one bucket that
    the cut falls into are ranked, so nothing else is shuffled. ``df`` is read three
    times instead; write it to a table first if it is costly to compute.
    """
    hashed = _hashed(df, key, seed)
    take = F.least(F.greatest(size(F.col("_total")) - F.col("_start"), F.lit(0)), F.col("_n"))
    plan = _bucket_starts(hashed).select("_bucket", "_n", take.alias("_take"))
    placed = hashed.join(F.broadcast(plan), "_bucket")
    divided = (F.col("_take") > 0) & (F.col("_take") < F.col("_n"))
    whole = placed.filter(~divided).withColumn(out, F.col("_take") > 0)
    order = Window.partitionBy("_bucket").orderBy("_hash", key)
    cut = placed.filter(divided).withColumn(out, F.row_number().over(order) <= F.col("_take"))
    return whole.unionByName(cut).select(*df.columns, out)


def split_exact(
    df: DataFrame, key: str, frac: float = TEST_FRACTION, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Disjoint (train, validation); validation has exactly ceil(n * frac) rows."""
    flagged = _flag_first(df, key, seed, lambda n: F.ceil(n * F.lit(frac)), "_in")
    return flagged.filter(~F.col("_in")).drop("_in"), flagged.filter("_in").drop("_in")


def split_flag(df: DataFrame, key: str, frac: float = TEST_FRACTION, seed: int = SPLIT_SEED, out: str = "is_validation"):
    """``split_exact`` as a flag column, for one pass over both parts."""
    return _flag_first(df, key, seed, lambda n: F.ceil(n * F.lit(frac)), out)


def split_groups(
    df: DataFrame, group: str, frac: float = TEST_FRACTION, seed: int = SPLIT_SEED, out: str = "is_validation"
) -> DataFrame:
    """``split_flag`` over whole groups: exactly ceil(groups * frac) of them are validation. Rows without group drop out."""
    groups = df.select(group).filter(F.col(group).isNotNull()).distinct()
    return df.join(split_flag(groups, group, frac, seed, out), group).select(*df.columns, out)


def holdout_sample(
    df: DataFrame, key: str, frac: float = TEST_FRACTION, seed: int = HOLDOUT_SEED
) -> DataFrame:
    """Second sample of the full set, round-half-even(n * frac) rows; may overlap training rows."""
    flagged = _flag_first(df, key, seed, lambda n: F.bround(n * F.lit(frac)).cast("long"), "_in")
    return flagged.filter("_in").drop("_in")


def overlap(train: DataFrame, holdout: DataFrame, key: str) -> DataFrame:
    """One row: sizes of the second sample and of its part that was trained on."""
    both = holdout.select(key).join(train.select(F.col(key), F.lit(True).alias("_in")), key, "left")
    return both.agg(F.count(F.lit(1)).alias("n_holdout"), F.count("_in").alias("n_overlap"))


def eval_limit(df: DataFrame, key: str, n: int = EVAL_ROWS) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(key).limit(n)


def sample_n(df: DataFrame, key: str, n: int = SAMPLE_ROWS, seed: int = SPLIT_SEED) -> DataFrame:
    """Uniform sample of ``n`` rows. Each task keeps its ``n`` smallest digests."""
    return df.withColumn("_hash", digest(key, seed)).orderBy("_hash", key).limit(n).drop("_hash")


def shuffle_rows(
    df: DataFrame, key: str, epoch: int = 0, seed: int = SPLIT_SEED, out: str = "position"
) -> DataFrame:
    """Random order of the rows as a 0-based position, another one for each epoch."""
    hashed = _hashed(df, key, epoch, seed)
    starts = _bucket_starts(hashed).select("_bucket", "_start")
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    return (
        hashed.withColumn("_inside", inside)
        .join(F.broadcast(starts), "_bucket")
        .withColumn(out, F.col("_start") + F.col("_inside") - 1)
        .select(*df.columns, out)
    )
