"""Scaling, top-k and average ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.operators.skew import attach, bucketed, known, running_before, split_points

TOP_K = 5


def _scaled(score: str):
    """Min-max value; a group without spread gets 0."""
    span = F.col("_high") - F.col("_low")
    return F.when(span == 0, F.lit(0.0)).otherwise((F.col(score) - F.col("_low")) / span)


def _extremes(df: DataFrame, group: str, score: str) -> DataFrame:
    value = F.col(score).cast("double")
    return df.groupBy(group).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high")
    )


def minmax_by_group(df: DataFrame, group: str, score: str, out: str = "normalized_score") -> DataFrame:
    """Scale the score to [0, 1] inside each group.

    The extremes are aggregated (map-side combine) and joined back; a window over the
    group would sort a hot group in one task.
    """
    joined = attach(df, _extremes(df, group, score), [group])
    return joined.withColumn(out, _scaled(score)).drop("_low", "_high")


def top_k_by_group(df: DataFrame, group: str, score: str, tie: str, k: int = TOP_K, out: str = "rank") -> DataFrame:
    """The ``k`` best rows of each group, ties by ascending ``tie``.

    Spark limits each group to ``k`` rows before the shuffle (WindowGroupLimit), for ``k`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 unless set). Raise that for more.
    """
    w = Window.partitionBy(group).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def top_k_scaled(
    df: DataFrame, group: str, score: str, tie: str, k: int = TOP_K, out: str = "normalized_score"
) -> DataFrame:
    """``minmax_by_group`` followed by ``top_k_by_group``, without scaling rows that drop out.

    Scaling keeps the order, so the best rows are picked on raw scores and only these
    are joined to the extremes of their group. With no spread in a group all scaled
    scores tie and raw scores are equal too, so the tie column decides in both forms.
    """
    best = top_k_by_group(df, group, score, tie, k)
    scaled = best.join(_extremes(df, group, score), group).withColumn(out, _scaled(score))
    return scaled.drop("_low", "_high")


def attach_jobs(ranked: DataFrame, jobs: DataFrame, on: str = "job_title") -> DataFrame:
    """Job description for each row. Ranked rows are at most k per job; for unranked ones
    the adaptive join splits a hot job."""
    return ranked.join(jobs, on)


def avg_rank(
    df: DataFrame, value: str, by: list[str] = (), weight: str | None = None, parts: int | None = None
) -> DataFrame:
    """One row per distinct value (and group): its count and tie-averaged rank.

    Equal values are merged first, so a hot value is one row. Distinct values are
    then numbered per range of values, and the ranges are joined by their counts.
    ``weight`` says how many records a row stands for (1 if not given).
    Returns ``by``, ``value``, ``n``, ``rank``. Rows without group or value are left out.
    """
    by = list(by)
    rows = known(df, [*by, value])
    points = split_points(rows, value, parts)
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    histogram = bucketed(rows.groupBy(*by, value).agg(amount.alias("n")), value, points)
    counts = histogram.groupBy(*by, "_bucket").agg(F.sum("n").alias("_n"))
    starts = running_before(counts, "_bucket", "_n", "_start", by).drop("_n")
    below = F.sum("n").over(
        Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        histogram.withColumn("_below", F.coalesce(below, F.lit(0)))
        .join(starts, [*by, "_bucket"])
        .select(*by, value, "n", (F.col("_start") + F.col("_below") + (F.col("n") + 1) / 2).alias("rank"))
    )
