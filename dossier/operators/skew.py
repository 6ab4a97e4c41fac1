"""Building blocks that keep one hot key from landing in one task.

Three ideas are shared by the other operators:

* ``attach``: many-to-one join that treats keys apart which would overfill a partition.
  Their rows are broadcast, all other keys have a bounded share and are shuffled.
* blocks: an integer position is cut into ranges of ``BLOCK`` values. Work inside a
  group runs per (group, block); only one row per block crosses the whole group.
* buckets: a global order is cut into as many ranges as there are shuffle partitions.
  Only the bucket counts are ordered in one place, which are few.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65536


def attach(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``facts`` to ``dim``, which has one row per key ``on``.

    A key is hot if it has more facts than a shuffle partition has on average, so there
    are fewer hot keys than partitions. Their rows of ``dim`` are broadcast and their facts
    stay where they are, equal ones included. All other facts are shuffled by key, which adds
    at most one average partition to any partition. Keys are counted in the plan (key
    columns only, combined map-side). ``facts`` is read three times; write it first if
    it is costly. ``how`` is ``inner`` or ``left``; null keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    values = [F.col(f"_dim.{c}").alias(c) for c in dim.columns if c not in on]
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = known(facts, on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot = counts.filter(F.col("_n") * parts > total).select(*on, F.lit(True).alias("_hot"))
    payload = dim.select(*on, F.struct(F.lit(True).alias("found"), *[c for c in dim.columns if c not in on]).alias("_dim"))
    marked = known(facts, on).join(F.broadcast(hot), on, "left")
    cold_part = marked.filter(F.col("_hot").isNull()).join(payload, on, how)
    hot_payload = payload.join(F.broadcast(hot.select(*on)), on, "left_semi")
    hot_part = marked.filter(F.col("_hot").isNotNull()).join(F.broadcast(hot_payload), on, how)
    out = cold_part.unionByName(hot_part).select(*facts.columns, *values)
    if how == "left":
        missing = F.lit(False)
        for key in on:
            missing = missing | F.col(key).isNull()
        nothing = [F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in dim.columns if c not in on]
        out = out.unionByName(facts.filter(missing).select(*facts.columns, *nothing))
    return out


def split_points(df: DataFrame, column: str, parts: int | None = None) -> list[float]:
    """About ``parts`` - 1 quantiles of a numeric column, found in one pass.

    Only these few numbers reach the driver. They are fixed values of the plan, so
    every branch and every retry sees the same bucket borders.
    """
    if parts is None:
        parts = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / parts for i in range(1, parts)]
    return sorted(set(df.approxQuantile(column, shares, 1 / (4 * parts))))


def bucketed(df: DataFrame, column: str, points: list[float], out: str = "_bucket") -> DataFrame:
    """Number of the range between ``points`` that holds the value; not-a-number comes last."""
    if not points:
        return df.withColumn(out, F.lit(0.0))
    splits = [float("-inf"), *points, float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol=out, handleInvalid="keep").transform(df)


def known(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without nulls in the columns, as plain conditions that reach the scan."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def in_blocks(df: DataFrame, group: list[str], pos: str, block: int) -> DataFrame:
    """Add ``_block``, the first position of the row's block.

    Rows without group or position belong nowhere. Dropping them here, and not by the
    joins that follow, keeps the branches of a plan alike, so they share one shuffle.
    """
    placed = known(df, [*group, pos])
    return known(placed.withColumn("_block", F.col(pos) - F.pmod(F.col(pos), F.lit(block))), ["_block"])


def running_before(counts: DataFrame, order: str, amount: str, out: str, by: list[str] = ()) -> DataFrame:
    """Sum of ``amount`` over earlier rows. Meant for block or bucket counts, which are few."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(amount).over(w), F.lit(0)))


def with_index(df: DataFrame, key: str, out: str = "id", parts: int | None = None) -> DataFrame:
    """Contiguous 0-based index in the order of a unique numeric key.

    Quantile buckets are numbered in parallel; the bucket counts (``parts`` rows)
    give the start of each.
    """
    points = split_points(df, key, parts)
    cut = bucketed(df, key, points)
    counts = cut.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    starts = running_before(counts, "_bucket", "_n", "_start").select("_bucket", "_start")
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        cut.withColumn("_inside", inside)
        .join(F.broadcast(starts), "_bucket")
        .withColumn(out, F.col("_start") + F.col("_inside") - 1)
        .select(*df.columns, out)
    )


def position_in_group(
    df: DataFrame, group: list[str], pos: str, out: str, block: int = BLOCK
) -> DataFrame:
    """Contiguous 0-based position inside each group, by a unique integer ``pos``.

    A (group, block) pair holds at most ``block`` rows, however large the group.
    """
    blocked = in_blocks(df, group, pos, block)
    counts = blocked.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    starts = running_before(counts, "_block", "_n", "_start", group).select(*group, "_block", "_start")
    inside = F.row_number().over(Window.partitionBy(*group, "_block").orderBy(pos))
    return (
        blocked.withColumn("_inside", inside)
        .join(starts, [*group, "_block"])
        .withColumn(out, F.col("_start") + F.col("_inside") - 1)
        .select(*df.columns, out)
    )


def neighbours(
    df: DataFrame, group: list[str], pos: str, columns: list[str], block: int = BLOCK
) -> DataFrame:
    """Values of the rows before and after, as structs ``previous`` and ``next``.

    Inside a block this is ``lag`` and ``lead``. At block borders the last and first
    rows of the adjoining blocks are taken from one edge row per block.
    """
    values = F.struct(*columns)
    blocked = in_blocks(df, group, pos, block).withColumn("_values", values)
    edges = blocked.groupBy(*group, "_block").agg(
        F.min_by("_values", pos).alias("_first"), F.max_by("_values", pos).alias("_last")
    )
    across = Window.partitionBy(*group).orderBy("_block")
    edges = edges.select(
        *group, "_block",
        F.lag("_last").over(across).alias("_before"), F.lead("_first").over(across).alias("_after"),
    )
    inside = Window.partitionBy(*group, "_block").orderBy(pos)
    return (
        blocked.withColumn("previous", F.lag("_values").over(inside))
        .withColumn("next", F.lead("_values").over(inside))
        .join(edges, [*group, "_block"])
        .select(
            *df.columns,
            F.coalesce("previous", "_before").alias("previous"),
            F.coalesce("next", "_after").alias("next"),
        )
    )
