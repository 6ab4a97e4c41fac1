"""Several sources as one dataset, and work that is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.operators.skew import attach

# Fields left out of cleaned results.
DROPPED_FIELDS = ("true_score", "reference_output", "reason_only")


def drop_fields(df: DataFrame, fields: tuple[str, ...] = DROPPED_FIELDS) -> DataFrame:
    """Remove fields; absent ones are no error."""
    return df.drop(*fields)


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources as one table, each row tagged with the name of its source."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    merged = tagged[0]
    for other in tagged[1:]:
        merged = merged.unionByName(other)
    return merged


def source_counts(df: DataFrame, source: str = "source") -> DataFrame:
    """Records per source, and in total (source null)."""
    return df.rollup(source).agg(F.count(F.lit(1)).alias("n_records"))


def pending_files(src: DataFrame, done: DataFrame, on: str = "out_path") -> DataFrame:
    """Source rows whose output does not exist yet (an anti join that withstands hot names)."""
    outputs = done.select(on).distinct().withColumn("_done", F.lit(True))
    return attach(src, outputs, [on], "left").filter(F.col("_done").isNull()).drop("_done")


def report_order(df: DataFrame, id_: str = "id") -> DataFrame:
    """Input order, which is the id order. A global sort is range-partitioned."""
    return df.orderBy(id_)
