"""Training logs: row selection, sparse union, epoch means, best epoch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of a sparse metric log.
METRIC_COLUMNS = {
    "epoch": "double", "step": "bigint", "train_loss": "double", "eval_loss": "double",
    "precision": "double", "recall": "double", "f1": "double", "accuracy": "double",
}


def log_rows(df: DataFrame, train: str = "loss", eval_: str = "eval_loss") -> DataFrame:
    """Log entries that hold a training or an evaluation loss."""
    return df.filter(F.col(train).isNotNull() | F.col(eval_).isNotNull())


def epoch_base1(df: DataFrame, epoch: str = "epoch") -> DataFrame:
    """Epochs counted from one, for display."""
    return df.withColumn(epoch, F.col(epoch) + 1)


def metric_layout(df: DataFrame) -> DataFrame:
    """All metric log columns in order, null where the rows have none."""
    return df.select(
        *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in METRIC_COLUMNS.items()]
    )


def union_sparse(train: DataFrame, eval_: DataFrame) -> DataFrame:
    """Training rows and evaluation rows in one table, blank where a side has no value."""
    return train.unionByName(eval_, allowMissingColumns=True)


def epoch_mean_loss(df: DataFrame, epoch: str = "epoch", losses: tuple[str, ...] = ("loss",)) -> DataFrame:
    """Mean of the step losses of each epoch; every step weighs the same."""
    return df.groupBy(epoch).agg(*[F.avg(c).alias(f"mean_{c}") for c in losses])


def best_epoch(df: DataFrame, metric: str, mode: str = "max", epoch: str = "epoch") -> DataFrame:
    """The row of the best epoch: highest or lowest metric, the earliest on ties."""
    if mode not in ("max", "min"):
        raise ValueError(f"mode must be max or min, not {mode}")
    known = df.filter(F.col(metric).isNotNull())
    row = F.struct(*df.columns)
    if mode == "max":
        best = F.max_by(row, F.struct(F.col(metric), -F.col(epoch)))
    else:
        best = F.min_by(row, F.struct(F.col(metric), F.col(epoch)))
    return known.agg(best.alias("_best")).filter(F.col("_best").isNotNull()).select("_best.*")
