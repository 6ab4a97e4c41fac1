"""Pair metrics: errors and correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.functions.metrics import cosine, mse
from dossier.operators.ranking import avg_rank
from dossier.operators.skew import known
from dossier.session import written


def valid_pairs(df: DataFrame, pred: str, true: str) -> DataFrame:
    """Rows with both scores."""
    return df.filter(F.col(pred).isNotNull() & F.col(true).isNotNull())


def failed_pairs(df: DataFrame, pred: str, true: str) -> DataFrame:
    """Rows with a score missing, the complement of ``valid_pairs``."""
    return df.filter(F.col(pred).isNull() | F.col(true).isNull())


def pair_counts(df: DataFrame, pred: str, true: str) -> DataFrame:
    """Numbers of all, valid and failed rows in one pass."""
    failed = F.col(pred).isNull() | F.col(true).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~failed).alias("n_valid"),
        F.count_if(failed).alias("n_failed"),
    )


def _pair_sums(df: DataFrame, a: str, b: str, by: list[str]) -> DataFrame:
    """Weighted sums behind all pair metrics, one row per group (one in total without ``by``).

    The input, often a model run, is read once: distinct (a, b) pairs with their counts
    are written to the shared work folder and everything else starts from that table.
    Joins of ranks and centres are left to the adaptive skew join.
    Ranks deviate from their mean (n + 1) / 2 and values from theirs before they are
    multiplied, so nothing cancels at large n.
    """
    group = by or ["_all"]
    valid = valid_pairs(df, a, b)
    keyed = known(valid, by) if by else valid.withColumn("_all", F.lit(0))
    pairs = written(keyed.groupBy(*group, a, b).agg(F.count(F.lit(1)).alias("_w")), "pairs")
    rank_a = avg_rank(pairs, a, group, "_w").select(*group, a, F.col("rank").alias("_ra"))
    rank_b = avg_rank(pairs, b, group, "_w").select(*group, b, F.col("rank").alias("_rb"))
    ranked = pairs.join(rank_a, [*group, a]).join(rank_b, [*group, b])

    w, x, y = F.col("_w"), F.col(a).cast("double"), F.col(b).cast("double")
    centres = pairs.groupBy(*group).agg(
        ((F.sum(w) + 1) / 2).alias("_mid"),
        (F.sum(w * x) / F.sum(w)).alias("_ma"), (F.sum(w * y) / F.sum(w)).alias("_mb"),
    )
    centred = ranked.join(centres, group)
    dx, dy = x - F.col("_ma"), y - F.col("_mb")
    rx, ry = F.col("_ra") - F.col("_mid"), F.col("_rb") - F.col("_mid")
    return centred.groupBy(*by).agg(
        F.coalesce(F.sum(w), F.lit(0)).alias("n"),
        ((F.min(x) < F.max(x)) & (F.min(y) < F.max(y))).alias("_varies"),
        F.sum(w * (x - y) * (x - y)).alias("_square"), F.sum(w * F.abs(x - y)).alias("_absolute"),
        F.sum(w * dx * dy).alias("_xy"), F.sum(w * dx * dx).alias("_xx"), F.sum(w * dy * dy).alias("_yy"),
        F.sum(w * rx * ry).alias("_rxy"), F.sum(w * rx * rx).alias("_rxx"), F.sum(w * ry * ry).alias("_ryy"),
    )


def _correlation(xy: str, xx: str, yy: str):
    """Null unless both sides vary; a rounded mean would leave a trace of variance."""
    return F.when(F.col("_varies"), F.try_divide(F.col(xy), F.sqrt(xx) * F.sqrt(yy)))


def spearman(df: DataFrame, a: str, b: str, by: list[str] = (), out: str = "spearman") -> DataFrame:
    """Pearson correlation of average ranks; null for constant input or one row."""
    by = list(by)
    return _pair_sums(df, a, b, by).select(*by, _correlation("_rxy", "_rxx", "_ryy").alias(out))


def evaluate_pairs(df: DataFrame, pred: str, true: str, by: list[str] = ()) -> DataFrame:
    """n, MSE, MAE, Pearson and Spearman over valid rows, in total or per (known) group."""
    by = list(by)
    return _pair_sums(df, pred, true, by).select(
        *by, "n",
        F.try_divide(F.col("_square"), F.col("n")).alias("mse"),
        F.try_divide(F.col("_absolute"), F.col("n")).alias("mae"),
        _correlation("_xy", "_xx", "_yy").alias("pearson"),
        _correlation("_rxy", "_rxx", "_ryy").alias("spearman"),
    )


def cosine_loss(df: DataFrame, cos: str, label: str) -> DataFrame:
    """MSE of cosine against label, one minus the mean cosine, and their sum."""
    error, loss = mse(F.col(cos), F.col(label)), 1 - F.avg(cos)
    return df.agg(error.alias("mse"), loss.alias("cosine_loss"), (error + loss).alias("loss"))


def mean_pool(df: DataFrame, id_: str, vec: str, out: str = "pooled") -> DataFrame:
    """Mean over the token vectors of each text, padding included.

    The vector aggregate is combined map-side: one vector per text leaves each task.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    vectors = df.select(id_, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    pooled = vectors.groupBy(id_).agg(Summarizer.mean(F.col("_v")).alias("_mean"))
    return pooled.select(id_, vector_to_array("_mean").alias(out))


def pair_similarity(df: DataFrame, a: str, b: str, out: str = "predicted_score") -> DataFrame:
    """Cosine of two embedding columns as the predicted score."""
    return df.withColumn(out, cosine(F.col(a), F.col(b)))
