"""Boosted trees with a score per iteration, so that the best iteration can be kept."""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.operators.logs import best_epoch


def fit_boosted(train: DataFrame, label: str = "label", features: str = "features", iterations: int = 20, depth: int = 4,
                step: float = 0.3, seed: int = 42) -> GBTRegressionModel:
    """Gradient-boosted regression trees. Every iteration is a pass over ``train``; write it first."""
    return GBTRegressor(featuresCol=features, labelCol=label, predictionCol="_boosted", maxIter=iterations, maxDepth=depth,
                        stepSize=step, seed=seed, cacheNodeIds=False, checkpointInterval=-1).fit(train)


def iteration_log(model: GBTRegressionModel, validation: DataFrame, label: str = "label") -> DataFrame:
    """``epoch`` (from 0), ``trees``, ``n``, ``mse`` and ``mae`` of the first 1, 2, ... trees on ``validation``.

    All iterations are scored in one pass: each row gets the running sums of its tree predictions.
    """
    total, sums = F.lit(0.0), []
    rows = validation.filter(F.col(label).isNotNull())
    for i, tree in enumerate(model.trees):
        rows = tree.copy().setFeaturesCol(model.getFeaturesCol()).setPredictionCol(f"_tree{i}").transform(rows)
        total = total + F.lit(float(model.treeWeights[i])) * F.col(f"_tree{i}")
        sums.append(F.struct(F.lit(i).alias("epoch"), total.alias("p")))
    error = F.col("x.p") - F.col(label)
    scored = rows.select(label, F.explode(F.array(*sums)).alias("x"))
    return scored.groupBy("x.epoch").agg(
        F.count(F.lit(1)).alias("n"), F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae")
    ).select("epoch", (F.col("epoch") + 1).alias("trees"), "n", "mse", "mae")


def select_iteration(train: DataFrame, validation: DataFrame, label: str = "label", features: str = "features", metric: str = "mse",
                     places: int = 12, **settings) -> tuple[GBTRegressionModel, int, DataFrame]:
    """Fit, score every iteration on ``validation``, keep the best. Returns model, number of trees and log.

    The lowest error wins, the earliest iteration of equal ones; errors are rounded to ``places`` so that
    sums in another order do not decide. Without validation rows all trees are kept.
    """
    model = fit_boosted(train, label, features, **settings)
    log = iteration_log(model, validation, label)
    log = log.sparkSession.createDataFrame(log.collect(), log.schema)  # one row per iteration
    best = best_epoch(log.withColumn(metric, F.round(metric, places)), metric, "min").head()
    return model, best["epoch"] + 1 if best else model.getNumTrees, log


def score_boosted(model: GBTRegressionModel, df: DataFrame, trees: int, out: str = "predicted_score") -> DataFrame:
    """Prediction of the first ``trees`` trees."""
    total, rows = F.lit(0.0), df
    for i, tree in enumerate(model.trees[:trees]):
        rows = tree.copy().setFeaturesCol(model.getFeaturesCol()).setPredictionCol(f"_tree{i}").transform(rows)
        total = total + F.lit(float(model.treeWeights[i])) * F.col(f"_tree{i}")
    return rows.select(*df.columns, total.alias(out))
