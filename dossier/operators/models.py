"""Baseline models on Spark ML: pair relevance and field tagging.

They fill the place of the neural models in the flow and train in parallel; their
quality is not comparable to those.
"""

from __future__ import annotations

from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, IndexToString, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.operators.evaluation import evaluate_pairs
from dossier.operators.logs import best_epoch
from dossier.operators.skew import neighbours
from dossier.session import written

PAIR_FEATURES = ("binary_cosine", "coverage_a", "coverage_b", "length_ratio")
PENALTIES = (0.0, 0.01, 0.1)


def _terms(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def pair_features(df: DataFrame, a: str = "text_a", b: str = "text_b") -> DataFrame:
    """Word overlap of two texts as four numbers, and as the vector ``features``."""
    size = lambda c: F.size(c).cast("double")
    share = lambda x, y: F.coalesce(F.try_divide(x, y), F.lit(0.0))
    words = df.withColumn("_a", _terms(F.col(a))).withColumn("_b", _terms(F.col(b)))
    sized = words.select(
        *df.columns, size("_a").alias("_na"), size("_b").alias("_nb"),
        size(F.array_intersect("_a", "_b")).alias("_both"),
    )
    na, nb, both = F.col("_na"), F.col("_nb"), F.col("_both")
    numbers = sized.select(
        *df.columns,
        share(both, F.sqrt(na * nb)).alias("binary_cosine"),
        share(both, na).alias("coverage_a"),
        share(both, nb).alias("coverage_b"),
        share(F.least(na, nb), F.greatest(na, nb)).alias("length_ratio"),
    )
    return VectorAssembler(inputCols=list(PAIR_FEATURES), outputCol="features").transform(numbers)


def _described(df: DataFrame) -> DataFrame:
    return df if "features" in df.columns else pair_features(df)


def fit_pair_scorer(train: DataFrame, label: str = "label", penalty: float = 0.0) -> Model:
    """Linear regression of relevance on word overlap, one pass over the data.

    Takes text pairs, or rows that ``pair_features`` has described and that are better
    written to a table when several models are fitted.
    """
    estimator = LinearRegression(
        featuresCol="features", labelCol=label, predictionCol="_raw", regParam=penalty, solver="normal"
    )
    return estimator.fit(_described(train))


def score_pairs(model: Model, df: DataFrame, out: str = "predicted_score") -> DataFrame:
    """Predicted relevance, held inside [0, 1]."""
    scored = model.transform(_described(df))
    held = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_raw")))
    return scored.withColumn(out, held).drop("features", "_raw", *PAIR_FEATURES)


def select_model(
    train: DataFrame, validation: DataFrame, label: str = "label", penalties=PENALTIES, metric: str = "spearman"
) -> tuple[Model, DataFrame]:
    """Fit one scorer per penalty, keep the best on validation.

    Returns the model and the log of metrics, one row per penalty. The predictions of
    all scorers are columns of one pass over the validation rows.
    """
    fitted = [fit_pair_scorer(train, label, penalty) for penalty in penalties]
    rows = _described(validation)
    for i, model in enumerate(fitted):
        rows = model.transform(rows).withColumnRenamed("_raw", f"_raw{i}")
    answers = F.array(*[
        F.struct(F.lit(i).alias("epoch"), F.lit(float(penalty)).alias("penalty"),
                 F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(f"_raw{i}"))).alias("predicted_score"))
        for i, penalty in enumerate(penalties)
    ])
    scored = rows.select(label, F.explode(answers).alias("answer")).select(label, "answer.*")
    log = written(evaluate_pairs(scored, "predicted_score", label, ["epoch", "penalty"]), "model-log")
    best = best_epoch(log, metric).head()
    return fitted[best["epoch"] if best else 0], log


def token_features(
    df: DataFrame, seq: str, pos: str, text: str = "text", box: str | None = None
) -> DataFrame:
    """Hashed token, its shape, its neighbours and its box, as ``features``."""
    near = neighbours(df, [seq], pos, [text])
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\p{Lu}", "X"), r"\p{Ll}", "x"), r"\p{N}", "0")
    described = (
        near.withColumn("_token", F.lower(text)).withColumn("_shape", F.regexp_replace(shape, r"(.)\1+", "$1"))
        .withColumn("_previous", F.coalesce(F.lower(F.col(f"previous.{text}")), F.lit("<start>")))
        .withColumn("_next", F.coalesce(F.lower(F.col(f"next.{text}")), F.lit("<end>")))
    )
    inputs = ["_token", "_shape", "_previous", "_next"]
    if box:
        for i in range(4):
            described = described.withColumn(f"_box{i}", F.col(box)[i].cast("double") / 1000)
        inputs += [f"_box{i}" for i in range(4)]
    hashed = FeatureHasher(inputCols=inputs, outputCol="features", numFeatures=1 << 14).transform(described)
    return hashed.select(*df.columns, "features")


def fit_field_tagger(tokens: DataFrame, labels, label: str = "label", iterations: int = 20) -> Pipeline:
    """Multinomial logistic regression from token features to field labels.

    The label dictionary is fixed, so no pass is spent on finding labels.
    """
    ids = StringIndexerModel.from_labels(list(labels), inputCol=label, outputCol="_label", handleInvalid="skip")
    tagger = LogisticRegression(
        featuresCol="features", labelCol="_label", predictionCol="_tag", probabilityCol="_probability",
        rawPredictionCol="_raw", family="multinomial", maxIter=iterations, regParam=1e-4,
    )
    names = IndexToString(inputCol="_tag", outputCol="predicted", labels=list(labels))
    return Pipeline(stages=[ids, tagger, names]).fit(tokens)


def tag_fields(model, tokens: DataFrame) -> DataFrame:
    """Predicted field label of each token."""
    drop = [c for c in ("features", "_label", "_raw", "_probability", "_tag")]
    return model.transform(tokens).drop(*drop)
