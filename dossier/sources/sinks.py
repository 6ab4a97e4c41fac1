"""Writers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dossier.functions.text import report_block
from dossier.operators.collections import report_order
from dossier.operators.evaluation import failed_pairs
from dossier.operators.logs import metric_layout
from dossier.session import written

RECORD_SEPARATOR = "\n\n"


def write_sequences(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Encoded sequences as parquet. Having none is an error, which leaves ``path`` as it was.

    The plan runs once, into the shared work folder. That copy is checked and then
    written to ``path`` as the last step.
    """
    fresh = written(df, "sequences")
    if fresh.isEmpty():
        raise ValueError("no page was encoded")
    fresh.write.mode(mode).parquet(path)


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pairs with label and predicted score as CSV with header. White space at the ends of texts stays."""
    columns = ["text_a", "text_b", "label", "predicted_score"]
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.select(*columns).write.mode(mode).options(**whole).option("header", True).option("escape", '"').csv(path)


def write_results(
    df: DataFrame, path: str, failed_path: str, pred: str = "pred_score", true: str = "true_score"
) -> bool:
    """All results as JSON lines, and the failed ones apart if there are any.

    Failed rows are counted while the results are written, so the scoring model runs once and the
    written results are read again only if some failed. Returns whether failed rows were written.
    """
    seen = Observation()
    watched = df.observe(seen, F.count_if(F.col(pred).isNull() | F.col(true).isNull()).alias("failed"))
    watched.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    if not seen.get["failed"]:
        return False
    failed = failed_pairs(df.sparkSession.read.schema(df.schema).json(path), pred, true)
    failed.write.mode("overwrite").option("ignoreNullFields", False).json(failed_path)
    return True


def write_report(df: DataFrame, path: str, id_: str = "id", score: str = "score", text: str = "generated_output") -> None:
    """Text blocks in id order, a blank line after each. Part files are in order too."""
    blocks = report_order(df, id_).select(report_block(F.col(id_), F.col(score), F.col(text)).alias("value"))
    blocks.write.mode("overwrite").option("lineSep", RECORD_SEPARATOR).text(path)


def append_metrics(df: DataFrame, path: str, run: str | None = None) -> None:
    """Add rows to a sparse metric log; columns they lack stay null.

    With the name of a ``run`` the rows are that run's part of the log and take the place of what an
    earlier try of it has written, so a repeated append changes nothing. Other runs stay as they are. A log
    is either with runs throughout or without.
    """
    rows = metric_layout(df)
    if run is None:
        rows.write.mode("append").parquet(path)
    else:
        keyed = rows.withColumn("run", F.lit(run))
        keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def write_run_manifest(spark: SparkSession, params: dict, path: str) -> None:
    """One JSON record of paths and settings with the time of writing."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("created_at")
    row = spark.range(1).select(
        *[F.lit(v if isinstance(v, (str, int, float, bool)) else json.dumps(v)).alias(k) for k, v in params.items()],
        stamp,
    )
    row.write.mode("overwrite").json(path)
