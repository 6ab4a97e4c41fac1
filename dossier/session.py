"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, list[str]] = {}


def build_session(app: str = "dossier", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on.

    On a cluster leave ``master`` to spark-submit and pass sizes (such as
    ``spark.sql.shuffle.partitions``) for that cluster through ``conf``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a session whose
    executors live in this process falls back to a temporary folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="dossier-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def work_mark(spark: SparkSession) -> int:
    """How many intermediate paths this application has named so far."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def remove_work(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the intermediate tables this application has made, once no frame needs them. Returns how many.

    With ``since``, a mark of ``work_mark``, only those named after it; the last ``keep`` stay.
    """
    made = _made.get(spark.sparkContext.applicationId, [])
    end = max(since, len(made) - keep)
    paths = made[since:end]
    del made[since:end]
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and read it back, with its lineage cut.

    Later branches then read the columns they need instead of repeating the work,
    and a lost executor costs only its own tasks.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
