"""Process only files that no earlier run has processed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# A first run over a large backlog commits in steps of this many files.
FILES_PER_BATCH = 10000


def incremental_files(
    spark: SparkSession,
    src: str,
    out: str,
    checkpoint: str,
    schema,
    fn: Callable[[DataFrame], DataFrame] = lambda df: df,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Apply ``fn`` to all files not yet seen, add the result to ``out``, return ``out``.

    ``src`` is a folder, or a glob for single files.
    The checkpoint remembers processed files; the file sink commits each batch once, so
    a run that is lost half-way can be started again. ``checkpoint`` and ``out`` belong
    in the folder all executors share.
    """
    settings = {"maxFilesPerTrigger": str(FILES_PER_BATCH), **(options or {})}
    new = spark.readStream.format(fmt).schema(schema).options(**settings).load(src)
    done = fn(new)
    query = (
        done.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    return spark.read.schema(done.schema).parquet(out)
