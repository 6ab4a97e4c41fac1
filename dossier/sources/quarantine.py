"""Readers that keep broken input apart instead of dropping it or turning it into empty records.

Each returns a pair (good, bad). ``bad`` has one row per broken record: ``file``, ``line`` (1 for the first of a
file), ``reason`` and ``record``, the text as it was read. Together they hold every record of the input. Both
parts are plans over the same scan; write a part that is used more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dossier.sources.tables import _csv


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: ``file``, ``line`` (from 1 in each file), ``value``. Files are split between tasks."""
    rows = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("_row"))
    split = ["file_path", "file_block_start"]
    counts = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    # One narrow row per split; a file's splits meet, all files' splits do not.
    other = counts.select("file_path", F.col("file_block_start").alias("_other"), F.col("_n").alias("_on"))
    starts = counts.join(other, "file_path").groupBy(*split, "_first").agg(
        F.sum(F.when(F.col("_other") < F.col("file_block_start"), F.col("_on")).otherwise(0)).alias("_before"))
    return rows.join(starts, split).select(
        F.col("file_path").alias("file"), (F.col("_before") + F.col("_row") - F.col("_first") + 1).alias("line"), "value")


def _missing(fields: list[str], at: str = "") -> Column:
    """Name of the first of the fields that is null."""
    return F.coalesce(F.lit(None).cast("string"), *[F.when(F.col(f"{at}{f}").isNull(), F.concat(F.lit("no "), F.lit(f))) for f in fields])


def read_json_lines(spark: SparkSession, path: str, schema: str, required: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """One JSON object per line. ``good`` has the fields of ``schema``, ``file`` and ``line``.

    A line is bad if it is empty, no JSON, no object, has a value of another type than its field, or
    lacks one of the fields ``required`` (null counts as lacking).
    """
    fields = StructType.fromDDL(schema)
    whole = StructType([*fields.fields]).add("_corrupt", "string")
    lines = numbered_lines(spark, path)
    value = F.trim("value")
    parsed = lines.withColumn("r", F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    kind = F.schema_of_variant(F.try_parse_json("value"))
    reason = (
        F.when(value == "", "empty line").when(kind.isNull(), "malformed JSON").when(~kind.startswith("OBJECT"), "no object")
        .when(~value.endswith("}"), "malformed JSON")  # the parser stops after the first value
        .when(F.col("r._corrupt").isNotNull() | F.col("r").isNull(), "wrong type").otherwise(_missing(list(required), "r.")))
    judged = parsed.withColumn("reason", reason)
    good = judged.filter(F.col("reason").isNull()).select(*[f"r.{f.name}" for f in fields], "file", "line")
    bad = judged.filter(F.col("reason").isNotNull()).select("file", "line", "reason", F.col("value").alias("record"))
    return good, bad


def read_csv_rows(spark: SparkSession, path: str, schema: str, required: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of CSV files with header and quoted line breaks. ``good`` has the columns of ``schema``, which may be
    any of the file's, in any order.

    A row is bad if it has too few or too many cells, a cell that is no value of its column's type, or none
    where one is ``required``. As quoted cells may hold line breaks, ``line`` is null and ``record`` has the whole row.
    """
    fields = StructType.fromDDL(schema)
    header = _csv(spark, path).schema
    types = {f.name: f.dataType for f in fields}
    missing = [f for f in types if f not in header.names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    texts = StructType.fromDDL(", ".join(f"`{n}` string" for n in header.names)).add("_corrupt", "string")
    rows = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("columnNameOfCorruptRecord", "_corrupt")
            .schema(texts).csv(path).select("*", "_metadata.file_path"))
    typed = [F.col(f"`{n}`").try_cast(t).alias(n) for n, t in types.items()]
    wrong = F.lit(False)
    for n, t in types.items():
        wrong = wrong | (F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(t).isNull())
    reason = F.when(F.col("_corrupt").isNotNull(), "wrong number of cells").when(wrong, "wrong type").otherwise(_missing([f"`{r}`" for r in required]))
    judged = rows.withColumn("reason", F.regexp_replace(reason, "`", ""))
    cells = F.to_json(F.struct(*[F.col(f"`{n}`") for n in header.names]))
    good = judged.filter(F.col("reason").isNull()).select(*typed, F.col("file_path").alias("file"))
    bad = judged.filter(F.col("reason").isNotNull()).select(
        F.col("file_path").alias("file"), F.lit(None).cast("bigint").alias("line"), "reason", F.coalesce("_corrupt", cells).alias("record"))
    return good, bad


def read_json_arrays(spark: SparkSession, path: str, schema: str, required: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Files that are one JSON array each. ``good`` has the fields of ``schema``, ``file`` and ``line``, the record's place from 1.

    A file that is no JSON is one bad record with ``line`` null. A record is bad if it is no object, has a value of
    another type than its field, or lacks a required one. A file is one task's work.
    """
    fields = StructType.fromDDL(schema)
    whole = StructType([*fields.fields]).add("_corrupt", "string")
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    items = F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")
    broken = items.isNull()
    records = files.filter(~broken).select("file", F.posexplode(items).alias("at", "v"))
    records = records.select("file", (F.col("at") + 1).cast("bigint").alias("line"), F.to_json("v").alias("value"))
    parsed = records.withColumn("r", F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    reason = (F.when(~F.coalesce(F.col("value").startswith("{"), F.lit(False)), "no object")
              .when(F.col("r._corrupt").isNotNull() | F.col("r").isNull(), "wrong type").otherwise(_missing(list(required), "r.")))
    judged = parsed.withColumn("reason", reason)
    good = judged.filter(F.col("reason").isNull()).select(*[f"r.{f.name}" for f in fields], "file", "line")
    bad = judged.filter(F.col("reason").isNotNull()).select("file", "line", "reason", F.col("value").alias("record"))
    lost = files.filter(broken).select("file", F.lit(None).cast("bigint").alias("line"), F.lit("malformed JSON").alias("reason"), F.col("value").alias("record"))
    return good, bad.unionByName(lost)

