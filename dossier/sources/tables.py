"""Readers with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.operators.logs import METRIC_COLUMNS
from dossier.operators.skew import running_before

FLAT_TOKENS = "file_name string, text string, bbox array<array<double>>, label string"
NESTED_TOKENS = "image string, start bigint, ocr_labeled array<struct<text: string, bbox: array<double>, label: string>>"
INSTRUCTIONS = "instruction string, input string, output string"
PAIRS = "text_a string, text_b string, label double"
# Cells that the usual CSV reader of Python takes as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Fixed value: how a missing text prints.
MISSING_TEXT = "nan"


def _csv(spark: SparkSession, path: str, **options) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.options(**options).csv(path)


def _placed(df: DataFrame) -> DataFrame:
    """Add ``_at``, a value that orders rows as they lie in the files."""
    return df.select(
        "*",
        F.struct(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("_at"),
    )


def read_truth(
    spark: SparkSession, path: str, id_col: str = "ID", text_col: str = "Resume_str", numeric_ids: bool = True
) -> DataFrame:
    """Truth texts as ``id``, ``text``. Of a repeated id the last row counts.

    Whole-number ids are read as numbers and printed again, so 007 becomes 7; pass
    ``numeric_ids=False`` for id columns that also hold other text. A missing text
    is the word "nan". Repeats are merged map-side.
    """
    rows = _placed(_csv(spark, path))
    id_ = F.col(f"`{id_col}`")
    if numeric_ids:
        id_ = F.coalesce(F.trim(id_).try_cast("bigint").cast("string"), id_)
    text = F.col(f"`{text_col}`")
    text = F.when(text.isNull() | text.isin(*MISSING), F.lit(MISSING_TEXT)).otherwise(text)
    keyed = rows.select(id_.alias("id"), text.alias("text"), "_at")
    return keyed.groupBy("id").agg(F.max_by("text", "_at").alias("text"))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Scored text pairs; the label is a number."""
    return _csv(spark, path).select("text_a", "text_b", F.col("label").cast("double").alias("label"))


def read_labeled_flat(spark: SparkSession, path: str) -> DataFrame:
    """Token rows of JSON arrays, with ``pos`` for their order in the files, by path."""
    rows = spark.read.schema(FLAT_TOKENS).option("multiLine", True).json(path)
    return with_file_index(rows, "pos").select(*rows.columns, "pos")


def read_labeled_nested(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Tokens of a JSON array of pages: ``image``, ``pos`` in the page, ``text``, ``bbox``, ``label``.

    With ``lines`` there is one page to a line, and files are split. A long page may be several
    records, each with the position of its first token in ``start`` (0 if absent).
    """
    pages = spark.read.schema(NESTED_TOKENS).option("multiLine", not lines).json(path)
    tokens = pages.select("image", "start", F.posexplode("ocr_labeled").alias("at", "token"))
    pos = (F.coalesce("start", F.lit(0)) + F.col("at")).cast("int").alias("pos")
    return tokens.select("image", pos, "token.text", "token.bbox", "token.label")


def with_file_index(df: DataFrame, out: str = "id") -> DataFrame:
    """Contiguous 0-based number of each row in file order. ``df`` must scan files.

    Spark's running number of a row rises by one inside a split, so a row's place in its
    split is its number less the smallest one. Only the splits' counts and smallest
    numbers are shuffled; one task orders them, and they are joined back by a broadcast
    of one narrow row per split. Plain scans number rows alike each time they run.
    """
    split = ["_path", "_block"]
    rows = df.select(
        "*", F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"),
    )
    counts = rows.groupBy(*split).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")
    ).withColumn("_split", F.struct(*split))
    starts = running_before(counts, "_split", "_n", "_start").select(*split, "_start", "_first")
    return rows.join(F.broadcast(starts), split).withColumn(
        out, F.col("_start") + F.col("_row") - F.col("_first")).select(out, *df.columns)


def read_instructions(spark: SparkSession, path: str) -> DataFrame:
    """Instruction records with ``id`` in file order; absent fields are empty.

    Lines are read as text and parsed after numbering, so every line counts once. An
    explicit null also becomes empty.
    """
    lines = with_file_index(spark.read.text(path))
    parsed = lines.select("id", F.from_json("value", INSTRUCTIONS).alias("r"))
    fields = ("instruction", "input", "output")
    return parsed.select("id", *[F.coalesce(f"r.{f}", F.lit("")).alias(f) for f in fields])


def read_metric_log(spark: SparkSession, path: str, sep: str = ",", schema: str | None = None) -> DataFrame:
    """A training log with header. Without a schema the types are inferred; logs are small."""
    reader = spark.read.option("header", True).option("sep", sep)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A metric log as written by ``append_metrics``; ``run`` is null in a log without runs."""
    columns = ", ".join(f"`{c}` {t}" for c, t in METRIC_COLUMNS.items())
    return spark.read.schema(f"{columns}, run string").parquet(path)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """Encoded sequences as written by ``write_sequences``."""
    return spark.read.parquet(path)


def parse_report(spark: SparkSession, path: str) -> DataFrame:
    """Report blocks back to ``id``, ``score``, ``generated_output``.

    Blocks end with a line of 80 dashes, which is the record separator here, so large
    reports are split between tasks.
    """
    blocks = spark.read.option("lineSep", "-" * 80).text(path)
    layout = r"(?s)ID: ([0-9]+)\nScore: ([^\n]*)\nGenerated Output:\n(.*)\n\z"
    return (
        blocks.filter(F.regexp_like("value", F.lit(layout)))
        .select(
            F.regexp_extract("value", layout, 1).cast("bigint").alias("id"),
            F.regexp_extract("value", layout, 2).try_cast("double").alias("score"),
            F.regexp_extract("value", layout, 3).alias("generated_output"),
        )
    )
