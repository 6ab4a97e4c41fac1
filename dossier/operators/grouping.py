"""Token sequences of pages: ordered chunks, fixed-length encoding, page joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.functions.layout import IGNORED, SEQUENCE_LENGTH, attention_mask, norm_box, pack
from dossier.operators.skew import position_in_group


def group_tokens(
    df: DataFrame, key: str, pos: str, columns: list[str], size: int = SEQUENCE_LENGTH
) -> DataFrame:
    """All tokens of a page in order, as consecutive chunks of ``size`` tokens.

    Returns ``key``, ``chunk`` (0-based), ``n_tokens`` and one array per column. No
    token is lost and no array exceeds ``size``, even if one page holds most rows.
    ``pos`` is a unique integer that gives the input order.
    """
    placed = position_in_group(df.select(key, pos, *columns), [key], pos, "_at")
    chunked = placed.withColumn("chunk", F.floor(F.col("_at") / size))
    tokens = F.array_sort(F.collect_list(F.struct("_at", *columns)))
    grouped = chunked.groupBy(key, "chunk").agg(tokens.alias("_tokens"))
    return grouped.select(
        key, "chunk", F.size("_tokens").cast("long").alias("n_tokens"),
        *[F.col(f"_tokens.{c}").alias(c) for c in columns],
    )


def encode_pages(
    df: DataFrame, key: str, pos: str, pads: dict[str, object], n: int = SEQUENCE_LENGTH
) -> DataFrame:
    """Fixed-length sequences: the first ``n`` tokens of each page, filled up to ``n``.

    ``pads`` maps each column to its fill value. Cutting at ``n`` is part of the
    encoding; Spark applies it before the shuffle (WindowGroupLimit), so a long page
    sends at most ``n`` tokens per task. That holds for ``n`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 unless set). Adds ``attention_mask``.
    """
    columns = list(pads)
    order = Window.partitionBy(key).orderBy(pos)
    head = df.select(key, pos, *columns).withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= n)
    tokens = F.array_sort(F.collect_list(F.struct("_at", *columns)))
    grouped = head.groupBy(key).agg(tokens.alias("_tokens"))
    return grouped.select(
        key,
        *[pack(F.col(f"_tokens.{c}"), n, pad).alias(c) for c, pad in pads.items()],
        attention_mask(F.col("_tokens"), n).alias("attention_mask"),
    )


def join_page_dims(tokens: DataFrame, dims: DataFrame, on: str = "page_key") -> DataFrame:
    """Page width and height for each token; tokens of pages without an image drop out.

    Both sides are plain tables: Spark broadcasts the sizes if they are small, else the
    adaptive join splits the tokens of a hot page.
    """
    return tokens.join(dims, on)


def normalize_boxes(df: DataFrame, box: str, width: str, height: str, out: str = "norm_box") -> DataFrame:
    """Scaled boxes; pages of zero size are skipped, as they cannot be scaled."""
    usable = df.filter((F.col(width) != 0) & (F.col(height) != 0))
    return usable.withColumn(out, norm_box(F.col(box), F.col(width), F.col(height)))


def mask_ignored(df: DataFrame, gold: str, pred: str, ignore: int = IGNORED) -> DataFrame:
    """Drop positions whose gold label is ``ignore``, from gold and prediction.

    Takes one position per row, or arrays of equal length.
    """
    if not df.schema[gold].dataType.simpleString().startswith("array"):
        return df.filter(F.col(gold) != ignore)
    kept = F.filter(F.arrays_zip(gold, pred), lambda x: x[gold] != ignore)
    return (
        df.withColumn("_kept", kept)
        .withColumn(gold, F.col(f"_kept.{gold}"))
        .withColumn(pred, F.col(f"_kept.{pred}"))
        .drop("_kept")
    )
