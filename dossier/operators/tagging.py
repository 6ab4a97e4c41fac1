"""Label runs in token sequences and their precision, recall and F1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.operators.skew import BLOCK, in_blocks, known

# How a label without prefix is read by its first letter when scoring
# entities. O is outside; B, S and E open a new entity at every token.
OUTSIDE = "O"
SINGLE = ("B", "S", "E")


def _starts(label: Column, before: Column, mode: str) -> Column:
    changed = before.isNull() | (before != label)
    if mode == "runs":
        return changed
    if mode == "compat":
        return changed | F.substring(label, 1, 1).isin(*SINGLE)
    raise ValueError(f"mode must be compat or runs, not {mode}")


def _placed(df: DataFrame, seq: list[str], pos: str, label: str, mode: str, block: int) -> DataFrame:
    """Every token of an entity with the entity's ``type`` and ``start``.

    A token belongs to the last opening at or before it. Openings are found per block of
    positions, which is the only shuffle of the tokens; one edge row per block tells
    whether its first token continues an entity and which opening is in force there.
    """
    inside = Window.partitionBy(*seq, "_block").orderBy(pos)
    tokens = (
        in_blocks(known(df.select(*seq, pos, label), [label]), seq, pos, block)
        .withColumn("_before", F.lag(F.struct(label)).over(inside))
    )
    opens = F.col("_before").isNotNull() & _starts(F.col(label), F.col(f"_before.{label}"), mode)
    tokens = tokens.withColumn("_opened", F.max(F.when(opens, F.col(pos))).over(
        inside.rowsBetween(Window.unboundedPreceding, 0)
    ))

    edges = tokens.groupBy(*seq, "_block").agg(
        F.min(pos).alias("_at"), F.min_by(label, pos).alias("_first"), F.max_by(label, pos).alias("_last"),
        F.max("_opened").alias("_opened"),
    )
    across = Window.partitionBy(*seq).orderBy("_block")
    first = _starts(F.col("_first"), F.lag("_last").over(across), mode)
    edges = edges.withColumn("_entry", F.when(first, F.col("_at")))
    carried = F.max(F.coalesce("_opened", "_entry")).over(across.rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.select(*seq, "_block", F.coalesce("_entry", carried).alias("_entry"))

    placed = tokens.join(edges, [*seq, "_block"])
    if mode == "compat":
        placed = placed.filter(~F.startswith(F.col(label), F.lit(OUTSIDE)))
    return placed.select(*seq, F.col(label).alias("type"), F.coalesce("_opened", "_entry").alias("start"), pos)


def label_chunks(
    df: DataFrame, seq: str, pos: str, label: str, mode: str = "compat", block: int = BLOCK
) -> DataFrame:
    """Entities of each sequence: ``seq``, ``type``, ``start``, ``end`` (values of ``pos``).

    ``compat`` reads labels by their first letter (see above), ``runs`` takes every
    maximal run of equal labels.
    """
    tokens = _placed(df, [seq], pos, label, mode, block)
    return tokens.groupBy(seq, "type", "start").agg(F.max(pos).alias("end"))


def match_chunks(gold: DataFrame, pred: DataFrame, seq: str) -> DataFrame:
    """Entities found in both, by sequence, type, start and end."""
    return gold.join(pred, [seq, "type", "start", "end"])


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def entity_prf(
    df: DataFrame, seq: str, pos: str, gold: str, pred: str, mode: str = "compat", block: int = BLOCK
) -> DataFrame:
    """Micro precision, recall and F1 over entities, with their counts. Zero if undefined.

    Both label columns are stacked and placed in one go. Gold and predicted entities with
    the same type and start share a row of one aggregation and match if they end alike.
    """
    sides = F.explode(F.array(
        F.struct(F.lit(True).alias("_gold"), F.col(gold).alias("_label")),
        F.struct(F.lit(False).alias("_gold"), F.col(pred).alias("_label")),
    ))
    stacked = df.select(seq, pos, sides.alias("_side")).select(seq, pos, "_side.*")
    ends = _placed(stacked, [seq, "_gold"], pos, "_label", mode, block).groupBy(seq, "type", "start").agg(
        F.max(F.when(F.col("_gold"), F.col(pos))).alias("_gold_end"),
        F.max(F.when(~F.col("_gold"), F.col(pos))).alias("_pred_end"),
    )
    counts = ends.agg(
        F.count("_gold_end").alias("n_gold"), F.count("_pred_end").alias("n_pred"),
        F.count_if(F.col("_gold_end") == F.col("_pred_end")).alias("n_match"),
    )
    precision = _share(F.col("n_match"), F.col("n_pred"))
    recall = _share(F.col("n_match"), F.col("n_gold"))
    return counts.select(
        "*", precision.alias("precision"), recall.alias("recall"),
        _share(2 * precision * recall, precision + recall).alias("f1"),
    )


def token_accuracy(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Share of tokens with the right label, with counts."""
    right = F.col(gold) == F.col(pred)
    return df.agg(
        F.count(F.lit(1)).alias("n_tokens"), F.count_if(right).alias("n_right"),
        F.avg(right.cast("int")).alias("accuracy"),
    )


def evaluate_tags(
    df: DataFrame, seq: str, pos: str, gold: str, pred: str, mode: str = "compat", block: int = BLOCK
) -> DataFrame:
    """One row: entity precision, recall, F1 and token accuracy."""
    entities = entity_prf(df, seq, pos, gold, pred, mode, block)
    both = entities.unionByName(token_accuracy(df, gold, pred), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
