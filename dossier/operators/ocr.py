"""Recognised text against its truth: assembly, joins, error rates, summary."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.text import first_int, pct, py_strip, py_words
from dossier.operators.skew import attach, known

# Texts up to this length are compared by the built-in function, longer ones bit-parallel.
SHORT_TEXT = 128


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance in characters, exact for whole texts of any length.

    The built-in takes one step per pair of characters: a billion for two texts of
    33,000. Longer texts keep a whole column of the table in one number and take one
    step per character (Myers 1999, in the form of Hyyrö 2003).
    """

    @F.pandas_udf("long")
    def long_distance(left: pd.Series, right: pd.Series) -> pd.Series:
        def distance(x, y):
            if x is None or y is None:
                return None
            if x == y:
                return 0
            if len(x) < len(y):
                x, y = y, x
            if not y:
                return len(x)
            masks = {ch: bytearray(len(y) // 8 + 1) for ch in set(y)}
            for i, ch in enumerate(y):
                masks[ch][i >> 3] |= 1 << (i & 7)
            places = {ch: int.from_bytes(mask, "little") for ch, mask in masks.items()}
            ones, last = (1 << len(y)) - 1, 1 << (len(y) - 1)
            up, down, total = ones, 0, len(y)
            for ch in x:
                hit = places.get(ch, 0)
                diagonal = (((hit & up) + up) ^ up) | hit | down
                rise = down | (ones & ~(diagonal | up))
                fall = up & diagonal
                if rise & last:
                    total += 1
                elif fall & last:
                    total -= 1
                rise = (rise << 1) | 1
                up = ((fall << 1) | ~(diagonal | rise)) & ones
                down = rise & diagonal & ones
            return total

        return pd.Series([distance(x, y) for x, y in zip(left, right)], dtype="Int64")

    short = F.greatest(F.length(a), F.length(b)) <= SHORT_TEXT
    longer = long_distance(F.when(~short, a), F.when(~short, b))
    return F.when(short, F.levenshtein(a, b).cast("long")).otherwise(longer)


def cer(hyp: Column, ref: Column) -> Column:
    """Character error rate: the hypothesis is stripped, the reference is not."""
    return edit_distance(py_strip(hyp), ref) / F.greatest(F.lit(1), F.length(ref))


def wer_compat(hyp: Column, ref: Column) -> Column:
    """Character distance of the word-joined texts per reference word. May exceed 1."""
    words = py_words(ref)
    joined = F.array_join(words, " ")
    return edit_distance(F.array_join(py_words(hyp), " "), joined) / F.greatest(F.lit(1), F.size(words))


def keep_with_id(files: DataFrame, truth: DataFrame, name: str = "file", id_: str = "id") -> DataFrame:
    """Files whose name holds a digit run that is a truth id."""
    keyed = files.withColumn(id_, first_int(F.col(name))).filter(F.col(id_) != "")
    return attach(keyed, truth.select(id_).distinct(), [id_])


def join_truth(files: DataFrame, truth: DataFrame, name: str = "file", id_: str = "id") -> DataFrame:
    """Truth text for each file, by the first digit run of its name as text.

    Do this before recognition: a file without truth then never reaches the model.
    """
    keyed = files.withColumn(id_, first_int(F.col(name))).filter(F.col(id_) != "")
    return attach(keyed, truth, [id_])


def assemble_text(files: DataFrame, lines: DataFrame, file: str = "file") -> DataFrame:
    """Text of each file: stripped lines joined by spaces in page and line order.

    Returns ``file``, ``ocr_text``, ``avg_conf`` and ``n_lines``. Files without lines
    get an empty text and confidence 0. Pages are put together first, so a long
    document is spread over its pages and only page texts meet in one place. Lines without
    file or page belong to no text and drop out first, so no garbage key gathers them.
    """
    placed = known(lines, [file, "page"]).filter(F.col(file) != "")
    pages = placed.groupBy(file, "page").agg(
        F.array_sort(F.collect_list(F.struct("line", py_strip(F.col("text")).alias("t")))).alias("_lines"),
        F.sum("conf").alias("_conf"), F.count("conf").alias("_n"),
    ).select(file, "page", "_conf", "_n", F.array_join("_lines.t", " ").alias("_page_text"))
    texts = pages.groupBy(file).agg(
        F.array_sort(F.collect_list(F.struct("page", "_page_text"))).alias("_pages"),
        F.sum("_conf").alias("_conf"), F.sum("_n").alias("_n"),
    )
    return files.join(texts, file, "left").select(
        *files.columns,
        F.coalesce(py_strip(F.array_join("_pages._page_text", " ")), F.lit("")).alias("ocr_text"),
        F.coalesce(F.try_divide(F.col("_conf"), F.col("_n")), F.lit(0.0)).alias("avg_conf"),
        F.coalesce("_n", F.lit(0)).alias("n_lines"),
    )


def document_errors(df: DataFrame, hyp: str = "ocr_text", ref: str = "text") -> DataFrame:
    """Distances, sizes and error rates of each document.

    Adds ``n_chars``, ``n_words``, ``char_errors``, ``word_errors``, ``cer``, ``wer``. Rows are dealt out anew
    first: few bytes of text make much work here, and partitions sized by bytes would leave it to one task.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = df.repartition(parts).withColumn("_words", py_words(F.col(ref)))
    counted = (
        words.withColumn("n_chars", F.length(ref).cast("long"))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("char_errors", edit_distance(py_strip(F.col(hyp)), F.col(ref)))
        .withColumn(
            "word_errors",
            edit_distance(F.array_join(py_words(F.col(hyp)), " "), F.array_join("_words", " ")),
        )
    )
    return (
        counted.withColumn("cer", F.col("char_errors") / F.greatest(F.lit(1), F.col("n_chars")))
        .withColumn("wer", F.col("word_errors") / F.greatest(F.lit(1), F.col("n_words")))
        .drop("_words")
    )


def ocr_corpus_summary(doc_errors: DataFrame) -> DataFrame:
    """One row: micro error rates and accuracies, macro confidence, number of documents."""
    totals = doc_errors.agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("char_errors", "word_errors", "n_chars", "n_words")],
        F.coalesce(F.sum("avg_conf"), F.lit(0.0)).alias("_conf"),
    )
    one = F.lit(1)
    cer_, wer_ = F.col("char_errors") / F.greatest(one, F.col("n_chars")), F.col("word_errors") / F.greatest(one, F.col("n_words"))
    return totals.select(
        "n_docs", cer_.alias("cer"), wer_.alias("wer"), (1 - cer_).alias("char_accuracy"),
        (1 - wer_).alias("word_accuracy"), (F.col("_conf") / F.greatest(one, F.col("n_docs"))).alias("confidence"),
    )


def format_summary(summary: DataFrame) -> DataFrame:
    """The summary's shares as percentages, for a printed report."""
    shares = [c for c in summary.columns if c != "n_docs"]
    return summary.select("n_docs", *[pct(F.col(c)).alias(c) for c in shares])
