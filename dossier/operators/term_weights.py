"""Document frequencies of terms, and cosine of texts weighted by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from dossier.operators.skew import attach, known
from dossier.session import written

#: A term with more than one of so many of all occurrences is frequent, so there are fewer frequent terms than this.
FREQUENT = 262_144


def terms_of(text: Column) -> Column:
    """Distinct lower-case words; null has none."""
    return F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), ""))


def _terms(df: DataFrame, text: str) -> Column:
    """The terms of a text, or a column that holds them already."""
    return F.col(text) if isinstance(df.schema[text].dataType, ArrayType) else terms_of(F.col(text))


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """``term``, ``df`` and ``idf``: ln((N + 1) / (df + 1)) + 1 over all N documents, those without text included.

    ``text`` names a text, or an array made by ``terms_of``. Terms are counted map-side first, so a term of every
    document leaves each task as one row.
    """
    counted = docs.select(F.explode(_terms(docs, text)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = docs.agg(F.count(F.lit(1)).alias("_n")).scalar()
    return counted.withColumn("idf", F.ln((total + 1) / (F.col("df") + 1)) + 1)


def with_idf(rows: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Add ``idf`` to rows with a ``term``; rows whose term has no frequency drop out.

    Frequent terms, fewer than ``FREQUENT``, are broadcast and their rows stay where they are. Each other
    term has less than one ``FREQUENT``th of the rows of the counted documents, so no partition of the join is hot.
    ``frequencies`` is read several times; write it first.
    """
    total = frequencies.agg(F.sum("df")).scalar()
    share = F.col("df") * FREQUENT > total
    frequent = F.broadcast(frequencies.filter(share).select("term", F.col("idf").alias("_idf")))
    rare = frequencies.filter(~share).select("term", "idf")
    marked = rows.join(frequent, "term", "left")
    hot = marked.filter(F.col("_idf").isNotNull()).withColumnRenamed("_idf", "idf")
    cold = marked.filter(F.col("_idf").isNull()).drop("_idf").join(rare, "term")
    return hot.unionByName(cold.select(*hot.columns))


def idf_cosine(
    pairs: DataFrame, targets: DataFrame, frequencies: DataFrame, id_: str, on: str, text: str = "text", out: str = "idf_cosine"
) -> DataFrame:
    """Cosine of each text with its target's text: ``id_``, ``on`` and ``out``, one row per pair.

    ``pairs`` has one text per ``id_`` and names its target in ``on``; ``targets`` has one text per ``on``. Each
    text, or an array made by ``terms_of``, is read several times; write arrays first.
    Texts are sets of terms with the inverse document frequency as weight. A text meets its target as a whole
    (those of a target that a third of the texts name stay where they are) and only the terms they share are
    written. The rows of one text are summed before they are shuffled. Pairs without a common term, without text
    or without target have 0.
    """
    weight = F.col("idf") * F.col("idf")
    theirs = known(targets, [on]).select(on, _terms(targets, text).alias("_theirs"))
    norms = with_idf(theirs.select(on, F.explode("_theirs").alias("term")), frequencies).groupBy(on).agg(F.sum(weight).alias("_b"))
    terms = pairs.select(id_, on, _terms(pairs, text).alias("_terms"))
    met = attach(terms, theirs, [on]).select(id_, F.array_intersect("_terms", "_theirs").alias("_common"))
    common = written(met.select(id_, F.explode("_common").alias("term"), F.lit(True).alias("_both")), "common-terms")
    rows = terms.select(id_, F.explode("_terms").alias("term"), F.lit(False).alias("_both")).unionByName(common)
    sums = with_idf(rows, frequencies).groupBy(id_).agg(
        F.sum(F.when(~F.col("_both"), weight)).alias("_a"), F.sum(F.when(F.col("_both"), weight)).alias("_ab"))
    joined = attach(pairs.select(id_, on), written(norms, "target-norms"), [on], "left").join(sums, id_, "left")
    cosine = F.try_divide(F.col("_ab"), F.sqrt("_a") * F.sqrt("_b"))
    return joined.select(id_, on, F.coalesce(cosine, F.lit(0.0)).alias(out))
