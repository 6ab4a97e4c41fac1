"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; all but the
last return the columns of ``documents``. Stages are written and read again in between.

Null and empty texts pass all stages: the quality model gives them its prior, they have no
shingles, match nothing, hold no secret, and have the begin and end ids only. An empty
table gives an empty table. Further columns are carried through; those named like a
result of the last stage are replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm import decontamination, jaccard_join, piece_codec, quality_model, secret_scan
from dossier.llm.common import fresh, perhaps_in, table, work_dir, written
from dossier.session import remove_work, work_mark

QUALITY_LEAST = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects."""
    labels = table(spark, sf_dir, "labels").filter(~quality_model.held_out())
    score = fresh(docs, "score")
    scored = quality_model.score(docs, quality_model.fit(docs, labels), out=score)
    return scored.filter(F.col(score) >= QUALITY_LEAST).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group: five-word shingles, similarity 0.8 or more.

    Rows that share an id and the text are one document, of which one stays. Rows that share an id but not
    the text are not judged by similarity: they all stay. Rows without id are in no group and stay. The ids that are
    judged are written and the join's own tables removed before texts are read again. Most documents have an id that
    surely stays; only the texts of the others are shuffled.
    """
    before = work_mark(spark)
    groups = jaccard_join.similar(docs, width=5, least=80, of=100)
    kept = groups.filter("doc_id = component_id").select("doc_id").distinct()
    mark = F.xxhash64("text")
    counts = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), (F.min(mark) != F.max(mark)).alias("differ"))
    judged = counts.join(kept.withColumn("first", F.lit(True)), "doc_id", "left")
    stays = F.coalesce(F.col("first"), F.lit(False)) | F.coalesce((F.col("n") > 1) & F.col("differ"), F.lit(False))
    judged = written(judged.select("doc_id", stays.alias("stays"), (F.col("n") > 1).alias("repeated")).filter("not stays or repeated"), "judged")
    remove_work(spark, before, keep=1)
    named = docs.filter("doc_id is not null")
    may = fresh(docs, "may")
    named = perhaps_in(named, "doc_id", judged, may)
    sure = named.filter(~F.col(may)).select(*docs.columns)
    rest = named.filter(may).select(*docs.columns)
    out = sure.unionByName(rest.join(judged.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)).unionByName(docs.filter("doc_id is null"))
    several = judged.filter("stays and repeated").select("doc_id")
    if several.isEmpty():
        return out
    return out.unionByName(rest.join(several, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; every document stays."""
    spans = fresh(docs, "secrets")
    found = secret_scan.scan(docs, secret_scan.train(docs), out=spans)
    changed = F.size(spans) > 0
    clean = secret_scan.redact(found, secrets=spans)
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding gives the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    keep = [c for c in docs.columns if c not in ("text", "ids", "n_tokens", "decoded", "round_trip")]
    digest = lambda c: F.sha2(F.encode(F.coalesce(c, F.lit("")), "UTF-8"), 256)
    sha = fresh(docs, "sha")
    back = piece_codec.round_trip(docs.select(*keep, "text", digest("text").alias(sha)), model, keep=[*keep, sha])
    return back.select(*keep, piece_codec.id_count("ids").alias("n_tokens"), "ids", (digest("decoded") == F.col(sha)).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("encode", encode),
]

#: No SQL for a trained classifier; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = work_dir(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
