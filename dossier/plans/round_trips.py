"""Queries that write given tables to files and read them back with the package's readers.

Files go to fresh folders below the shared work folder. Every row is written and read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.functions import layout, privacy
from dossier.operators import grouping, inference, ocr, sampling
from dossier.plans import queries as base
from dossier.plans.queries import _listed, table
from dossier.session import work_dir
from dossier.sources import files, sinks, tables
from dossier.streaming.incremental import incremental_files

TOKENS_PER_FILE = 2500


def instruction_files(spark, sf_dir):
    """Documents as instruction records in doc_id order; French ones lack the input."""
    path = work_dir(spark, "instructions")
    docs = table(spark, sf_dir, "documents").orderBy("doc_id")
    docs.select(
        F.col("text").alias("instruction"), F.when(F.col("lang") != "fr", F.col("lang")).alias("input"),
        F.col("source").alias("output"),
    ).write.json(path)
    return tables.read_instructions(spark, path)


def _truth_path(spark, sf_dir) -> str:
    """Truth rows with padded, repeated ids; of an id the largest document comes last."""
    path = work_dir(spark, "truth")
    docs = table(spark, sf_dir, "documents").orderBy("doc_id")
    docs.select(
        F.lpad((F.col("doc_id") % 600).cast("string"), 6, "0").alias("ID"),
        F.when(F.col("doc_id") % 50 != 0, F.col("text")).alias("Resume_str"),
    ).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return path


def truth_files(spark, sf_dir):
    return tables.read_truth(spark, _truth_path(spark, sf_dir))


def files_with_truth(spark, sf_dir):
    truth = tables.read_truth(spark, _truth_path(spark, sf_dir))
    return ocr.keep_with_id(base._ocr_files(spark, sf_dir), truth)


def _event_tokens(spark, sf_dir):
    tokens = base._tokens(spark, sf_dir)
    return tokens.select("page_key", "pos", F.col("event_type").alias("text"), F.array(F.array("value", "k"), F.array("k", "value")).alias("bbox"),
                         F.col("gold").alias("label"))


def _json_arrays(df, group, order, item, path) -> None:
    """One file with a JSON array per group; a group is one block of bounded size."""
    arrays = df.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, item.alias("item")))).alias("items"))
    arrays.select(group, F.to_json(F.transform("items", lambda x: x["item"])).alias("value")).write.partitionBy(group).text(path)


def labeled_flat(spark, sf_dir):
    """Tokens as flat JSON arrays in several files, read in file order and grouped into sequences."""
    path = work_dir(spark, "flat")
    block = F.lpad(F.floor(F.col("pos") / TOKENS_PER_FILE).cast("string"), 9, "0")
    item = F.struct(F.col("page_key").alias("file_name"), "text", "bbox", "label")
    _json_arrays(_event_tokens(spark, sf_dir).withColumn("block", block), "block", "pos", item, path)
    read = tables.read_labeled_flat(spark, f"{path}/*")
    chunks = grouping.group_tokens(read, "file_name", "pos", ["pos", "text", "label"], 32)
    return chunks.select("file_name", "chunk", "n_tokens", _listed(F.col("pos")).alias("positions"),
                         _listed(F.col("text")).alias("tokens"), _listed(F.col("label")).alias("labels"))


def labeled_nested(spark, sf_dir):
    """Tokens as nested records in JSON lines; a page is one record for each block of its positions."""
    path = work_dir(spark, "nested")
    tokens = _event_tokens(spark, sf_dir).withColumn("bbox", F.col("bbox")[0])
    columns = ["text", "bbox", "label"]
    blocks = grouping.group_tokens(tokens, "page_key", "pos", columns, TOKENS_PER_FILE)
    blocks.select(F.col("page_key").alias("image"), (F.col("chunk") * TOKENS_PER_FILE).alias("start"),
                  F.arrays_zip(*columns).alias("ocr_labeled")).write.json(path)
    return tables.read_labeled_nested(spark, path, lines=True).select("image", "pos", "text", _listed(F.col("bbox")).alias("bbox"), "label")


def sequence_files(spark, sf_dir):
    path = work_dir(spark, "sequences")
    sinks.write_sequences(base.sequence_pack(spark, sf_dir), path)
    return tables.read_sequences(spark, path)


def prediction_files(spark, sf_dir):
    path = work_dir(spark, "predictions")
    docs = table(spark, sf_dir, "documents")
    sinks.write_predictions(docs.select(
        F.concat(F.lit(" "), F.col("text"), F.lit('," \n')).alias("text_a"), F.col("source").alias("text_b"),
        (F.col("doc_id") % 7 / 4).alias("label"), (F.col("n_chars") / 1024).alias("predicted_score")), path)
    return tables.read_pairs(spark, path)


def result_files(spark, sf_dir):
    path = work_dir(spark, "results")
    failed = f"{path}-failed"
    wrote = sinks.write_results(base.score_records(spark, sf_dir), path, failed)
    schema = "id bigint, pred_score double, true_score double, reason_only string, error string"
    rows = spark.read.schema(schema).json(path).withColumn("part", F.lit("all"))
    if wrote:
        rows = rows.unionByName(spark.read.schema(schema).json(failed).withColumn("part", F.lit("failed")))
    return rows


def report_files(spark, sf_dir):
    path = work_dir(spark, "report")
    sinks.write_report(base.clean_generated(spark, sf_dir), path)
    return tables.parse_report(spark, path)


def metric_appends(spark, sf_dir):
    path = work_dir(spark, "metrics")
    rows = base.metric_log(spark, sf_dir)
    sinks.append_metrics(rows.filter(F.col("train_loss").isNotNull()).select("epoch", "step", "train_loss"), path)
    sinks.append_metrics(rows.filter(F.col("train_loss").isNull()).drop("train_loss"), path)
    return spark.read.schema(rows.schema).parquet(path)


def epoch_log_file(spark, sf_dir):
    path = work_dir(spark, "epochs")
    base.epoch_mean_loss(spark, sf_dir).orderBy("epoch").write.option("header", True).option("sep", "\t").csv(path)
    return tables.read_metric_log(spark, path, sep="\t")


def _listing(df, path, extension):
    df.write.option("extension", extension).csv(path)


def scanned_files(spark, sf_dir):
    """Ids as files with image endings in two roots, and as PDF files; all bytes are read back."""
    root = work_dir(spark, "scans")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"))
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("id"))
    _listing(docs, f"{root}/docs", "png")
    _listing(docs, f"{root}/docs/deeper", "JPG")
    _listing(docs, f"{root}/docs/other", "txt")
    _listing(items, f"{root}/items", "png")
    _listing(items, f"{root}/pdf", "pdf")
    images = files.scan_files(spark, {"docs": f"{root}/docs", "items": f"{root}/items"}, content=True)
    pdfs = files.scan_pdfs(spark, f"{root}/pdf", content=True).filter(F.col("file").endswith(".pdf")).withColumn("source", F.lit("pdf"))
    both = images.unionByName(pdfs.select(*images.columns))
    lines = F.size(F.split(F.col("content").cast("string"), "\n")) - 1
    return both.groupBy("source").agg(F.sum(lines).cast("bigint").alias("n_lines"), F.sum("length").alias("n_bytes"))


def incremental_twice(spark, sf_dir):
    """Files that come in three runs, the last of them without a new one: every row once."""
    root = work_dir(spark, "arrivals")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = None
    for odd in (0, 1, None):
        if odd is not None:
            docs.filter(F.col("doc_id") % 2 == odd).write.mode("append").parquet(f"{root}/in")
        out = incremental_files(
            spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", docs.schema,
            lambda df: df.select("doc_id", "source", F.length("text").cast("bigint").alias("n_chars")))
    return out


def split_overlap(spark, sf_dir):
    """Rows of the second sample that were trained on."""
    ids = table(spark, sf_dir, "documents").select("doc_id")
    train, _ = sampling.split_exact(ids, "doc_id")
    return sampling.overlap(train, sampling.holdout_sample(ids, "doc_id"), "doc_id")


def polygon_envelope(spark, sf_dir):
    x, y = F.col("l_quantity"), F.col("l_extendedprice") / 100
    points = F.array(F.array(x + 3, y), F.array(x, y + F.col("l_linenumber")), F.array(x + F.col("l_tax"), y - 1), F.array(x + 1, y))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", _listed(F.transform(layout.envelope(layout.flatten_polygon(points)), lambda v: F.round(v, 4))).alias("box"))


def exact_numbers(spark, sf_dir):
    """Keys and values beyond 2**53, some null, some of them failed."""
    big = 9007199254740993
    docs = table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 5 != 0, F.col("doc_id") * 2 + big).alias("key"), "doc_id", "text")

    def answer(model, record):
        if record["key"] is None:
            return None
        if record["key"] % 7 == 0:
            raise ValueError("seven")
        return record["key"] + len(record["text"])

    return inference.batch_infer(docs, ["key", "text"], lambda: None, answer, "bigint", keep=["doc_id", "key"])


def scrub_long_numbers(spark, sf_dir):
    """Documents with an unbroken run of 12 to 40 digits."""
    digits = F.repeat((F.col("doc_id") + 1234567).cast("string"), F.lit(8))
    run = F.substring(digits, F.lit(1), (12 + F.col("doc_id") % 29).cast("int"))
    docs = table(spark, sf_dir, "documents").withColumn("text", F.concat("text", F.lit(" no "), run, F.lit(".")))
    return docs.select("doc_id", privacy.scrub_pii(F.col("text"), F.col("doc_id")).alias("text"))


QUERIES = {
    "q37_instruction_files": instruction_files,
    "q38_truth_files": truth_files,
    "q38b_files_with_truth": files_with_truth,
    "q39_labeled_flat": labeled_flat,
    "q39b_labeled_nested": labeled_nested,
    "q40_sequence_files": sequence_files,
    "q41_prediction_files": prediction_files,
    "q42_result_files": result_files,
    "q43_report_files": report_files,
    "q44_metric_appends": metric_appends,
    "q45_epoch_log_file": epoch_log_file,
    "q46_scanned_files": scanned_files,
    "q47_incremental_twice": incremental_twice,
    "q48_split_overlap": split_overlap,
    "q49_polygon_envelope": polygon_envelope,
    "q50_exact_numbers": exact_numbers,
    "q51_scrub_long_numbers": scrub_long_numbers,
}
