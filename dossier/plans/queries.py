"""The registered queries: every operator on the given tables, whole tables and whole texts.

The tables stand in for screening data: documents are résumés and their source is the
job they apply for, benchmark texts are job descriptions, conversation turns are
recognised lines, events are page tokens and training steps, embeddings are text
vectors and logits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.functions import layout, metrics, privacy, text
from dossier.operators import (
    collections,
    evaluation,
    grouping,
    inference,
    logs,
    models,
    ocr,
    ranking,
    sampling,
    skew,
    tagging,
)
from dossier.session import work_dir, written
from dossier.streaming.incremental import incremental_files

# Field labels that stand behind the event types, one of each scoring kind.
FIELD_OF_EVENT = {
    "view": "WORK_EXPERIENCE", "signup": "SKILL", "purchase": "PROJECT",
    "error": "EDUCATION", "click": "OTHERS",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r6(column: str) -> Column:
    return F.round(F.col(column), 6).alias(column)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[_r6(c) if c in columns else F.col(c) for c in df.columns])


def _listed(array: Column) -> Column:
    return F.array_join(array.cast("array<string>"), ",")


# --- recognised text -------------------------------------------------------------

def _ocr_lines(spark, sf_dir) -> DataFrame:
    """Conversation turns as recognised lines, two per page, with typical misreadings."""
    turns = table(spark, sf_dir, "conversations")
    misread = F.replace(F.replace(F.col("text"), F.lit("tion"), F.lit("ti0n")), F.lit("é"), F.lit("e"))
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", "conv_id", "turn")), 1, 4), 16, 10).cast("double")
    return turns.select(
        F.concat(F.lit("scan_"), F.col("conv_id").cast("string"), F.lit(".pdf")).alias("file"),
        F.floor(F.col("turn") / 2).alias("page"), (F.col("turn") % 2).alias("line"),
        misread.alias("text"), (0.5 + drawn / 131070).alias("conf"),
    )


def _ocr_files(spark, sf_dir) -> DataFrame:
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("n"))
    return ids.select(F.concat(F.lit("scan_"), "n", F.lit(".pdf")).alias("file"))


def ocr_assemble(spark, sf_dir):
    return _rounded(ocr.assemble_text(_ocr_files(spark, sf_dir), _ocr_lines(spark, sf_dir)), "avg_conf")


def _ocr_truth(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), F.floor(F.col("turn") / 2).alias("page"),
        (F.col("turn") % 2).alias("line"), "text", F.lit(1.0).alias("conf"),
    )
    clean = ocr.assemble_text(turns.select("id").distinct(), turns, "id")
    return clean.select("id", F.col("ocr_text").alias("text"))


def _doc_errors(spark, sf_dir) -> DataFrame:
    truth = _ocr_truth(spark, sf_dir)
    files = ocr.join_truth(_ocr_files(spark, sf_dir), truth)
    return ocr.document_errors(ocr.assemble_text(files, _ocr_lines(spark, sf_dir)))


def ocr_doc_error(spark, sf_dir):
    errors = _doc_errors(spark, sf_dir).select(
        "file", "id", "n_chars", "n_words", "char_errors", "word_errors", "cer", "wer"
    )
    return _rounded(errors, "cer", "wer")


def ocr_summary(spark, sf_dir):
    summary = ocr.ocr_corpus_summary(_doc_errors(spark, sf_dir))
    shares = [c for c in summary.columns if c != "n_docs"]
    return summary.select(
        "n_docs", *[_r6(c) for c in shares], *[text.pct(F.col(c)).alias(f"{c}_pct") for c in shares]
    )


# --- labels, boxes, sequences ----------------------------------------------------

def label_encode(spark, sf_dir):
    names = ("en", "fr", "de")
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", "lang",
        layout.label_encode(F.col("lang"), names, -1).alias("id_strict"),
        layout.label_encode(F.col("lang"), names, 2).alias("id_other"),
    ).withColumn("read_back", layout.id_to_label(F.col("id_strict"), names))


def bbox_normalize(spark, sf_dir):
    tokens = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("page_key"), "l_orderkey", "l_linenumber",
        (F.col("l_quantity") * 20 - 100).alias("x1"), (F.col("l_extendedprice") / 100).alias("y1"),
    ).withColumn("x2", F.col("x1") + 300.5).withColumn("y2", F.col("y1") + 40.25)
    dims = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("page_key"), (F.col("p_size") * 20).alias("width"),
        F.col("p_retailprice").alias("height"),
    )
    corners = F.array(F.array("x1", "y1"), F.array("x2", "y1"), F.array("x2", "y2"), F.array("x1", "y2"))
    boxes = grouping.join_page_dims(tokens, dims).select(
        "page_key", "l_orderkey", "l_linenumber", "width", "height",
        layout.flatten_polygon(corners).alias("polygon"),
        layout.int_box(F.array("x1", "y1", "x2", "y2")).alias("box"),
    )
    scaled = grouping.normalize_boxes(boxes, "polygon", "width", "height", "norm8")
    scaled = grouping.normalize_boxes(scaled, "box", "width", "height", "norm4")
    return scaled.select(
        "page_key", "l_orderkey", "l_linenumber",
        _listed(F.col("norm8")).alias("norm8"), _listed(F.col("norm4")).alias("norm4"),
    )


def _tokens(spark, sf_dir) -> DataFrame:
    """Events as page tokens with gold and predicted field labels."""
    events = table(spark, sf_dir, "events")
    names = F.create_map(*[F.lit(x) for pair in FIELD_OF_EVENT.items() for x in pair])
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    gold = layout.label_encode(names[F.col("event_type")])
    pred = F.when(k % 7 == 0, (gold + 1) % 13).when(k % 11 == 0, F.lit(-1)).otherwise(gold)
    name = F.concat(F.lit("cv."), F.col("user_id").cast("string"), F.lit(".pdf"))
    return events.select(
        text.page_key(name).alias("page_key"), F.col("event_id").alias("pos"), "event_type", "value",
        k.alias("k"), gold.alias("gold_id"), pred.alias("pred_id"),
        layout.id_to_label(gold).alias("gold"), layout.id_to_label(pred).alias("pred"),
    )


def page_sequences(spark, sf_dir):
    chunks = grouping.group_tokens(_tokens(spark, sf_dir), "page_key", "pos", ["pos", "event_type"], 32)
    return chunks.select(
        "page_key", "chunk", "n_tokens",
        _listed(F.col("pos")).alias("positions"), _listed(F.col("event_type")).alias("tokens"),
    )


def sequence_pack(spark, sf_dir):
    tokens = _tokens(spark, sf_dir).withColumn("box", F.array(F.col("k"), F.col("gold_id")))
    pads = {"k": 0, "gold_id": layout.IGNORED, "box": F.array(F.lit(0), F.lit(0))}
    packed = grouping.encode_pages(tokens, "page_key", "pos", pads, 64)
    return packed.select(
        "page_key", _listed(F.col("k")).alias("input_ids"), _listed(F.col("gold_id")).alias("labels"),
        _listed(F.flatten("box")).alias("bbox"), _listed(F.col("attention_mask")).alias("attention_mask"),
    )


def argmax_mask(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", layout.argmax(F.col("embedding")).alias("pred"),
        F.when(F.col("label") == 9, layout.IGNORED).otherwise(F.col("label")).alias("gold"),
    )
    return grouping.mask_ignored(vectors, "gold", "pred")


def token_accuracy(spark, sf_dir):
    return _rounded(tagging.token_accuracy(_tokens(spark, sf_dir), "gold", "pred"), "accuracy")


def entity_prf(spark, sf_dir):
    tokens = _tokens(spark, sf_dir)
    rows = [
        tagging.evaluate_tags(tokens, "page_key", "pos", "gold", "pred", mode).withColumn("mode", F.lit(mode))
        for mode in ("compat", "runs")
    ]
    return _rounded(rows[0].unionByName(rows[1]), "precision", "recall", "f1", "accuracy")


def match_chunks(spark, sf_dir):
    tokens = _tokens(spark, sf_dir)
    gold = tagging.label_chunks(tokens, "page_key", "pos", "gold")
    pred = tagging.label_chunks(tokens, "page_key", "pos", "pred")
    return tagging.match_chunks(gold, pred, "page_key")


# --- splits and samples ----------------------------------------------------------

def split_exact(spark, sf_dir):
    return sampling.split_flag(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def holdout_sample(spark, sf_dir):
    return sampling.holdout_sample(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")


def eval_limit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return sampling.eval_limit(sampling.split_exact(docs, "doc_id")[1], "doc_id", 40)


def shuffle_rows(spark, sf_dir):
    return sampling.shuffle_rows(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", epoch=3)


def sample_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter(F.col("source") == "src0")
    return sampling.sample_n(docs.select("doc_id", "n_chars"), "doc_id", 20)


# --- similarity and metrics ------------------------------------------------------

def _similar(spark, sf_dir) -> DataFrame:
    left = table(spark, sf_dir, "embeddings")
    right = left.select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("embedding_b"), F.col("label").alias("label_b")
    )
    pairs = left.join(right, "vec_id").withColumn("target", (F.col("label") == F.col("label_b")).cast("double"))
    return evaluation.pair_similarity(pairs, "embedding", "embedding_b", "cosine")


def cosine_pairs(spark, sf_dir):
    return _rounded(_similar(spark, sf_dir).select("vec_id", "target", "cosine"), "cosine")


def cosine_loss(spark, sf_dir):
    return _rounded(evaluation.cosine_loss(_similar(spark, sf_dir), "cosine", "target"), "mse", "cosine_loss", "loss")


def mean_pool(spark, sf_dir):
    pooled = evaluation.mean_pool(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return _rounded(pooled.select("label", F.posexplode("pooled").alias("dim", "value")), "value")


def _scored_events(spark, sf_dir) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    return table(spark, sf_dir, "events").select(
        "event_type", (F.col("value") / 500).alias("pred"), (k / 100).alias("true")
    )


def pair_metrics(spark, sf_dir):
    row = evaluation.evaluate_pairs(_scored_events(spark, sf_dir), "pred", "true")
    return _rounded(row, "mse", "mae", "pearson", "spearman")


def spearman_by_group(spark, sf_dir):
    rows = evaluation.spearman(_scored_events(spark, sf_dir), "pred", "true", ["event_type"])
    return _rounded(rows, "spearman")


def average_ranks(spark, sf_dir):
    return ranking.avg_rank(_scored_events(spark, sf_dir), "pred", ["event_type"])


# --- training logs ---------------------------------------------------------------

def _steps(spark, sf_dir) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    return table(spark, sf_dir, "events").select(
        (F.dayofmonth("ts") - 1).alias("epoch"), F.col("event_id").alias("step"), "event_type", "value",
        (k / 100).alias("share"),
    )


def best_epoch(spark, sf_dir):
    epochs = _steps(spark, sf_dir).groupBy("epoch").agg(F.avg("value").alias("metric"))
    best = [
        logs.epoch_base1(logs.best_epoch(epochs, "metric", mode)).withColumn("mode", F.lit(mode))
        for mode in ("max", "min")
    ]
    return _rounded(best[0].unionByName(best[1]), "metric")


def metric_log(spark, sf_dir):
    steps = _steps(spark, sf_dir).select(
        "epoch", "step", "share",
        F.when(F.col("event_type") == "click", F.col("value")).alias("loss"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("eval_loss"),
    )
    kept = logs.log_rows(steps)
    train = kept.filter(F.col("loss").isNotNull()).select("epoch", "step", F.col("loss").alias("train_loss"))
    evals = kept.filter(F.col("eval_loss").isNotNull()).select(
        "epoch", "step", "eval_loss", F.col("share").alias("f1"), F.col("share").alias("accuracy")
    )
    return logs.metric_layout(logs.union_sparse(train, evals))


def epoch_mean_loss(spark, sf_dir):
    means = logs.epoch_mean_loss(_steps(spark, sf_dir), losses=("value", "share"))
    return _rounded(means, "mean_value", "mean_share")


# --- ranking and prompts ---------------------------------------------------------

def _candidates(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    raw = F.col("quality") * 0.5 - F.col("toxic") * 0.25 + F.col("n_chars") / 100000
    return docs.join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("source").alias("job_title"), F.col("doc_id").alias("resume_id"), raw.alias("score")
    )


def topk_minmax(spark, sf_dir):
    best = ranking.top_k_scaled(_candidates(spark, sf_dir), "job_title", "score", "resume_id")
    image = F.concat(F.lit("/in/resume."), F.col("resume_id").cast("string"), F.lit(".png"))
    return best.select(
        "job_title", "resume_id", text.out_path(image, "/in/", "/out/").alias("source_file"),
        _r6("normalized_score"), F.col("rank").cast("bigint").alias("rank"),
    )


def minmax_all(spark, sf_dir):
    return _rounded(
        ranking.minmax_by_group(_candidates(spark, sf_dir), "job_title", "score"), "score", "normalized_score"
    )


def _jobs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("src"), F.col("item_id").cast("string")).alias("job_title"), F.col("text").alias("job_text")
    )


def coarse_to_fine(spark, sf_dir):
    return ranking.attach_jobs(topk_minmax(spark, sf_dir), _jobs(spark, sf_dir)).drop("source_file")


def _records(spark, sf_dir) -> DataFrame:
    """Instruction records of the ranked candidates, numbered in résumé order."""
    numbered = skew.with_index(written(coarse_to_fine(spark, sf_dir), "ranked"), "resume_id")
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("resume_id"), "text")
    return numbered.join(texts, "resume_id").select(
        "id", "resume_id", F.col("text").alias("instruction"), F.col("job_text").alias("input")
    )


def render_prompt(spark, sf_dir):
    prompt = text.render_prompt(F.col("instruction"), F.col("input"))
    short = text.render_prompt(F.col("instruction"), F.col("input"), criteria=False)
    return _records(spark, sf_dir).select(
        "id", "resume_id", F.length(prompt).cast("bigint").alias("n_chars"),
        F.md5(prompt).alias("prompt_md5"), F.md5(short).alias("short_md5"),
    )


# --- generated text --------------------------------------------------------------

def _responses(spark, sf_dir) -> DataFrame:
    """Event rows as model responses; errors give none with a score."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    reason = (
        F.when(F.col("event_type") == "click", "经验不足，缺乏技能。")
        .when(F.col("event_type") == "view", "技能缺乏。").otherwise("经验相关。")
    )
    scored = F.concat(
        F.lit("编号 "), F.col("event_id").cast("string"), F.lit("，匹配度：0."), F.lpad(k, 2, "0"),
        F.lit("\n理由："), reason, F.lit(" v7.5，共 "), (F.col("user_id") + 2).cast("string"), F.lit(" 项\n 75% "),
    )
    response = F.when(F.col("event_type") == "error", F.lit("无法评分\n理由。")).otherwise(scored)
    true = F.when(F.col("user_id") % 10 == 0, F.lit(None)).otherwise(k.cast("double") / 100)
    return table(spark, sf_dir, "events").select("event_id", response.alias("response"), true.alias("true_score"))


def extract_score(spark, sf_dir):
    return _responses(spark, sf_dir).select(
        "event_id", text.last_unit_number(F.col("response")).alias("score"),
        text.reason_tail(F.col("response")).alias("reason"),
    )


def floor_soften(spark, sf_dir):
    score = text.last_unit_number(F.col("response"))
    return _responses(spark, sf_dir).select(
        "event_id", text.floor_zero_score(score).alias("score"),
        text.soften_reason(score, F.col("response")).alias("response"),
    )


def _generated(spark, sf_dir) -> DataFrame:
    """Conversation texts with zero to three score objects, some not well formed."""
    number = (
        F.when(F.col("conv_id") % 5 == 0, F.lit("1.2.3")).when(F.col("conv_id") % 7 == 0, F.lit("."))
        .otherwise(F.concat(F.lit("0."), F.col("turn").cast("string"), (F.col("conv_id") % 10).cast("string")))
    )
    block = lambda n: F.when(
        F.col("turn") % 4 >= n,
        F.concat(F.lit('"score" :\n '), number, F.lit(f',\n"reason": "{n} '), F.col("text"), F.lit('"\n')),
    ).otherwise(F.lit(""))
    lead = F.when(F.col("conv_id") % 2 == 0, F.lit("")).otherwise(F.concat(F.col("text"), F.lit("\n{ ")))
    generated = F.concat(lead, block(1), block(2), block(3))
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), generated.alias("generated_output"),
        F.lit(0.5).alias("true_score"), F.col("role").alias("reference_output"),
    )


def clean_generated(spark, sf_dir):
    kept = collections.drop_fields(_generated(spark, sf_dir))
    segment = text.second_score_segment(F.col("generated_output"))
    return kept.withColumn("generated_output", segment).withColumn("score", text.json_score(F.col("generated_output")))


def score_report(spark, sf_dir):
    blocks = clean_generated(spark, sf_dir).select(
        "id", text.report_block(F.col("id"), F.col("score"), F.col("generated_output")).alias("block")
    )
    return collections.report_order(blocks)


def valid_failed(spark, sf_dir):
    scored = _responses(spark, sf_dir).withColumn("pred_score", text.last_unit_number(F.col("response")))
    return evaluation.pair_counts(scored, "pred_score", "true_score")


def failed_rows(spark, sf_dir):
    scored = _responses(spark, sf_dir).withColumn("pred_score", text.last_unit_number(F.col("response")))
    return evaluation.failed_pairs(scored, "pred_score", "true_score")


def _instruction_texts(spark, sf_dir) -> DataFrame:
    """Documents with their job in the layout of instruction records."""
    docs = table(spark, sf_dir, "documents").withColumnRenamed("source", "job_title")
    record = F.concat(
        F.lit("岗位描述："), F.col("job_text"), F.lit("\n简历内容："),
        F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.concat(F.col("text"), F.lit("\n\n"))),
        F.lit("Education: School "), F.col("doc_id").cast("string"),
        F.lit("\n\nWork Experience: "), F.col("text"),
        F.lit("\n\nProjects: \n\nSkills: "), F.concat_ws("; ", "lang", "job_title", F.lit("office")),
        F.lit("\n\nCertifications: "), F.when(F.col("lang") == "de", "DIN").otherwise(F.lit("")),
        F.lit("\n\nLanguages: "), F.col("lang"),
    )
    target = F.concat(F.lit("匹配度：0."), F.lpad((F.col("doc_id") % 100).cast("string"), 2, "0"), F.lit("\n理由：ok "), F.col("lang"))
    return ranking.attach_jobs(docs, _jobs(spark, sf_dir)).select(
        "doc_id", record.alias("input"), target.alias("output")
    )


def parse_sections(spark, sf_dir):
    parsed = _instruction_texts(spark, sf_dir).select(
        "doc_id", text.parse_instruction(F.col("input")).alias("r"), text.parse_target(F.col("output")).alias("t")
    )
    return parsed.select(
        "doc_id", *[F.col(f"r.{f}").alias(f) for f in text.SECTION_FIELDS], "t.score", "t.reason"
    )


def item_counts(spark, sf_dir):
    parsed = _instruction_texts(spark, sf_dir).select(text.parse_instruction(F.col("input")).alias("r"))
    items = parsed.select(F.explode(text.list_items(F.col("r.skills"))).alias("item"))
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def scrub_pii(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", privacy.scrub_pii(F.col("text"), F.col("doc_id")).alias("text")
    )


# --- files and sources -----------------------------------------------------------

def union_sources(spark, sf_dir):
    sources = {
        "documents": table(spark, sf_dir, "documents").select("text"),
        "conversations": table(spark, sf_dir, "conversations").select("text"),
        "benchmark": table(spark, sf_dir, "benchmark").select("text"),
    }
    return collections.source_counts(collections.union_sources(sources))


def pending_outputs(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    path = F.regexp_replace(F.col("url"), "^https?://", "/in/")
    listed = pages.select(
        "page_id", F.startswith("url", F.lit("https")).alias("https"),
        text.first_int(F.col("url")).alias("first_int"), text.out_path(path, "/in/", "/out/").alias("out_path"),
    )
    done = listed.filter("https").select("out_path")
    return collections.pending_files(listed, done).drop("https")


def incremental(spark, sf_dir):
    base = work_dir(spark, "incremental")
    schema = table(spark, sf_dir, "documents").schema
    return incremental_files(
        spark, f"{sf_dir}/{{documents.parquet}}", f"{base}/out", f"{base}/checkpoint", schema,
        lambda df: df.select("doc_id", "source", F.length("text").cast("bigint").alias("n_chars")),
    )


# --- models ----------------------------------------------------------------------

def _pairs(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    docs = docs.select(
        "doc_id", F.col("source").alias("job_title"), F.col("text").alias("text_a"),
        (F.col("quality") * 0.7 + (1 - F.col("toxic")) * 0.3).alias("label"),
    )
    return ranking.attach_jobs(docs, _jobs(spark, sf_dir)).withColumnRenamed("job_text", "text_b")


def _described_pairs(spark, sf_dir) -> DataFrame:
    return models.pair_features(_pairs(spark, sf_dir)).drop("text_a", "text_b")


def pair_features(spark, sf_dir):
    return _rounded(_described_pairs(spark, sf_dir).drop("features", "label"), *models.PAIR_FEATURES)


def _linear_pairs(spark, sf_dir) -> DataFrame:
    """Pairs whose label is a linear function of their features, with the split as a flag, written once."""
    label = 0.1 + 0.5 * F.col("binary_cosine") + 0.3 * F.col("length_ratio")
    described = _described_pairs(spark, sf_dir).withColumn("label", label)
    flags = sampling.split_flag(_pairs(spark, sf_dir).select("doc_id"), "doc_id")
    return written(described.join(flags, "doc_id"), "pairs")


def pair_model(spark, sf_dir):
    """The best scorer: without penalty it finds the linear label."""
    pairs = _linear_pairs(spark, sf_dir)
    _, log = models.select_model(pairs.filter("not is_validation"), pairs.filter("is_validation"))
    best = logs.best_epoch(log, "spearman")
    places = {"mse": 6, "mae": 4, "pearson": 4, "spearman": 2}
    return best.select("epoch", "penalty", "n", *[F.round(c, d).alias(c) for c, d in places.items()])


def pair_scores(spark, sf_dir):
    """Predicted score of every validation pair."""
    pairs = _linear_pairs(spark, sf_dir)
    model = models.fit_pair_scorer(pairs.filter("not is_validation"))
    scored = models.score_pairs(model, pairs.filter("is_validation"))
    return scored.select("doc_id", F.round("predicted_score", 4).alias("predicted_score"))


def residual_moments(spark, sf_dir):
    """Least squares leaves residuals without mean and without relation to any feature."""
    described = written(_described_pairs(spark, sf_dir), "pairs")
    raw = models.fit_pair_scorer(described).transform(described)
    rest = F.col("label") - F.col("_raw")
    return raw.agg(
        F.count(F.lit(1)).alias("n"), (F.abs(F.avg(rest)) < 1e-6).alias("no_mean"),
        *[(F.abs(F.avg(rest * F.col(c))) < 1e-6).alias(f"no_{c}") for c in models.PAIR_FEATURES])


def field_tagger(spark, sf_dir):
    """Whole pages are held out. The token decides the label, so every held-out token is found."""
    tokens = _tokens(spark, sf_dir).select(
        "page_key", "pos", F.col("event_type").alias("text"),
        F.array(F.col("k"), F.col("value").cast("int"), F.col("k") + 10, F.lit(900)).alias("box"), "gold",
    )
    described = models.token_features(tokens, "page_key", "pos", box="box")
    split = written(sampling.split_groups(described, "page_key"), "tokens")
    model = models.fit_field_tagger(split.filter("not is_validation"), layout.LABELS_EN, "gold", iterations=20)
    tagged = models.tag_fields(model, split.filter("is_validation"))
    return _rounded(tagging.evaluate_tags(tagged, "page_key", "pos", "gold", "predicted"), "precision", "recall", "f1", "accuracy")


def batch_infer(spark, sf_dir):
    def loader():
        return {"separator": "|"}

    def count_words(model, batch):
        texts = batch.column(0).to_pylist()
        if any(model["separator"] in t for t in texts):
            raise ValueError("separator in text")
        return [len(t.split(" ")) for t in texts]

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return inference.infer_batches(docs, ["text"], loader, count_words, "bigint", keep=["doc_id"])


def split_inferred(spark, sf_dir):
    """Good and bad records apart; the model's answers are written first, so it runs once."""
    good, bad = inference.split_errors(written(batch_infer(spark, sf_dir), "inferred"))
    parts = good.withColumn("part", F.lit("good")), bad.drop("error").withColumn("part", F.lit("bad"))
    return parts[0].unionByName(parts[1])


def score_records(spark, sf_dir):
    def loader():
        return "匹配度：0."

    def generate(model, prompts):
        def one(prompt):
            size = len(prompt)
            if size % 13 == 0:
                return ValueError("no answer")
            reason = "技能不足。" if size % 3 else "经验相关。"
            return f" {prompt}\n{model}{size % 7}0\n理由：{reason} "

        return [one(prompt) for prompt in prompts]

    records = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.col("text").alias("instruction"),
        F.col("role").alias("input"),
        F.concat(F.lit("匹配度：0."), F.col("turn").cast("string"), F.lit("\n理由：-")).alias("output"),
    )
    return inference.score_records(records, loader, generate, batched=True)


QUERIES = {
    "q01_ocr_assemble": ocr_assemble,
    "q02_ocr_doc_error": ocr_doc_error,
    "q03_ocr_summary": ocr_summary,
    "q04_label_encode": label_encode,
    "q05_bbox_normalize": bbox_normalize,
    "q06_page_sequences": page_sequences,
    "q07_sequence_pack": sequence_pack,
    "q08_argmax_mask": argmax_mask,
    "q09_token_accuracy": token_accuracy,
    "q10_entity_prf": entity_prf,
    "q10b_match_chunks": match_chunks,
    "q11_split_exact": split_exact,
    "q12_holdout_sample": holdout_sample,
    "q12b_shuffle_rows": shuffle_rows,
    "q12c_eval_limit": eval_limit,
    "q13_cosine_pairs": cosine_pairs,
    "q13b_cosine_loss": cosine_loss,
    "q13c_mean_pool": mean_pool,
    "q14_pair_metrics": pair_metrics,
    "q15_spearman_by_group": spearman_by_group,
    "q15b_average_ranks": average_ranks,
    "q16_best_epoch": best_epoch,
    "q17_metric_log": metric_log,
    "q18_epoch_mean_loss": epoch_mean_loss,
    "q19_topk_minmax": topk_minmax,
    "q19b_minmax_all": minmax_all,
    "q20_coarse_to_fine": coarse_to_fine,
    "q21_render_prompt": render_prompt,
    "q22_extract_score": extract_score,
    "q23_floor_soften": floor_soften,
    "q24_clean_generated": clean_generated,
    "q25_score_report": score_report,
    "q26_valid_failed": valid_failed,
    "q26b_failed_rows": failed_rows,
    "q27_parse_sections": parse_sections,
    "q28_item_counts": item_counts,
    "q29_scrub_pii": scrub_pii,
    "q29b_sample_source": sample_source,
    "q30_union_sources": union_sources,
    "q31_pending_outputs": pending_outputs,
    "q32_pair_model": pair_model,
    "q32b_pair_features": pair_features,
    "q32c_pair_scores": pair_scores,
    "q32d_residual_moments": residual_moments,
    "q33_field_tagger": field_tagger,
    "q34_incremental_files": incremental,
    "q35_batch_infer": batch_infer,
    "q35b_split_inferred": split_inferred,
    "q36_score_records": score_records,
}
