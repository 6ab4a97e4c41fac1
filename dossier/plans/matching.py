"""Queries that match candidates to targets, keep the best iteration and route broken input, with their SQL."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from dossier.functions import privacy
from dossier.operators import boosting, retrieval, sampling, term_weights
from dossier.plans import queries as base
from dossier.plans.oracle import ORACLE as _BASE, _terms
from dossier.plans.queries import _rounded, table
from dossier.session import work_dir, written
from dossier.sources import images, quarantine, sinks, tables

TOP_N = 10
#: Every so many vectors one is a target.
EVERY = 20
KEY = "a key of the run"


def coarse_top_n(spark, sf_dir):
    """The best candidates of each target by cosine, over all vectors."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    best, _ = retrieval.coarse_top_k(vectors.filter(F.col("id") % EVERY == 0), vectors, TOP_N)
    return _rounded(best, "score")


def coarse_to_text(spark, sf_dir):
    """Coarse retrieval by inner product, then the target's text: what a fine ranking would read."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    jobs = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("target"), F.col("text").alias("job_text"))
    targets = vectors.join(jobs.select(F.col("target").alias("id")), "id", "left_semi")
    best, _ = retrieval.coarse_top_k(targets, vectors, 3, normalize=False)
    return _rounded(best.join(jobs, "target"), "score")


def idf_table(spark, sf_dir):
    return _rounded(written(term_weights.document_frequencies(table(spark, sf_dir, "documents")), "frequencies"), "idf")


def idf_cosine(spark, sf_dir):
    """Cosine of each document with the text of the job it applies for, weighted by rarity of terms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("job_title"), term_weights.terms_of(F.col("text")).alias("text"))
    docs = written(docs, "terms")  # texts are split once, for the frequencies too
    jobs = base._jobs(spark, sf_dir).withColumnRenamed("job_text", "text")
    frequencies = written(term_weights.document_frequencies(docs), "frequencies")
    return _rounded(term_weights.idf_cosine(docs, jobs, frequencies, "doc_id", "job_title"), "idf_cosine")


def _tree_rows(spark, sf_dir):
    """Documents whose label a small tree makes, with the split as a flag, written once."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    facts = docs.select("doc_id", (F.col("lang") == "en").cast("double").alias("english"), F.col("toxic").cast("double").alias("toxic"),
                        (F.col("n_chars") % 8).cast("double").alias("octave"))
    label = (F.when(F.col("english") == 1, F.when(F.col("octave") <= 3, 0.9).otherwise(0.6))
             .otherwise(F.when(F.col("toxic") == 1, 0.1).otherwise(0.4)))
    described = VectorAssembler(inputCols=["english", "toxic", "octave"], outputCol="features").transform(facts.withColumn("label", label))
    flags = sampling.split_flag(facts.select("doc_id"), "doc_id")
    return written(described.select("doc_id", "label", "features").join(flags, "doc_id"), "tree-rows")


def boosted_best(spark, sf_dir):
    """The best iteration on held-out rows: one tree is enough for labels that a tree makes."""
    rows = _tree_rows(spark, sf_dir)
    _, trees, log = boosting.select_iteration(rows.filter("not is_validation"), rows.filter("is_validation"), iterations=4, depth=4)
    return _rounded(log.filter(F.col("trees") == trees), "mse", "mae")


def boosted_scores(spark, sf_dir):
    """Predicted score of every held-out row by the trees kept."""
    rows = _tree_rows(spark, sf_dir)
    held = rows.filter("is_validation")
    model, trees, _ = boosting.select_iteration(rows.filter("not is_validation"), held, iterations=4, depth=4)
    return _rounded(boosting.score_boosted(model, held, trees).select("doc_id", "predicted_score"), "predicted_score")


def quarantine_lines(spark, sf_dir):
    """Documents as JSON lines, some cut off, of wrong type, without a field or empty; each line is found again.

    A record holds its place in its file, so ``moved`` says whether the line number is right.
    """
    place = (F.monotonically_increasing_id() % (1 << 33) + 1).alias("place")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", place)
    record = F.struct("place", "doc_id", F.when(F.col("doc_id") % 13 == 4, F.lit("many")).otherwise(F.length("text").cast("string")).alias("n"),
                      F.when(F.col("doc_id") % 17 != 5, F.col("text")).alias("text"))
    number = F.regexp_replace(F.to_json(record), '"n":"([0-9]+)"', '"n":$1')
    line = (F.when(F.col("doc_id") % 7 == 3, F.substring(number, F.lit(1), F.length(number) - 2))
            .when(F.col("doc_id") % 11 == 6, "[1]").when(F.col("doc_id") % 19 == 8, "  ").otherwise(number))
    path = work_dir(spark, "records")
    docs.select(line.alias("value")).write.text(path)
    good, bad = quarantine.read_json_lines(spark, path, "place bigint, doc_id bigint, n bigint, text string", ["doc_id", "text"])
    told = F.col("reason").isin("no text", "wrong type", "malformed JSON")
    found = lambda name: F.when(told, F.regexp_extract("record", f'"{name}":([0-9]+)', 1).cast("bigint"))
    return good.select("doc_id", "n", (F.col("line") - F.col("place")).alias("moved"), F.lit("").alias("reason")).unionByName(
        bad.select(found("doc_id").alias("doc_id"), F.lit(None).cast("bigint").alias("n"), (F.col("line") - found("place")).alias("moved"), "reason"))


def quarantine_rows(spark, sf_dir):
    """Conversation turns as CSV pairs, some with a cell too many or a label that is no number."""
    turns = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), "role", "text")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    label = F.when(F.col("id") % 9 == 2, F.lit("high")).when(F.col("id") % 15 == 3, F.lit("")).otherwise((F.col("id") % 100 / 100).cast("string"))
    line = F.concat_ws(",", F.col("id").cast("string"), quoted, F.col("role"), label, F.when(F.col("id") % 14 == 1, "extra"))
    path = work_dir(spark, "pairs")
    first_of_file = F.monotonically_increasing_id() % (1 << 33) == 0
    turns.select(F.when(first_of_file, F.concat(F.lit("id,text_a,text_b,label\n"), line)).otherwise(line).alias("value")).write.text(path)
    good, bad = quarantine.read_csv_rows(spark, path, "id bigint, text_a string, text_b string, label double", ["label"])
    first = F.regexp_extract("record", r'^(?:\{"id":")?([0-9]+)', 1).cast("bigint")
    none = F.lit(None)
    return good.select("id", F.length("text_a").cast("bigint").alias("n"), "label", F.lit("").alias("reason")).unionByName(
        bad.select(first.alias("id"), none.cast("bigint").alias("n"), none.cast("double").alias("label"), "reason"))


def scrubbed_values(spark, sf_dir):
    """Documents, some with values of other documents, every value overwritten by its own surrogate."""
    shared = F.concat(F.lit(" mail USER"), (F.col("doc_id") % 40).cast("string"), F.lit("@mail.org or 555-123-4567 or 10.0.0."), (F.col("doc_id") % 9).cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", privacy.scrub_values(F.concat("text", shared), KEY).alias("text"))


def image_dims(spark, sf_dir):
    """Sizes from headers made of the parts, half of them PNG; some are cut off or of another format."""
    four = lambda c: F.lpad(F.hex(F.col(c).cast("int")), 4, "0")
    parts = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 20).alias("w"), F.floor("p_retailprice").alias("h"))
    png = F.concat(F.lit("89504E470D0A1A0A0000000D494844520000"), four("w"), F.lit("0000"), four("h"), F.lit("0802000000"))
    jpeg = F.concat(F.lit("FFD8FFE00004AABBFFFFDB0003CCFFC2000B08"), four("h"), four("w"), F.lit("01011100FFDA"))
    raw = F.when(F.col("p_partkey") % 2 == 0, png).otherwise(jpeg)
    raw = F.when(F.col("p_partkey") % 11 == 3, F.substring(raw, 1, 40)).when(F.col("p_partkey") % 13 == 5, F.lit("47494638")).otherwise(raw)
    good, bad = images.page_dims(parts.select("p_partkey", F.unhex(raw).alias("content")))
    return good.withColumn("reason", F.lit("")).unionByName(bad, allowMissingColumns=True)


def repeated_appends(spark, sf_dir):
    """Two runs of a metric log, the first written twice."""
    path = work_dir(spark, "runs")
    rows = base.metric_log(spark, sf_dir)
    for run, part in (("a", "epoch < 10"), ("b", "epoch >= 10"), ("a", "epoch < 10")):
        sinks.append_metrics(rows.filter(part), path, run)
    return tables.read_metrics(spark, path)


def run_manifest(spark, sf_dir):
    """Row counts as a manifest, with the time of writing as a flag."""
    path = work_dir(spark, "manifest")
    counts = {name: table(spark, sf_dir, name).count() for name in ("documents", "pages", "events")}
    sinks.write_run_manifest(spark, {**counts, "input": "tables", "share": 0.1}, path)
    row = spark.read.schema("documents bigint, pages bigint, events bigint, input string, share double, created_at string").json(path)
    recent = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("created_at")) < 3600
    return row.select("documents", "pages", "events", "input", "share", recent.alias("recent"))


QUERIES = {
    "q52_coarse_top_n": coarse_top_n,
    "q52b_coarse_to_text": coarse_to_text,
    "q53_idf_table": idf_table,
    "q53b_idf_cosine": idf_cosine,
    "q54_boosted_best": boosted_best,
    "q54b_boosted_scores": boosted_scores,
    "q55_quarantine_lines": quarantine_lines,
    "q55b_quarantine_rows": quarantine_rows,
    "q56_image_dims": image_dims,
    "q57_scrubbed_values": scrubbed_values,
    "q58_repeated_appends": repeated_appends,
    "q59_run_manifest": run_manifest,
}

_IDF = f"""terms AS (SELECT doc_id, unnest({_terms("coalesce(text, '')")}) AS term FROM documents),
idf AS (SELECT term, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) + 1 AS idf FROM terms GROUP BY term)"""
_TREE = f"""rows AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN CASE WHEN n_chars % 8 <= 3 THEN 0.9 ELSE 0.6 END
                      WHEN toxic = 1 THEN 0.1 ELSE 0.4 END::DOUBLE AS label FROM documents JOIN labels USING (doc_id)),
held AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS place,
  ceil(count(*) OVER () * 0.1::DOUBLE) AS size FROM rows) WHERE place <= size)"""


def _nearest(score: str, targets: str, most: int) -> str:
    return f"""SELECT target, row_number() OVER (PARTITION BY target ORDER BY score DESC, id) AS rank, id, score
      FROM (SELECT t.vec_id AS target, c.vec_id AS id, round({score}, 9) AS score FROM embeddings t, embeddings c WHERE {targets})
      QUALIFY rank <= {most}"""


def _surrogate(v: str) -> str:
    kind = f"""CASE WHEN contains({v}, '@') THEN 'email' WHEN regexp_full_match({v}, '{privacy.PATTERNS["number"]}') THEN 'number'
      WHEN regexp_full_match({v}, '{privacy.PATTERNS["ip"]}') THEN 'ip' ELSE 'phone' END"""
    plain = f"CASE {kind} WHEN 'email' THEN lower({v}) WHEN 'ip' THEN {v} ELSE regexp_replace({v}, '[^0-9]', '', 'g') END"
    digest = f"sha256('{KEY}:' || {kind} || ':' || {plain})"
    digits = f"substr(translate({digest}, 'abcdef', '012345'), 1, 16)"
    return f"""CASE {kind} WHEN 'email' THEN 'user_' || substr(translate({digest}, '0123456789', 'ghijklmnop'), 1, 12) || '@example.com'
      WHEN 'number' THEN '#' || {digits}
      WHEN 'ip' THEN '2001:db8::' || substr({digest}, 1, 4) || ':' || substr({digest}, 5, 4) || ':' || substr({digest}, 9, 4)
      ELSE '555-' || {digits} END"""


_EVERY = "|".join(f"(?:{p})" for p in privacy.PATTERNS.values())

ORACLE = {
    "q52_coarse_top_n": f"""SELECT target, rank::INT AS rank, id, round(score, 6) AS score FROM (
        {_nearest("list_cosine_similarity(t.embedding::DOUBLE[], c.embedding::DOUBLE[])", f"t.vec_id % {EVERY} = 0", TOP_N)})""",
    "q52b_coarse_to_text": f"""SELECT target, rank::INT AS rank, id, round(score, 6) AS score, text AS job_text FROM (
        {_nearest("list_inner_product(t.embedding::DOUBLE[], c.embedding::DOUBLE[])", "t.vec_id IN (SELECT item_id FROM benchmark)", 3)})
        JOIN benchmark ON target = item_id""",
    "q53_idf_table": f"WITH {_IDF} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "q53b_idf_cosine": f"""WITH {_IDF},
        jobs AS (SELECT job_title, term, idf FROM (SELECT 'src' || item_id AS job_title, unnest({_terms("text")}) AS term FROM benchmark) JOIN idf USING (term)),
        a AS (SELECT doc_id, source AS job_title, term, idf FROM documents JOIN terms USING (doc_id) JOIN idf USING (term)),
        ab AS (SELECT doc_id, sum(a.idf * a.idf) AS ab FROM a JOIN jobs USING (job_title, term) GROUP BY doc_id),
        aa AS (SELECT doc_id, sum(idf * idf) AS aa FROM a GROUP BY doc_id),
        bb AS (SELECT job_title, sum(idf * idf) AS bb FROM jobs GROUP BY job_title)
        SELECT doc_id, source AS job_title, round(coalesce(ab / (sqrt(aa) * sqrt(bb)), 0), 6) AS idf_cosine
        FROM documents LEFT JOIN ab USING (doc_id) LEFT JOIN aa USING (doc_id) LEFT JOIN bb ON source = bb.job_title""",
    "q54_boosted_best": f"WITH {_TREE} SELECT 0 AS epoch, 1 AS trees, count(*) AS n, 0::DOUBLE AS mse, 0::DOUBLE AS mae FROM held",
    "q54b_boosted_scores": f"WITH {_TREE} SELECT doc_id, label AS predicted_score FROM held",
    "q55_quarantine_lines": """SELECT CASE WHEN reason NOT IN ('no object', 'empty line') THEN doc_id END AS doc_id, CASE WHEN reason = '' THEN n END AS n,
          CASE WHEN reason NOT IN ('no object', 'empty line') THEN 0::BIGINT END AS moved, reason
        FROM (SELECT doc_id, length(text) AS n, CASE WHEN doc_id % 7 = 3 THEN 'malformed JSON' WHEN doc_id % 11 = 6 THEN 'no object'
                WHEN doc_id % 19 = 8 THEN 'empty line' WHEN doc_id % 13 = 4 THEN 'wrong type' WHEN doc_id % 17 = 5 OR text IS NULL THEN 'no text' ELSE '' END AS reason
              FROM documents)""",
    "q55b_quarantine_rows": """SELECT id, CASE WHEN reason = '' THEN n END AS n, CASE WHEN reason = '' THEN label END AS label, reason
        FROM (SELECT id, length(text) AS n, (id % 100) / 100 AS label, CASE WHEN id % 14 = 1 THEN 'wrong number of cells'
                WHEN id % 9 = 2 THEN 'wrong type' WHEN id % 15 = 3 THEN 'no label' ELSE '' END AS reason
              FROM (SELECT conv_id * 100 + turn AS id, text FROM conversations))""",
    "q56_image_dims": """SELECT p_partkey, CASE WHEN reason = '' THEN p_size::BIGINT * 20 END AS width,
          CASE WHEN reason = '' THEN floor(p_retailprice)::BIGINT END AS height, reason
        FROM (SELECT *, CASE WHEN p_partkey % 11 = 3 THEN 'cut off' WHEN p_partkey % 13 = 5 THEN 'unknown format' ELSE '' END AS reason FROM part)""",
    "q57_scrubbed_values": f"""WITH t AS (SELECT doc_id, text || ' mail USER' || (doc_id % 40) || '@mail.org or 555-123-4567 or 10.0.0.' || (doc_id % 9) AS t FROM documents),
        cut AS (SELECT doc_id, regexp_extract_all(t, '{_EVERY}', 0) AS m, regexp_split_to_array(t, '{_EVERY}') AS g FROM t)
        SELECT doc_id, array_to_string(list_transform(range(1, len(g) + 1), lambda i: g[i] || CASE WHEN i > len(m) THEN '' ELSE {_surrogate("m[i]")} END), '') AS text
        FROM cut""",
    "q58_repeated_appends": f"""SELECT *, CASE WHEN epoch < 10 THEN 'a' ELSE 'b' END AS run FROM ({_BASE["q17_metric_log"]})""",
    "q59_run_manifest": """SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM pages) AS pages,
          (SELECT count(*) FROM events) AS events, 'tables' AS input, 0.1::DOUBLE AS share, true AS recent""",
}
