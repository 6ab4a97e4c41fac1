"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm import decontamination, html_blocks, jaccard_join, lexical_search, piece_codec, quality_model, secret_scan, simhash, subspace_join, target_sampling, token_codes, url_filter, warc_bundles
from dossier.llm.common import table, written

QUALITY_LEAST = 0.3


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(table(spark, sf_dir, "documents"), width=3, least=90, of=100).select(
        "doc_id", "n_shingles", "component_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_codes.write_ids(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_codes.read_ids(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = secret_scan.scan(documents, secret_scan.train(documents), keep=["doc_id"])
    counts = [secret_scan.kind_count(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS]
    return found.select(
        "doc_id", *counts,
        F.sha2(secret_scan.joined(base_only=True).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined().alias("spans"),
    )


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc_bundles.write_bundles(table(spark, sf_dir, "pages"))
    manifest = spark.read.parquet(f"{folder}-manifest")
    return warc_bundles.read_bundles(manifest, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Host suffix, path prefix and verdict, as given.
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_codec.encode(table(spark, sf_dir, "documents"), model, keep=["doc_id"])
    back = piece_codec.decode(coded, model)
    return back.select(
        "doc_id",
        piece_codec.id_count("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~quality_model.held_out())
    scored = quality_model.score(documents, quality_model.fit(documents, labels), keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(quality_model.held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"))


def op9_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    text = html_blocks.extract(pages, html_blocks.fit(pages), keep=["page_id", "url"])
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op10_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.similar(table(spark, sf_dir, "embeddings"), least=0.9)


def op11_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_sampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the asked columns, ``n_near``: other documents within the radius, found by block tables."""
    marks = written(simhash.drift(table(spark, sf_dir, "documents")), "marks")
    return marks.join(simhash.near_counts(marks), "fingerprint", "left").select(*marks.columns, F.coalesce("n_near", F.lit(0)).alias("n_near"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_decontamination": op2_decontamination,
    "op3_token_codes": op3_token_codes,
    "op4_secret_scan": op4_secret_scan,
    "op5_warc_bundles": op5_warc_bundles,
    "op6_url_filter": op6_url_filter,
    "op7_piece_codec": op7_piece_codec,
    "op8_quality_model": op8_quality_model,
    "op9_html_blocks": op9_html_blocks,
    "op10_subspace_join": op10_subspace_join,
    "op11_target_sampling": op11_target_sampling,
    "op12_simhash": op12_simhash,
    "op13_ranked_search": op13_ranked_search,
}

def _reachable(links: str) -> str:
    """Smallest id reachable over symmetric links (x, y), in common table expressions."""
    return f"""links AS ({links}),
        reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
        roots AS (SELECT x, least(x, min(y)) AS root FROM reach GROUP BY x)"""


def _terms(x: str) -> str:
    """All runs of digits, letters and characters beyond ASCII, only A-Z lowered."""
    lower = f"translate(coalesce({x}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


_DIGIT_BITS = " ".join(f"WHEN '{i:x}' THEN '{i:04b}'" for i in range(16))
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLE: dict[str, str] = {
    "op1_jaccard_join": f"""WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
          FROM documents),
        sets AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        {_reachable("""SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
          WHERE 100 * i >= 90 * (a.n + b.n - i)""")}
        SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, doc_id) AS component_id
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN roots ON x = doc_id""",
    "op5_warc_bundles": f"""WITH hashed AS (
          SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last,
                 array_to_string(list_transform(string_split(sha1(coalesce(html, '')), ''), lambda c: CASE c {_DIGIT_BITS} END), '') AS bits
          FROM pages)
        SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('{_BASE32}', 1 + 16 * substr(bits, 5 * i + 1, 1)::INT
                 + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT
                 + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last THEN last END AS refers_to FROM hashed""",
    "op10_subspace_join": f"""WITH RECURSIVE {_reachable("""SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b
          ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.9""")},
        degrees AS (SELECT x, count(*) AS n FROM links GROUP BY x)
        SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
        FROM embeddings LEFT JOIN roots ON roots.x = vec_id LEFT JOIN degrees ON degrees.x = vec_id""",
    "op13_ranked_search": f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_terms("text")} AS t FROM documents),
        sizes AS (SELECT r, doc_id, len(t)::BIGINT AS n FROM docs WHERE len(t) > 0),
        total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
        asked AS (SELECT DISTINCT item_id, unnest({_terms("text")}) AS term FROM benchmark),
        held AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM docs)
          SEMI JOIN asked USING (term) GROUP BY r, term),
        weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, total GROUP BY term),
        scores AS (SELECT item_id, r, any_value(doc_id) AS doc_id,
            sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
          FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (r), total GROUP BY item_id, r),
        placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
        SELECT item_id, place::INT AS rank, doc_id, score FROM placed WHERE place <= 10""",
}
