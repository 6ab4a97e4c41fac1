"""The registered queries in DuckDB SQL, for comparison.

Fitted models have a known result on labels that follow from their features.
"""

from __future__ import annotations

from dossier.functions import text
from dossier.functions.layout import LABELS_EN

_ESCAPES = {f"\\u{code}": f"\\x{{{code}}}" for code in (
    "1680", "2000", "200a", "2028", "2029", "202f", "205f", "3000"
)}


def _re2(pattern: str) -> str:
    """The Java pattern with its character escapes in RE2 form."""
    for java, re2 in _ESCAPES.items():
        pattern = pattern.replace(java, re2)
    return pattern.replace(r"\x85\xa0", r"\x{85}\x{a0}")


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


WS = _re2(text.WHITESPACE)


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{WS}+|{WS}+\z', '', 'g')"


def _words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


# Accented letters of the tables as control characters, since DuckDB counts bytes.
_ACCENTED = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
_CONTROLS = "||".join(f"chr({n})" for n in [*range(1, 9), *range(14, 27)][: len(_ACCENTED)])


def _distance(a: str, b: str) -> str:
    return f"levenshtein(translate({a}, '{_ACCENTED}', {_CONTROLS}), translate({b}, '{_ACCENTED}', {_CONTROLS}))::BIGINT"


_LINES = """lines AS (
  SELECT conv_id, turn, replace(replace(text, 'tion', 'ti0n'), 'é', 'e') AS t, text AS original,
         0.5::DOUBLE + ('0x' || substr(md5(conv_id || ':' || turn), 1, 4))::INT::DOUBLE / 131070 AS conf
  FROM conversations)"""
_ASSEMBLED = f"""{_LINES},
joined AS (
  SELECT conv_id, {_strip(f"string_agg({_strip('t')}, ' ' ORDER BY turn)")} AS ocr_text,
         {_strip(f"string_agg({_strip('original')}, ' ' ORDER BY turn)")} AS truth,
         avg(conf) AS conf, count(*) AS n
  FROM lines GROUP BY conv_id)"""
_DOC_ERRORS = f"""{_ASSEMBLED},
words AS (
  SELECT *, {_words('ocr_text')} AS hyp_words, {_words('truth')} AS ref_words
  FROM joined SEMI JOIN documents ON conv_id = doc_id),
errors AS (
  SELECT conv_id, conf, length(truth) AS n_chars, len(ref_words) AS n_words,
         {_distance('ocr_text', 'truth')} AS char_errors,
         {_distance("array_to_string(hyp_words, ' ')", "array_to_string(ref_words, ' ')")} AS word_errors
  FROM words)"""
_K = "regexp_extract(props, '([0-9]+)', 1)::INT"
_EN = f"{list(LABELS_EN)}"
_TOKENS = f"""tokens AS (
  SELECT *, {_EN}[gold_id + 1] AS gold, {_EN}[CASE WHEN pred_id < 0 THEN pred_id ELSE pred_id + 1 END] AS pred
  FROM (SELECT *, CASE WHEN k % 7 = 0 THEN (gold_id + 1) % 13 WHEN k % 11 = 0 THEN -1 ELSE gold_id END AS pred_id
        FROM (SELECT 'cv.' || user_id || '_page0' AS page_key, event_id AS pos, event_type, value, {_K} AS k,
                     CASE event_type WHEN 'view' THEN 7 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 11
                       WHEN 'error' THEN 6 WHEN 'click' THEN 12 END AS gold_id
              FROM events)))"""


def _chunks(label: str, mode: str) -> str:
    single = f"OR {label}[1] IN ('B', 'S', 'E')" if mode == "compat" else ""
    outside = f"WHERE {label}[1] <> 'O'" if mode == "compat" else ""
    return f"""(SELECT page_key, type, min(pos) AS start, max(pos) AS "end"
      FROM (SELECT page_key, pos, {label} AS type, sum(opens) OVER (PARTITION BY page_key ORDER BY pos) AS nr
            FROM (SELECT *, CASE WHEN {label} IS DISTINCT FROM lag({label}) OVER (PARTITION BY page_key ORDER BY pos)
                    {single} THEN 1 ELSE 0 END AS opens FROM tokens)
            {outside})
      GROUP BY page_key, type, nr)"""


def _prf(mode: str) -> str:
    return f"""SELECT n_gold::BIGINT AS n_gold, n_pred::BIGINT AS n_pred, n_match::BIGINT AS n_match,
      round(n_match / n_pred, 6) AS "precision", round(n_match / n_gold, 6) AS recall,
      round(2 * (n_match / n_pred) * (n_match / n_gold) / (n_match / n_pred + n_match / n_gold), 6) AS f1,
      n_tokens, n_right, round(n_right / n_tokens, 6) AS accuracy, '{mode}' AS mode
    FROM (SELECT (SELECT count(*) FROM gold_{mode})::DOUBLE AS n_gold, (SELECT count(*) FROM pred_{mode})::DOUBLE AS n_pred,
      (SELECT count(*) FROM gold_{mode} JOIN pred_{mode} USING (page_key, type, start, "end"))::DOUBLE AS n_match,
      (SELECT count(*) FROM tokens) AS n_tokens, (SELECT count(*) FROM tokens WHERE gold = pred) AS n_right)"""


def _ordered(seed: str, size: str, source: str = "documents", key: str = "doc_id") -> str:
    return f"""SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || {key}), {key}) AS place,
      {size} AS size FROM {source}"""


_CEIL = "ceil(count(*) OVER () * 0.1::DOUBLE)"
_SIMILAR = """near_pairs AS (
  SELECT a.vec_id, (a.label = b.label)::INT::DOUBLE AS target,
         list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS cosine
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""
_SCORED = f"scored AS (SELECT event_type, value / 500 AS pred, {_K}::DOUBLE / 100 AS gold FROM events)"


def _rank(x: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    same = f"PARTITION BY {by}, {x}" if by else f"PARTITION BY {x}"
    return f"rank() OVER ({part} ORDER BY {x}) + (count(*) OVER ({same}) - 1) / 2"


_STEPS = f"""steps AS (SELECT dayofmonth(ts)::INT - 1 AS epoch, event_id AS step, event_type, value,
  {_K}::DOUBLE / 100 AS share FROM events)"""
_CANDIDATES = """candidates AS (
  SELECT source AS job_title, doc_id AS resume_id,
         quality * 0.5::DOUBLE - toxic * 0.25::DOUBLE + n_chars::DOUBLE / 100000 AS score
  FROM documents JOIN labels USING (doc_id)),
scaled AS (
  SELECT *, CASE WHEN max(score) OVER w = min(score) OVER w THEN 0::DOUBLE
    ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS normalized
  FROM candidates WINDOW w AS (PARTITION BY job_title)),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_title ORDER BY score DESC, resume_id) AS rank FROM scaled)
  WHERE rank <= 5)"""
_RESPONSES = """responses AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN '无法评分' || chr(10) || '理由。' ELSE
    '编号 ' || event_id || '，匹配度：0.' || lpad(regexp_extract(props, '([0-9]+)', 1), 2, '0') || chr(10) || '理由：' ||
    CASE event_type WHEN 'click' THEN '经验不足，缺乏技能。' WHEN 'view' THEN '技能缺乏。' ELSE '经验相关。' END ||
    ' v7.5，共 ' || (user_id + 2) || ' 项' || chr(10) || ' 75% ' END AS response,
    CASE WHEN user_id % 10 <> 0 THEN regexp_extract(props, '([0-9]+)', 1)::DOUBLE / 100 END AS true_score
  FROM events)"""


def _last_unit(x: str) -> str:
    numbers = f"list_transform(regexp_extract_all({x}, '{text.NUMBER}', 1), lambda v: try_cast(v AS DOUBLE))"
    return f"list_filter({numbers}, lambda v: v >= 0 AND v <= 1)[-1]"


def _reason(x: str) -> str:
    return _strip(f"regexp_extract({x}, '{text.REASON}', 0)")


def _soften(score: str, x: str) -> str:
    softer = x
    for term, better in text.SOFTER_TERMS.items():
        softer = f"replace({softer}, '{term}', '{better}')"
    harsh = " OR ".join(f"contains({x}, '{term}')" for term in text.SOFTER_TERMS)
    return f"CASE WHEN {score} = 0 AND ({harsh}) THEN {softer} || {_text(text.SOFTER_CLOSING)} ELSE {x} END"


_KEY = _re2(text.SCORE_KEY)
_GENERATED = f"""generated AS (
  SELECT conv_id * 100 + turn AS id, CASE WHEN conv_id % 2 = 0 THEN '' ELSE text || chr(10) || '{{ ' END ||
    {" || ".join(f'''CASE WHEN turn % 4 >= {n} THEN '"score" :' || chr(10) || ' ' || number || ',' || chr(10) || '"reason": "{n} ' || text || '"' || chr(10) ELSE '' END''' for n in (1, 2, 3))} AS t
  FROM (SELECT *, CASE WHEN conv_id % 5 = 0 THEN '1.2.3' WHEN conv_id % 7 = 0 THEN '.'
    ELSE '0.' || turn || (conv_id % 10) END AS number FROM conversations)),
cut AS (
  SELECT id, t, regexp_split_to_array(t, '{_KEY}') AS pieces, regexp_extract_all(t, '{_KEY}') AS keys FROM generated),
cleaned AS (
  SELECT id, {_strip("CASE WHEN len(keys) >= 2 THEN keys[2] || pieces[3] ELSE t END")} AS generated_output FROM cut),
judged AS (
  SELECT *, coalesce(try_cast(nullif(regexp_extract(generated_output, '{_re2(text.SCORE_VALUE)}', 1), '') AS DOUBLE), -1) AS score
  FROM cleaned)"""
_PROMPT = {
    True: text.PROMPT_HEAD + text.PROMPT_CRITERIA + text.PROMPT_FORMAT,
    False: text.PROMPT_HEAD + text.PROMPT_FORMAT,
}


def _prompt(instruction: str, input_: str, criteria: bool = True) -> str:
    return (
        f"{_text(_PROMPT[criteria])} || {input_} || {_text(text.PROMPT_RESUME)} || {instruction} || {_text(text.PROMPT_END)}"
    )


_RECORDS = f"""{_CANDIDATES},
records AS (
  SELECT row_number() OVER (ORDER BY resume_id) - 1 AS id, resume_id, d.text AS instruction, b.text AS input
  FROM best JOIN benchmark b ON job_title = 'src' || item_id JOIN documents d ON d.doc_id = resume_id)"""
_TEXTS = """texts AS (
  SELECT doc_id, '岗位描述：' || b.text || chr(10) || '简历内容：' ||
    CASE WHEN lang = 'fr' THEN '' ELSE d.text || chr(10) || chr(10) END || 'Education: School ' || doc_id ||
    chr(10) || chr(10) || 'Work Experience: ' || d.text || chr(10) || chr(10) || 'Projects: ' ||
    chr(10) || chr(10) || 'Skills: ' || lang || '; ' || source || '; office' ||
    chr(10) || chr(10) || 'Certifications: ' || CASE WHEN lang = 'de' THEN 'DIN' ELSE '' END ||
    chr(10) || chr(10) || 'Languages: ' || lang AS input,
    '匹配度：0.' || lpad((doc_id % 100)::VARCHAR, 2, '0') || chr(10) || '理由：ok ' || lang AS output
  FROM documents d JOIN benchmark b ON source = 'src' || item_id)"""


_SECTIONS = r"(?s)\A" + text.RECORD_START + "".join(f"(.*?){header}" for header in text.SECTION_STARTS) + r"(.*)\z"


def _section(i: int) -> str:
    return f"CASE WHEN regexp_matches(input, {_text(_SECTIONS)}) THEN regexp_extract(input, {_text(_SECTIONS)}, {i}) END"


def _scrubbed(x: str = "text") -> str:
    def digest(kind):
        return f"md5('42:' || doc_id || ':{kind}')"

    def digits(kind):
        return f"translate({digest(kind)}, 'abcdef', '012345')"

    made = {
        "email": f"'user_' || substr({digest('email')}, 1, 8) || '@example.com'",
        "number": f"'#' || substr({digits('number')}, 1, 8)",
        "ip": f"'192.0.2.' || substr({digits('ip')}, 1, 1)",
        "phone": f"'555-01' || substr({digits('phone')}, 1, 2)",
    }
    patterns = {
        "email": r"[\w.%+-]+@[a-zA-Z\d-]+(?:\.[a-zA-Z\d-]+)+",
        "number": r"\d{12,}|(?:\d{4}[ -]?){3}\d{1,7}",
        "ip": r"\d{1,3}(?:\.\d{1,3}){3}",
        "phone": r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}",
    }
    for kind, pattern in patterns.items():
        x = f"regexp_replace({x}, '{pattern}', {made[kind]}, 'g')"
    return x


def _terms(x: str) -> str:
    return rf"list_distinct(list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> ''))"


_PAIR_TERMS = f"""pairs AS (
  SELECT doc_id, job_title, len(a)::DOUBLE AS na, len(b)::DOUBLE AS nb, len(list_intersect(a, b))::DOUBLE AS both_
  FROM (SELECT doc_id, source AS job_title, {_terms('d.text')} AS a, {_terms('b.text')} AS b
        FROM documents d JOIN labels USING (doc_id) JOIN benchmark b ON source = 'src' || item_id))"""
_PAIR_NUMBERS = {
    "binary_cosine": "coalesce(both_ / nullif(sqrt(na * nb), 0), 0)", "coverage_a": "coalesce(both_ / nullif(na, 0), 0)",
    "coverage_b": "coalesce(both_ / nullif(nb, 0), 0)", "length_ratio": "coalesce(least(na, nb) / nullif(greatest(na, nb), 0), 0)",
}
_SPLIT = f"split AS (SELECT doc_id, place, size FROM ({_ordered('42', _CEIL, source='pairs')}))"


ORACLE = {
    "q01_ocr_assemble": f"""WITH {_ASSEMBLED}
        SELECT 'scan_' || doc_id || '.pdf' AS file, coalesce(ocr_text, '') AS ocr_text,
               round(coalesce(conf, 0), 6) AS avg_conf, coalesce(n, 0) AS n_lines
        FROM documents LEFT JOIN joined ON conv_id = doc_id""",
    "q02_ocr_doc_error": f"""WITH {_DOC_ERRORS}
        SELECT 'scan_' || conv_id || '.pdf' AS file, conv_id::VARCHAR AS id, n_chars, n_words, char_errors, word_errors,
               round(char_errors / greatest(1, n_chars), 6) AS cer, round(word_errors / greatest(1, n_words), 6) AS wer
        FROM errors""",
    "q03_ocr_summary": f"""WITH {_DOC_ERRORS},
        total AS (SELECT count(*) AS n_docs, sum(char_errors)::DOUBLE / greatest(1, sum(n_chars)) AS cer,
                         sum(word_errors)::DOUBLE / greatest(1, sum(n_words)) AS wer,
                         sum(conf) / greatest(1, count(*)) AS confidence FROM errors)
        SELECT n_docs, round(cer, 6) AS cer, round(wer, 6) AS wer, round(1 - cer, 6) AS char_accuracy,
               round(1 - wer, 6) AS word_accuracy, round(confidence, 6) AS confidence,
               printf('%.2f%%', cer * 100) AS cer_pct, printf('%.2f%%', wer * 100) AS wer_pct,
               printf('%.2f%%', (1 - cer) * 100) AS char_accuracy_pct,
               printf('%.2f%%', (1 - wer) * 100) AS word_accuracy_pct,
               printf('%.2f%%', confidence * 100) AS confidence_pct
        FROM total""",
    "q04_label_encode": """SELECT doc_id, lang,
          CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE -1 END::INT AS id_strict,
          CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END::INT AS id_other,
          CASE WHEN lang IN ('en', 'fr') THEN lang ELSE 'de' END AS read_back
        FROM documents""",
    "q05_bbox_normalize": """WITH b AS (
          SELECT l_partkey AS page_key, l_orderkey, l_linenumber, l_quantity * 20 - 100 AS x1, l_extendedprice / 100 AS y1,
                 l_quantity * 20 - 100 + 300.5::DOUBLE AS x2, l_extendedprice / 100 + 40.25::DOUBLE AS y2,
                 p_size::DOUBLE * 20 AS w, p_retailprice AS h
          FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <> 0 AND p_retailprice <> 0)
        SELECT page_key, l_orderkey, l_linenumber,
          array_to_string(list_transform([x1 / w, y1 / h, x2 / w, y1 / h, x2 / w, y2 / h, x1 / w, y2 / h],
            lambda v: greatest(0, least(1000, trunc(1000 * v)))::INT), ',') AS norm8,
          array_to_string(list_transform([trunc(x1) / w, trunc(y1) / h, trunc(x2) / w, trunc(y2) / h],
            lambda v: greatest(0, least(1000, trunc(1000 * v)))::INT), ',') AS norm4
        FROM b""",
    "q06_page_sequences": f"""WITH {_TOKENS},
        placed AS (SELECT *, row_number() OVER (PARTITION BY page_key ORDER BY pos) - 1 AS place FROM tokens)
        SELECT page_key, floor(place / 32)::BIGINT AS chunk, count(*) AS n_tokens,
               string_agg(pos::VARCHAR, ',' ORDER BY pos) AS positions,
               string_agg(event_type, ',' ORDER BY pos) AS tokens
        FROM placed GROUP BY page_key, floor(place / 32)::BIGINT""",
    "q07_sequence_pack": f"""WITH {_TOKENS},
        pages AS (SELECT page_key, list(k ORDER BY pos) AS ks, list(gold_id ORDER BY pos) AS gs,
                         range(1, 65) AS places, count(*) AS n FROM tokens GROUP BY page_key)
        SELECT page_key,
          array_to_string(list_transform(places, lambda i: CASE WHEN i <= n THEN ks[i] ELSE 0 END), ',') AS input_ids,
          array_to_string(list_transform(places, lambda i: CASE WHEN i <= n THEN gs[i] ELSE -100 END), ',') AS labels,
          array_to_string(list_transform(places, lambda i: CASE WHEN i <= n THEN ks[i] || ',' || gs[i] ELSE '0,0' END), ',') AS bbox,
          array_to_string(list_transform(places, lambda i: CASE WHEN i <= n THEN 1 ELSE 0 END), ',') AS attention_mask
        FROM pages""",
    "q08_argmax_mask": """SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS pred, label AS gold
        FROM embeddings WHERE label <> 9""",
    "q09_token_accuracy": f"""WITH {_TOKENS}
        SELECT count(*) AS n_tokens, count(*) FILTER (gold = pred) AS n_right,
               round(avg((gold = pred)::INT), 6) AS accuracy FROM tokens""",
    "q10_entity_prf": f"""WITH {_TOKENS},
        gold_compat AS {_chunks('gold', 'compat')}, pred_compat AS {_chunks('pred', 'compat')},
        gold_runs AS {_chunks('gold', 'runs')}, pred_runs AS {_chunks('pred', 'runs')}
        {_prf('compat')} UNION ALL {_prf('runs')}""",
    "q10b_match_chunks": f"""WITH {_TOKENS},
        g AS {_chunks('gold', 'compat')}, p AS {_chunks('pred', 'compat')}
        SELECT page_key, type, start, "end" FROM g JOIN p USING (page_key, type, start, "end")""",
    "q11_split_exact": f"""SELECT doc_id, place <= size AS is_validation FROM ({_ordered('42', _CEIL)})""",
    "q12_holdout_sample": f"""SELECT doc_id, source
        FROM ({_ordered('1234', 'round_even(count(*) OVER () * 0.1::DOUBLE, 0)')}) WHERE place <= size""",
    "q12b_shuffle_rows": """SELECT doc_id, row_number() OVER (ORDER BY md5('3:42:' || doc_id), doc_id) - 1 AS position
        FROM documents""",
    "q12c_eval_limit": f"""SELECT doc_id, source FROM ({_ordered('42', _CEIL)})
        WHERE place <= size ORDER BY doc_id LIMIT 40""",
    "q13_cosine_pairs": f"WITH {_SIMILAR} SELECT vec_id, target, round(cosine, 6) AS cosine FROM near_pairs",
    "q13b_cosine_loss": f"""WITH {_SIMILAR}
        SELECT round(avg((cosine - target) ** 2), 6) AS mse, round(1 - avg(cosine), 6) AS cosine_loss,
               round(avg((cosine - target) ** 2) + 1 - avg(cosine), 6) AS loss FROM near_pairs""",
    "q13c_mean_pool": """SELECT label, dim, round(avg(v), 6) AS value
        FROM (SELECT label, unnest(embedding::DOUBLE[]) AS v, unnest(range(len(embedding)))::INT AS dim FROM embeddings)
        GROUP BY label, dim""",
    "q14_pair_metrics": f"""WITH {_SCORED},
        ranked AS (SELECT *, {_rank('pred')} AS rp, {_rank('gold')} AS rt FROM scored)
        SELECT count(*) AS n, round(avg((pred - gold) ** 2), 6) AS mse, round(avg(abs(pred - gold)), 6) AS mae,
               round(corr(pred, gold), 6) AS pearson, round(corr(rp, rt), 6) AS spearman FROM ranked""",
    "q15_spearman_by_group": f"""WITH {_SCORED},
        ranked AS (SELECT *, {_rank('pred', 'event_type')} AS rp, {_rank('gold', 'event_type')} AS rt FROM scored)
        SELECT event_type, round(corr(rp, rt), 6) AS spearman FROM ranked GROUP BY event_type""",
    "q15b_average_ranks": f"""WITH {_SCORED}
        SELECT event_type, pred, count(*) AS n, min(r)::DOUBLE AS rank
        FROM (SELECT *, {_rank('pred', 'event_type')} AS r FROM scored) GROUP BY event_type, pred""",
    "q16_best_epoch": f"""WITH {_STEPS}, epochs AS (SELECT epoch, avg(value) AS metric FROM steps GROUP BY epoch)
        SELECT (epoch + 1)::INT AS epoch, round(metric, 6) AS metric, mode FROM (
          SELECT *, 'max' AS mode, row_number() OVER (ORDER BY metric DESC, epoch) AS place FROM epochs UNION ALL
          SELECT *, 'min' AS mode, row_number() OVER (ORDER BY metric, epoch) AS place FROM epochs) WHERE place = 1""",
    "q17_metric_log": f"""WITH {_STEPS}
        SELECT epoch::DOUBLE AS epoch, step, CASE WHEN event_type = 'click' THEN value END AS train_loss,
               CASE WHEN event_type = 'view' THEN value END AS eval_loss, NULL::DOUBLE AS "precision", NULL::DOUBLE AS recall,
               CASE WHEN event_type = 'view' THEN share END AS f1, CASE WHEN event_type = 'view' THEN share END AS accuracy
        FROM steps WHERE event_type IN ('click', 'view')""",
    "q18_epoch_mean_loss": f"""WITH {_STEPS}
        SELECT epoch, round(avg(value), 6) AS mean_value, round(avg(share), 6) AS mean_share FROM steps GROUP BY epoch""",
    "q19_topk_minmax": f"""WITH {_CANDIDATES}
        SELECT job_title, resume_id, '/out/resume.' || resume_id || '_train.png' AS source_file,
               round(normalized, 6) AS normalized_score, rank FROM best""",
    "q19b_minmax_all": f"""WITH {_CANDIDATES}
        SELECT job_title, resume_id, round(score, 6) AS score, round(normalized, 6) AS normalized_score FROM scaled""",
    "q20_coarse_to_fine": f"""WITH {_CANDIDATES}
        SELECT job_title, resume_id, round(normalized, 6) AS normalized_score, rank, text AS job_text
        FROM best JOIN benchmark ON job_title = 'src' || item_id""",
    "q21_render_prompt": f"""WITH {_RECORDS}
        SELECT id, resume_id, length({_prompt('instruction', 'input')}) AS n_chars,
               md5({_prompt('instruction', 'input')}) AS prompt_md5,
               md5({_prompt('instruction', 'input', False)}) AS short_md5 FROM records""",
    "q22_extract_score": f"""WITH {_RESPONSES}
        SELECT event_id, {_last_unit('response')} AS score, {_reason('response')} AS reason FROM responses""",
    "q23_floor_soften": f"""WITH {_RESPONSES}, scored AS (SELECT *, {_last_unit('response')} AS s FROM responses)
        SELECT event_id, CASE WHEN s = 0 THEN 0.4::DOUBLE ELSE s END AS score, {_soften('s', 'response')} AS response FROM scored""",
    "q24_clean_generated": f"WITH {_GENERATED} SELECT id, generated_output, score FROM judged",
    "q25_score_report": f"""WITH {_GENERATED}
        SELECT id, 'ID: ' || id || chr(10) || 'Score: ' || CASE WHEN score = -1 THEN '-1' ELSE score::VARCHAR END || chr(10) ||
               'Generated Output:' || chr(10) || generated_output || chr(10) || repeat('-', 80) AS block
        FROM judged ORDER BY id""",
    "q26_valid_failed": f"""WITH {_RESPONSES}, s AS (SELECT *, {_last_unit('response')} AS pred_score FROM responses)
        SELECT count(*) AS n_rows, count(*) FILTER (pred_score IS NOT NULL AND true_score IS NOT NULL) AS n_valid,
               count(*) FILTER (pred_score IS NULL OR true_score IS NULL) AS n_failed FROM s""",
    "q26b_failed_rows": f"""WITH {_RESPONSES}, s AS (SELECT *, {_last_unit('response')} AS pred_score FROM responses)
        SELECT event_id, response, true_score, pred_score FROM s WHERE pred_score IS NULL OR true_score IS NULL""",
    "q27_parse_sections": f"""WITH {_TEXTS}
        SELECT doc_id, {", ".join(f"{_section(i)} AS {name}" for i, name in enumerate(text.SECTION_FIELDS, 1))},
               regexp_extract(output, '{text.TARGET_SCORE}', 1)::DOUBLE AS score,
               {_strip(f"regexp_extract(output, '{text.TARGET_REASON}', 1)")} AS reason FROM texts""",
    "q28_item_counts": f"""WITH {_TEXTS}, items AS (SELECT unnest(string_split({_section(6)}, '; ')) AS item FROM texts)
        SELECT item, count(*) AS n FROM items WHERE item <> '' GROUP BY item""",
    "q29_scrub_pii": f"SELECT doc_id, {_scrubbed()} AS text FROM documents",
    "q29b_sample_source": """SELECT doc_id, n_chars FROM documents WHERE source = 'src0'
        ORDER BY md5('42:' || doc_id), doc_id LIMIT 20""",
    "q30_union_sources": """SELECT source, count(*) AS n_records FROM (
          SELECT 'documents' AS source FROM documents UNION ALL SELECT 'conversations' FROM conversations
          UNION ALL SELECT 'benchmark' FROM benchmark) GROUP BY ROLLUP (source)""",
    "q31_pending_outputs": r"""WITH listed AS (
          SELECT page_id, url LIKE 'https%' AS https, regexp_extract(url, '(\p{Nd}+)', 1) AS first_int,
                 regexp_replace(url, '^https?://', '/out/') AS p FROM pages),
        named AS (
          SELECT *, CASE WHEN regexp_matches(p, '([^/]*[^./][^/]*)(\.[^./]*)$')
            THEN regexp_replace(p, '([^/]*[^./][^/]*)(\.[^./]*)$', '\1_train\2') ELSE p || '_train' END AS out_path FROM listed)
        SELECT out_path, page_id, first_int FROM named
        WHERE NOT EXISTS (SELECT 1 FROM named d WHERE d.https AND d.out_path = named.out_path)""",
    "q32_pair_model": f"""WITH {_PAIR_TERMS}, {_SPLIT}
        SELECT 0 AS epoch, 0::DOUBLE AS penalty, count(*) AS n, 0::DOUBLE AS mse, 0::DOUBLE AS mae, 1::DOUBLE AS pearson,
               1::DOUBLE AS spearman FROM pairs JOIN split USING (doc_id) WHERE place <= size""",
    "q32b_pair_features": f"""WITH {_PAIR_TERMS}
        SELECT doc_id, job_title, {", ".join(f"round({x}, 6) AS {n}" for n, x in _PAIR_NUMBERS.items())} FROM pairs""",
    "q32c_pair_scores": f"""WITH {_PAIR_TERMS}, {_SPLIT}
        SELECT doc_id, round(0.1 + 0.5 * {_PAIR_NUMBERS["binary_cosine"]} + 0.3 * {_PAIR_NUMBERS["length_ratio"]}, 4) AS predicted_score
        FROM pairs JOIN split USING (doc_id) WHERE place <= size""",
    "q32d_residual_moments": f"""WITH {_PAIR_TERMS}
        SELECT count(*) AS n, true AS no_mean, {", ".join(f"true AS no_{n}" for n in _PAIR_NUMBERS)} FROM pairs""",
    "q33_field_tagger": f"""WITH {_TOKENS.replace("tokens AS", "every_token AS", 1)},
        pages AS (SELECT page_key, row_number() OVER (ORDER BY md5('42:' || page_key), page_key) AS place,
                         ceil(count(*) OVER () * 0.1::DOUBLE) AS size FROM (SELECT DISTINCT page_key FROM every_token)),
        tokens AS (SELECT page_key, pos, gold, gold AS pred FROM every_token JOIN pages USING (page_key) WHERE place <= size),
        gold_compat AS {_chunks('gold', 'compat')}, pred_compat AS {_chunks('pred', 'compat')}
        SELECT * EXCLUDE (mode) FROM ({_prf('compat')})""",
    "q34_incremental_files": "SELECT doc_id, source, length(text) AS n_chars FROM documents",
    "q35_batch_infer": """SELECT doc_id, CASE WHEN NOT contains(text, '|') THEN len(string_split(text, ' ')) END AS value,
          CASE WHEN contains(text, '|') THEN 'ValueError: separator in text' END AS error FROM documents""",
    "q35b_split_inferred": """SELECT doc_id, CASE WHEN NOT contains(text, '|') THEN len(string_split(text, ' ')) END AS value,
          CASE WHEN contains(text, '|') THEN 'bad' ELSE 'good' END AS part FROM documents""",
    "q36_score_records": f"""WITH prompts AS (
          SELECT conv_id * 100 + turn AS id, {_prompt('text', 'role')} AS prompt,
                 '匹配度：0.' || turn || chr(10) || '理由：-' AS reference_output FROM conversations),
        answers AS (
          SELECT *, CASE WHEN length(prompt) % 13 = 0 THEN 'ValueError: no answer' END AS error, CASE WHEN length(prompt) % 13 <> 0 THEN {_strip("prompt || chr(10) || '匹配度：0.' || (length(prompt) % 7) || '0' || chr(10) || '理由：' || CASE WHEN length(prompt) % 3 <> 0 THEN '技能不足。' ELSE '经验相关。' END")} END AS answer
          FROM prompts),
        scored AS (SELECT *, {_last_unit('answer')} AS s FROM answers),
        done AS (SELECT *, {_soften('s', 'answer')} AS generated_output FROM scored)
        SELECT id, generated_output, reference_output, CASE WHEN s = 0 THEN 0.4::DOUBLE ELSE s END AS pred_score,
               {_last_unit('reference_output')} AS true_score, {_reason('generated_output')} AS reason_only, error FROM done""",
}
