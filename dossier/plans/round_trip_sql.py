"""The round-trip queries in DuckDB SQL: what the files must give back."""

from __future__ import annotations

from dossier.plans import oracle as base

_TOKENS = base._TOKENS

ORACLE = {
    "q37_instruction_files": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, text AS instruction,
          CASE WHEN lang = 'fr' THEN '' ELSE lang END AS input, source AS output FROM documents""",
    "q38_truth_files": """SELECT (doc_id % 600)::VARCHAR AS id,
          CASE WHEN arg_max(doc_id, doc_id) % 50 = 0 THEN 'nan' ELSE arg_max(text, doc_id) END AS text
        FROM documents GROUP BY doc_id % 600""",
    "q38b_files_with_truth": """SELECT 'scan_' || doc_id || '.pdf' AS file, doc_id::VARCHAR AS id FROM documents
        WHERE doc_id IN (SELECT doc_id % 600 FROM documents)""",
    "q39_labeled_flat": f"""WITH {_TOKENS},
        placed AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS spot,
                          row_number() OVER (PARTITION BY page_key ORDER BY pos) - 1 AS place FROM tokens)
        SELECT page_key AS file_name, floor(place / 32)::BIGINT AS chunk, count(*) AS n_tokens,
               string_agg(spot::VARCHAR, ',' ORDER BY spot) AS positions, string_agg(event_type, ',' ORDER BY spot) AS tokens,
               string_agg(gold, ',' ORDER BY spot) AS labels
        FROM placed GROUP BY page_key, floor(place / 32)::BIGINT""",
    "q39b_labeled_nested": f"""WITH {_TOKENS}
        SELECT page_key AS image, (row_number() OVER (PARTITION BY page_key ORDER BY pos) - 1)::INT AS pos, event_type AS text,
               array_to_string([value, k::DOUBLE], ',') AS bbox, gold AS label FROM tokens""",
    "q40_sequence_files": base.ORACLE["q07_sequence_pack"],
    "q41_prediction_files": """SELECT ' ' || text || '," ' || chr(10) AS text_a, source AS text_b, (doc_id % 7)::DOUBLE / 4 AS label
        FROM documents""",
    "q42_result_files": f"""WITH done AS ({base.ORACLE["q36_score_records"]})
        SELECT id, pred_score, true_score, reason_only, error, 'all' AS part FROM done UNION ALL
        SELECT id, pred_score, true_score, reason_only, error, 'failed' FROM done WHERE pred_score IS NULL OR true_score IS NULL""",
    "q43_report_files": f"WITH {base._GENERATED} SELECT id, score, generated_output FROM judged",
    "q44_metric_appends": base.ORACLE["q17_metric_log"],
    "q45_epoch_log_file": base.ORACLE["q18_epoch_mean_loss"],
    "q46_scanned_files": """SELECT 'docs' AS source, 2 * count(*) AS n_lines, 2 * sum(length(doc_id::VARCHAR) + 1)::BIGINT AS n_bytes FROM documents
        UNION ALL SELECT unnest(['items', 'pdf']), count(*), sum(length(item_id::VARCHAR) + 1)::BIGINT FROM benchmark""",
    "q47_incremental_twice": base.ORACLE["q34_incremental_files"],
    "q48_split_overlap": f"""WITH t AS ({base._ordered('42', base._CEIL)}),
        h AS ({base._ordered('1234', 'round_even(count(*) OVER () * 0.1::DOUBLE, 0)')})
        SELECT count(*) AS n_holdout, count(*) FILTER (t.place > t.size) AS n_overlap
        FROM h JOIN t USING (doc_id) WHERE h.place <= h.size""",
    "q49_polygon_envelope": """SELECT l_orderkey, l_linenumber,
          array_to_string([round(v, 4) FOR v IN [l_quantity, least(l_extendedprice / 100, l_extendedprice / 100 - 1),
            l_quantity + 3, l_extendedprice / 100 + l_linenumber]], ',') AS box FROM lineitem""",
    "q50_exact_numbers": """WITH k AS (SELECT doc_id, text, CASE WHEN doc_id % 5 <> 0 THEN doc_id * 2 + 9007199254740993 END AS key FROM documents)
        SELECT doc_id, key, CASE WHEN key % 7 <> 0 THEN key + length(text) END AS value,
               CASE WHEN key % 7 = 0 THEN 'ValueError: seven' END AS error FROM k""",
    "q51_scrub_long_numbers": f"""SELECT doc_id, {base._scrubbed("t")} AS text FROM (
          SELECT doc_id, text || ' no ' || substr(repeat((doc_id + 1234567)::VARCHAR, 8), 1, (12 + doc_id % 29)::INT) || '.' AS t FROM documents)""",
}
