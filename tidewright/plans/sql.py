"""The engine's queries in SQL (DuckDB), written for themselves."""

from __future__ import annotations

from tidewright.functions.text import SPACE_POINTS
from tidewright.operators.retention import FAMILIES

_SPACE = "||".join(f"chr({c})" for c in SPACE_POINTS)

BASE = f"""
WITH units AS (
  SELECT sha256('classify||' || row_id || '||' || field_name || '||' || output_column || '||stub-1||v1') AS unit_id, *, 'stub-1' AS model, 'classify' AS step_name, 'v1' AS prompt_version
  FROM (
    SELECT CAST(doc_id AS VARCHAR) AS row_id, f AS field_name, trim(CASE f WHEN 'text' THEN text ELSE lang END, {_SPACE}) AS input_text, f || '_label' AS output_column
    FROM documents, unnest(['text', 'lang']) AS u(f)
  ) WHERE input_text <> ''
), asked AS (
  SELECT units.*, k AS attempt, substr(unit_id, k, 1) AS digit FROM units, unnest([1, 2, 3]) AS v(k)
  WHERE (k < 2 OR substr(unit_id, 1, 1) IN ('0', '1', '2')) AND (k < 3 OR substr(unit_id, 2, 1) IN ('0', '1', '2'))
), log AS (
  SELECT *, CASE WHEN digit = '0' THEN 'invalid_score_output' WHEN digit IN ('1', '2') THEN 'rate_limit' END AS error_type,
    CASE WHEN digit IN ('0', '1', '2') THEN 'retryable_error' ELSE 'success' END AS status,
    CASE WHEN digit IN ('0', '1', '2') THEN attempt ELSE attempt - 1 END::BIGINT AS retry_count,
    CASE WHEN digit IN ('0', '1', '2') THEN 'attempt ' || attempt || ' failed' END AS error_message,
    CASE WHEN digit NOT IN ('0', '1', '2') THEN CAST(length(input_text) % 7 AS VARCHAR) END AS output_value,
    '2026-01-0' || attempt || 'T00:00:00+00:00' AS updated_at, attempt::BIGINT AS seq
  FROM asked
), limited AS (
  SELECT unit_id, CASE WHEN hit THEN 'permanent_error' ELSE status END AS status, retry_count,
    CASE WHEN hit THEN error_type || '|max_request_retries_exhausted' ELSE error_type END AS last_error_type,
    CASE WHEN hit THEN error_message || ' [no usable answer, made permanent after ' || retry_count || ' retries, limit 2]' ELSE error_message END AS last_error_message,
    updated_at, seq, row_id, field_name
  FROM (SELECT *, coalesce(error_type = 'invalid_score_output' AND retry_count >= 2, false) AS hit FROM log)
), progress AS (
  SELECT * FROM limited QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY seq DESC) = 1
), results AS (
  SELECT unit_id, row_id, output_column, status, output_value, output_value = '0' AS review_flag, seq FROM log WHERE status = 'success'
), wide AS (
  SELECT row_id, max(output_value) FILTER (output_column = 'text_label') AS text_label, max(output_value) FILTER (output_column = 'lang_label') AS lang_label FROM results GROUP BY row_id
), counts AS (
  SELECT units.row_id, count(*) AS expected, count_if(progress.status = 'success') AS good, count_if(progress.status = 'permanent_error') AS dead, count_if(progress.status = 'retryable_error') AS retry
  FROM units JOIN progress ON units.unit_id = progress.unit_id GROUP BY units.row_id
)
"""

LANES = """
WITH lanes AS (
  SELECT event_id, ts, event_type, user_id % 8 AS lane, floor(epoch_us(ts) / 1000000)::BIGINT AS sec, floor(value)::BIGINT AS tokens, value AS seconds FROM events
)
"""

NAMES = f"""
WITH names AS (
  SELECT ([{', '.join(repr(f) for f in FAMILIES)}])[(event_id % {len(FAMILIES)} + 1)::INT] AS family, event_id AS seq, '20260101_' || lpad((event_id % 40)::VARCHAR, 6, '0') AS run,
    ([{', '.join(repr(f) for f in FAMILIES)}])[(event_id % {len(FAMILIES)} + 1)::INT] || '__run_20260101_' || lpad((event_id % 40)::VARCHAR, 6, '0') || '__20260101_000000_' || lpad(event_id::VARCHAR, 6, '0') || '.parquet' AS name
  FROM events
)
"""

_STATUSES = "unnest(['success', 'retryable_error', 'permanent_error']) AS s(status)"
_FIELD = ", ".join(f"max(p.{c}) FILTER (p.field_name = '{f}') AS {f}__{c}" for f in ("text", "lang") for c in ("unit_id", "status", "retry_count", "last_error_type", "last_error_message"))

BREACHES = """
WITH said AS (
  SELECT event_id, (event_id // 20)::VARCHAR AS request_id, CASE WHEN event_id % 61 = 0 THEN 'odd' WHEN event_id % 67 = 0 THEN NULL ELSE 'success' END AS status, value FROM events
), answers AS (
  SELECT request_id, event_id::VARCHAR AS unit_id, status, CASE WHEN event_id % 71 <> 0 THEN value END AS v
  FROM said, unnest([1, 2, 3]) AS u(n) WHERE n <= CASE WHEN event_id % 41 = 0 THEN 0 WHEN event_id % 53 = 0 THEN 3 ELSE 1 END
  UNION ALL SELECT request_id, 'x' || event_id, status, value FROM said WHERE event_id % 83 = 0
), asked AS (
  SELECT (event_id // 20)::VARCHAR AS request_id, event_id::VARCHAR AS unit_id, count(*) AS asked FROM events GROUP BY ALL
), got AS (
  SELECT request_id, unit_id, count(*) AS answered, count_if(status IS NULL OR status NOT IN ('success', 'retryable_error', 'permanent_error') OR v IS NULL) AS malformed FROM answers GROUP BY ALL
), joined AS (
  SELECT coalesce(asked.request_id, got.request_id) AS request_id, coalesce(asked.unit_id, got.unit_id) AS unit_id, coalesce(asked, 0) AS asked, coalesce(answered, 0) AS answered,
    coalesce(malformed, 0)::BIGINT AS malformed
  FROM asked FULL JOIN got ON asked.request_id = got.request_id AND asked.unit_id = got.unit_id
), breaches AS (
  SELECT *, concat_ws(',', CASE WHEN malformed > 0 THEN 'malformed' END, CASE WHEN asked = 0 THEN 'unexpected' END, CASE WHEN answered > greatest(asked, 1) THEN 'repeated' END,
    CASE WHEN answered < asked THEN 'missing' END) AS problems FROM joined
)
"""

ORACLE_SQL = {
    "scan_projection": "SELECT doc_id, lang, source FROM documents",
    "row_window": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 50 OFFSET 10",
    "row_window_far": """SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS k, count(*) OVER () AS n FROM lineitem)
WHERE k > n * 9 // 10 AND k <= n * 9 // 10 + 500""",
    "work_units": BASE + "SELECT unit_id, row_id, field_name, input_text, output_column, model, step_name, prompt_version FROM units",
    "conversation_units": f"SELECT sha256('tone||' || conv_id || '-' || turn || '||text||tone||stub-1||v2') AS unit_id, conv_id || '-' || turn AS row_id, 'text' AS field_name, 'tone' AS output_column, 'v2' AS prompt_version FROM conversations WHERE trim(text, {_SPACE}) <> ''",
    "manifest": BASE + "SELECT unit_id, row_id, field_name, output_column, model, step_name, prompt_version, sha256(input_text) AS input_hash FROM units",
    "pending_units": BASE + "SELECT unit_id, row_id, field_name FROM units WHERE substr(unit_id, 1, 1) IN ('0', '1', '2')",
    "latest_progress": BASE + "SELECT unit_id, status, retry_count, error_type AS last_error_type, error_message AS last_error_message, updated_at, seq FROM log QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY seq DESC) = 1",
    "latest_results": BASE + "SELECT * EXCLUDE (status) FROM results",
    "latest_debug": BASE + "SELECT unit_id, status, error_type, output_value, seq FROM log QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY seq DESC) = 1",
    "schema_enforcement": "SELECT doc_id::VARCHAR AS unit_id, lang AS status, try_cast(source AS BIGINT) AS retry_count, NULL::VARCHAR AS last_error_type, NULL::VARCHAR AS last_error_message, NULL::VARCHAR AS updated_at, NULL::BIGINT AS seq FROM documents",
    "append_logs": "SELECT status, count(*) AS n, sum(retries)::BIGINT AS retries FROM (SELECT lang AS status, NULL AS retries FROM documents UNION ALL SELECT NULL, quality FROM labels) GROUP BY status",
    "reconcile_progress": BASE + """SELECT unit_id, CASE WHEN later THEN 'success' ELSE status END AS status, CASE WHEN later THEN 0 ELSE retry_count END AS retry_count, CASE WHEN NOT later THEN error_type END AS last_error_type, CASE WHEN NOT later THEN error_message END AS last_error_message, CASE WHEN later THEN '2026-01-09T00:00:00+00:00' ELSE updated_at END AS updated_at, CASE WHEN later THEN 9 ELSE seq END AS seq
FROM (SELECT *, status <> 'success' AND unit_id IN (SELECT unit_id FROM results) AS later FROM log WHERE seq = 1)""",
    "result_difference": BASE + "SELECT unit_id FROM results WHERE seq > 1",
    "retry_limit": BASE + "SELECT * EXCLUDE (row_id, field_name) FROM limited",
    "retry_counts": BASE + "SELECT field_name, retries AS retry_count, count(*) AS n FROM (SELECT u.unit_id, u.field_name, coalesce(max(l.retry_count) FILTER (l.retry_count > 0), 0) AS retries FROM units AS u JOIN log AS l ON u.unit_id = l.unit_id GROUP BY ALL) GROUP BY ALL",
    "terminal_units": BASE + "SELECT unit_id, status FROM progress WHERE status IN ('success', 'permanent_error')",
    "released_partial": BASE + "SELECT DISTINCT row_id FROM progress WHERE status = 'success'",
    "released_strict": BASE + "SELECT row_id FROM counts WHERE expected = good",
    "partial_output": BASE + "SELECT d.doc_id::VARCHAR AS doc_id, source, text_label, lang_label FROM documents AS d JOIN counts ON d.doc_id::VARCHAR = counts.row_id AND expected = good JOIN wide ON wide.row_id = counts.row_id",
    "pair_status": BASE + f"""SELECT counts.row_id, expected AS expected_unit_count, expected AS observed_unit_count, good AS success_unit_count, retry AS retryable_error_count, dead AS permanent_error_count, f.* EXCLUDE (row_id),
  good = expected AS row_success_complete, good + dead = expected AS row_terminal_complete,
  array_to_string(list_filter([CASE WHEN text__status = 'success' THEN NULL ELSE 'text' END, CASE WHEN lang__status = 'success' THEN NULL ELSE 'lang' END], lambda x: x IS NOT NULL), ',') AS blocked_fields, good = expected AS released_for_partial_output
FROM counts JOIN (SELECT row_id, {_FIELD} FROM progress AS p GROUP BY row_id) AS f ON counts.row_id = f.row_id""",
    "merge_back": BASE + "SELECT d.doc_id::VARCHAR AS doc_id, source, text_label, lang_label FROM documents AS d LEFT JOIN wide ON d.doc_id::VARCHAR = wide.row_id",
    "merge_back_typed": BASE + "SELECT d.doc_id::VARCHAR AS doc_id, source, text_label::BIGINT AS text_label, lang_label::DOUBLE AS lang_label FROM documents AS d LEFT JOIN wide ON d.doc_id::VARCHAR = wide.row_id",
    "run_outcome": BASE + "SELECT done AS processed_units, total - done AS remaining_units, total AS total_units FROM (SELECT (SELECT count(*) FROM units) AS total, (SELECT count(*) FROM results) AS done)",
    "run_metadata": BASE + """SELECT 'classify' AS step_name, 'complete' AS status, done AS processed_units_this_run, total - done AS remaining_units, total AS total_units, done AS completed_useful_units, ended AS completed_or_terminal_units, dead AS permanent_error_units, '2026-01-09T00:00:00+00:00' AS updated_at
FROM (SELECT (SELECT count(*) FROM units) AS total, (SELECT count(*) FROM results) AS done, (SELECT count(*) FROM progress WHERE status <> 'retryable_error') AS ended, (SELECT count(*) FROM progress WHERE status = 'permanent_error') AS dead)""",
    "status_histogram": BASE + f"SELECT s.status, (SELECT count(*) FROM progress AS p WHERE p.status = s.status) AS n FROM {_STATUSES}",
    "run_status_histogram": BASE + f"SELECT s.status, (SELECT count(*) FROM progress AS p WHERE p.status = s.status AND p.field_name = 'text') AS n FROM {_STATUSES}",
    "review_rows": BASE + "SELECT unit_id, status, CASE WHEN status <> 'success' THEN true ELSE true END AS review_flag, seq FROM log WHERE status <> 'success' OR output_value = '0'",
    "permanent_review": BASE + "SELECT unit_id, error_type, seq FROM log WHERE error_type = 'invalid_score_output' AND unit_id NOT IN (SELECT unit_id FROM results) QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY seq DESC) = 1",
    "checkpoint_rows": BASE + "SELECT unit_id, row_id, output_column, status, output_value, seq FROM results",
    "delta_replay": BASE + "SELECT unit_id, output_column, CASE WHEN seq = 1 THEN 'c' || output_value ELSE output_value END AS output_value, seq FROM results",
    "artifact_log": BASE + "SELECT unit_id, output_column, CASE WHEN seq <= 2 THEN 'c' || output_value ELSE output_value END AS output_value, seq FROM results",
    "result_fanout": BASE + "SELECT unit_id, output_column, output_value, 7::BIGINT AS seq FROM results UNION ALL SELECT unit_id, 'half', (output_value::INT * 2)::VARCHAR, 7 FROM results",
    "group_assignment": BASE + "SELECT unit_id, row_id, substr(unit_id, 1, 2) || '-' || ((row_number() OVER (PARTITION BY substr(unit_id, 1, 2) ORDER BY unit_id) - 1) // 4) AS group_id, (row_number() OVER (PARTITION BY substr(unit_id, 1, 2) ORDER BY unit_id) - 1) % 4 AS group_place FROM units",
    "token_estimate": BASE + "SELECT group_id, sum(length(input_text))::BIGINT AS chars, count(*) AS n, (ceil(sum(length(input_text)) / 4.0) + ceil(count(*) * 24.0) + 250)::BIGINT AS tokens FROM (SELECT *, substr(unit_id, 1, 2) || '-' || ((row_number() OVER (PARTITION BY substr(unit_id, 1, 2) ORDER BY unit_id) - 1) // 4) AS group_id FROM units) GROUP BY group_id",
    "rolling_tokens": LANES + "SELECT event_id, lane, sec, tokens, sum(tokens) OVER (PARTITION BY lane ORDER BY sec RANGE BETWEEN 59 PRECEDING AND CURRENT ROW)::BIGINT AS window_tokens FROM lanes",
    "shared_failures": LANES + "SELECT a.sec, count(DISTINCT b.lane) AS n_lanes FROM lanes AS a JOIN lanes AS b ON b.sec BETWEEN a.sec - 90 AND a.sec WHERE a.event_type = 'error' AND b.event_type = 'error' GROUP BY a.sec",
    "timeout_window": LANES + """SELECT event_id, lane, n AS sample_count, round(center, 4) AS center_seconds, round(least(greatest(10.0, center + greatest(5.0, 2 * dev)), 120.0), 3) AS limit_seconds
FROM (SELECT event_id, lane, count(*) OVER w::INT AS n, median(seconds) OVER w AS center, stddev_pop(seconds) OVER w AS dev FROM lanes WHERE seconds > 0 WINDOW w AS (PARTITION BY lane ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))""",
    "timeout_window_mad": LANES + """SELECT event_id, lane, len(x)::INT AS sample_count, round(list_median(list_transform(x, lambda v: abs(v - list_median(x)))), 4) AS spread_seconds
FROM (SELECT event_id, lane, list(seconds) OVER w AS x FROM lanes WHERE seconds > 0 WINDOW w AS (PARTITION BY lane ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))""",
    "timeout_window_one_lane": LANES + """SELECT event_id, n AS sample_count, round(center, 4) AS center_seconds, round(least(greatest(10.0, center + greatest(5.0, 2 * dev)), 120.0), 3) AS limit_seconds
FROM (SELECT event_id, count(*) OVER w::INT AS n, median(seconds) OVER w AS center, stddev_pop(seconds) OVER w AS dev FROM lanes WHERE seconds > 0
  WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))""",
    "moving_averages": LANES.replace("WITH", "WITH RECURSIVE") + """, both_lanes AS (
  SELECT event_id, lane, ts, seconds FROM lanes UNION ALL SELECT event_id, -1, ts, seconds FROM lanes
), numbered AS MATERIALIZED (
  SELECT event_id, lane::BIGINT AS lane, seconds, row_number() OVER (PARTITION BY lane ORDER BY ts, event_id) AS k FROM both_lanes WHERE seconds IS NOT NULL
), moved(k, event_id, lane, average) AS (
  SELECT k, event_id, lane, seconds FROM numbered WHERE k = 1
  UNION ALL
  SELECT n.k, n.event_id, n.lane, 0.3 * n.seconds + (1 - 0.3) * m.average FROM moved AS m JOIN numbered AS n ON n.lane = m.lane AND n.k = m.k + 1
)
SELECT event_id, lane, round(average, 6) AS average FROM moved""",
    "lane_totals": LANES + """SELECT sum(budget)::BIGINT AS load_budget, max(most) AS group_size FROM (
  SELECT lane, max(tokens) AS budget, max(n) AS most FROM (SELECT lane, sec // 60 AS minute, sum(tokens) AS tokens, count(*) AS n FROM lanes GROUP BY ALL) GROUP BY lane)""",
    "contract_breaches": BREACHES + "SELECT * FROM breaches WHERE problems <> ''",
    "broken_requests": BREACHES + "SELECT request_id, "
    + ", ".join(f"count_if(contains(problems, '{p}')) AS {p}" for p in ("malformed", "unexpected", "repeated", "missing"))
    + " FROM breaches WHERE problems <> '' GROUP BY request_id",
    "file_batch_stream": """SELECT doc_id::VARCHAR AS doc_id, regexp_replace(source, '[^\\p{L}\\p{N}_-]', '_', 'g') AS source, lang,
  CASE WHEN regexp_matches(id, '^[012]{3}') OR t = '' OR t IS NULL THEN NULL ELSE length(t) % 7 END::BIGINT AS label
FROM (SELECT doc_id, source, lang, regexp_replace(lang, '^\\s+|\\s+$', '', 'g') AS t, sha256('names||' || doc_id || '||lang||label||stub-1||v1') AS id FROM documents)""",
    "artifact_retention": NAMES + "SELECT name, family FROM names QUALIFY row_number() OVER (PARTITION BY family ORDER BY name DESC) > CASE family WHEN 'manifest' THEN 1 WHEN 'traces' THEN 5 ELSE 3 END",
    "run_retention": NAMES + "SELECT name, run FROM names QUALIFY dense_rank() OVER (ORDER BY run DESC) > 10",
    "delta_retention": NAMES + "SELECT name, seq FROM names WHERE family = 'results_delta' AND seq <= (SELECT min(seq) FROM (SELECT seq FROM names WHERE family = 'results_checkpoint' ORDER BY seq DESC LIMIT 3))",
    "final_retention": "SELECT name FROM (SELECT DISTINCT 'out_20260101_' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') || '.parquet' AS name FROM orders WHERE o_orderkey % 2 = 0) QUALIFY row_number() OVER (ORDER BY name DESC) > 3",
    "latest_artifact": NAMES + "SELECT family, max(name) AS name FROM names GROUP BY family",
    "artifact_runs": NAMES + "SELECT run, count(*) AS n FROM names GROUP BY run",
    "file_batches": "SELECT source, n, '-' || ((k - 1) // 3) AS group_id, (k - 1) % 3 AS group_place FROM (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source) AS k FROM documents GROUP BY source)",
    "safe_names": "SELECT p_partkey, regexp_replace(p_name, '[^\\p{L}\\p{N}_-]', '_', 'g') AS name FROM part",
    "resumable_step": "SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_regionkey, CASE WHEN regexp_matches(id, '^[012]{3}') THEN NULL ELSE length(n_name) % 7 END::BIGINT AS label FROM (SELECT *, sha256('names||' || n_nationkey || '||n_name||label||stub-1||v1') AS id FROM nation)",
    "resumable_documents": BASE + """SELECT doc_id::VARCHAR AS doc_id, source, CASE WHEN regexp_matches(id, '^[012]{3}') OR t = '' OR t IS NULL THEN NULL ELSE length(t) % 7 END::BIGINT AS label
FROM (SELECT doc_id, source, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t, sha256('names||' || doc_id || '||text||label||stub-1||v1') AS id FROM documents)""",
    "flagship": BASE + "SELECT lang, quality, count(*) AS n, count(text_label) AS answered, sum(text_label::BIGINT)::BIGINT AS text_sum, sum(lang_label::BIGINT)::BIGINT AS lang_sum FROM documents AS d LEFT JOIN wide ON d.doc_id::VARCHAR = wide.row_id LEFT JOIN labels AS l ON l.doc_id = d.doc_id GROUP BY lang, quality",
}
