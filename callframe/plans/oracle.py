"""DuckDB oracle: for each registered query, SQL over the same tables.

The SQL is written independently of the Spark jobs with DuckDB's own JSON
and regex functions (RE2, ``json_valid``, ``json_keys``). Fixtures come
from the shared fixture SQL so both engines start from the same rows.
Where DuckDB's JSON text keeps key order we compare extracted values.
"""

from __future__ import annotations

from callframe.operators.corpus import SYSTEM_PROMPT
from callframe.sources.fixtures import fixture_cte

_NUM = "('BIGINT','UBIGINT','DOUBLE','BOOLEAN')"

# Scoring of the `records` fixture, written from the decision table.
_SCORED = r"""
, o1 AS (
  SELECT r.*,
    regexp_matches(raw_response, '(?is)<thought>\s*(.*?)\s*</thought>') AS has_thought,
    regexp_matches(raw_response, '(?is)<tool_call>\s*(.*?)\s*</tool_call>') AS has_tool_call,
    trim(regexp_extract(raw_response, '(?is)<tool_call>\s*(.*?)\s*</tool_call>', 1), ' ' || chr(9) || chr(10) || chr(13)) AS b0,
    contains(upper(raw_response), '[ABORT:') AS is_abort
  FROM records r),
o2 AS (
  SELECT *, trim(CASE WHEN ends_with(b1, '```') THEN b1[1:length(b1) - 3] ELSE b1 END, ' ' || chr(9) || chr(10) || chr(13)) AS body
  FROM (SELECT *, CASE WHEN starts_with(b0, '```json') THEN b0[8:]
                       WHEN starts_with(b0, '```') THEN b0[4:] ELSE b0 END AS b1 FROM o1)),
o3 AS (
  SELECT *, has_tool_call AND json_valid(body) AS is_valid_json,
    answers NOT IN ('', '[]') AND NOT json_valid(answers) AS ground_truth_parsing_error
  FROM o2),
o4 AS (
  SELECT *,
    CASE WHEN NOT is_valid_json THEN 0
         WHEN json_type(body) = 'ARRAY' THEN json_array_length(body)
         WHEN json_type(body) = 'OBJECT' AND len(json_keys(body)) > 0 THEN 1 ELSE 0 END AS n_pred,
    CASE WHEN is_valid_json AND json_type(body) = 'ARRAY' THEN json_extract(body, '$[0]')
         WHEN is_valid_json AND json_type(body) = 'OBJECT' THEN json(body) END AS p,
    CASE WHEN answers IN ('', '[]') OR NOT json_valid(answers) THEN '[]' ELSE answers END AS truth,
    list_transform(json_extract(tools, '$[*]'), lambda t:
      CASE WHEN json_type(t, '$.function') = 'OBJECT' THEN json_extract_string(t, '$.function.name')
           ELSE json_extract_string(t, '$.name') END) AS available
  FROM o3),
o5 AS (
  SELECT *,
    json_type(truth) = 'ARRAY' AND json_array_length(truth) > 0 AS truth_truthy,
    json_extract(truth, '$[0]') AS g,
    coalesce(trim(json_extract_string(p, '$.name')), '') AS p_name
  FROM o4),
o6 AS (
  SELECT *,
    coalesce(trim(json_extract_string(g, '$.name')), '') AS g_name,
    coalesce(json_extract(p, '$.arguments'), '{}') AS pa,
    coalesce(json_extract(g, '$.arguments'), '{}') AS ga
  FROM o5),
o7 AS (
  SELECT *,
    json_keys(pa) AS pk, json_keys(ga) AS gk,
    list_sort(json_keys(pa)) = list_sort(json_keys(ga)) AND coalesce(list_bool_and(list_transform(json_keys(pa), lambda k:
        json_extract(pa, '$."' || k || '"')::VARCHAR = json_extract(ga, '$."' || k || '"')::VARCHAR
        OR (json_type(pa, '$."' || k || '"') IN """ + _NUM + """ AND json_type(ga, '$."' || k || '"') IN """ + _NUM + """
            AND TRY_CAST(json_extract(pa, '$."' || k || '"') AS DOUBLE) = TRY_CAST(json_extract(ga, '$."' || k || '"') AS DOUBLE)))), true) AS args_equal,
    coalesce(list_bool_and(list_transform(list_filter(json_keys(pa), lambda k: list_contains(json_keys(ga), k)), lambda k:
        json_type(pa, '$."' || k || '"') = json_type(ga, '$."' || k || '"')
        OR (json_type(pa, '$."' || k || '"') IN """ + _NUM + """ AND json_type(ga, '$."' || k || '"') IN """ + _NUM + """))), true) AS type_ok
  FROM o6),
scored AS (
  SELECT *,
    CASE
      WHEN NOT truth_truthy AND (is_abort OR n_pred = 0) THEN 'True Negative'
      WHEN NOT truth_truthy THEN 'False Positive'
      WHEN is_abort OR n_pred = 0 THEN 'False Negative'
      WHEN json_type(p) <> 'OBJECT' THEN 'False Negative'
      WHEN NOT list_contains(available, p_name) THEN 'False Negative'
      WHEN p_name <> g_name THEN 'False Negative'
      WHEN args_equal THEN 'True Positive'
      ELSE 'False Negative' END AS outcome,
    CASE
      WHEN NOT truth_truthy AND (is_abort OR n_pred = 0) THEN NULL
      WHEN NOT truth_truthy THEN 'error_hallucinated_tool'
      WHEN (is_abort OR n_pred = 0) AND has_tool_call AND NOT is_valid_json THEN 'error_syntax'
      WHEN is_abort OR n_pred = 0 THEN 'error_missing_tool'
      WHEN json_type(p) <> 'OBJECT' THEN 'error_syntax'
      WHEN NOT list_contains(available, p_name) THEN 'error_hallucinated_tool'
      WHEN p_name <> g_name THEN 'error_hallucinated_tool'
      WHEN args_equal THEN NULL
      WHEN len(list_filter(pk, lambda k: NOT list_contains(gk, k))) > 0 THEN 'error_hallucinated_param'
      WHEN len(list_filter(gk, lambda k: NOT list_contains(pk, k))) > 0 THEN 'error_missing_param'
      WHEN NOT type_ok THEN 'error_type_mismatch'
      ELSE 'error_value_mismatch' END AS error_category
  FROM o7)
"""

_CATS = ("syntax", "missing_tool", "hallucinated_tool", "hallucinated_param",
         "missing_param", "type_mismatch", "value_mismatch")


def _with_scored() -> str:
    return fixture_cte("records") + _SCORED


def _error_distribution(filter_missing: bool) -> str:
    cats = [c for c in _CATS if not (filter_missing and c == "missing_tool")]
    values = ", ".join(f"('{c}')" for c in cats)
    return _with_scored() + f"""
SELECT c.category, CAST(count(s.error_category) AS BIGINT) AS n
FROM (VALUES {values}) AS c(category)
LEFT JOIN scored s ON s.error_category = 'error_' || c.category
GROUP BY c.category"""


ORACLE: dict[str, str] = {
    "parse_outputs": _with_scored() + """
SELECT record_id, has_thought, has_tool_call, is_valid_json, is_abort,
  CAST(n_pred AS INTEGER) AS n_calls,
  CASE WHEN json_type(p, '$.name') = 'VARCHAR' THEN json_extract_string(p, '$.name') END AS first_call_name
FROM scored""",
    # strings emptied, then inner containers away: only outermost commas are left
    "conformance_rate": fixture_cte("array_outputs") + r"""
, bare AS (SELECT *, starts_with(raw_response, '[' || chr(10)) AND ends_with(raw_response, ']')
    AND CASE WHEN json_valid(raw_response) THEN json_type(raw_response) = 'ARRAY' ELSE false END AS shaped,
    regexp_replace(raw_response[2:length(raw_response) - 1], '"([^"\\]|\\.)*"', 's', 'g') AS b0 FROM array_outputs),
flat AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(b0, '[\[{][^\[\]{}]*[\]}]', 'v', 'g'),
    '[\[{][^\[\]{}]*[\]}]', 'v', 'g'), '[\[{][^\[\]{}]*[\]}]', 'v', 'g') AS b3 FROM bare),
told AS (SELECT tool, shaped AND NOT regexp_matches(b3, ',[^\n]') AS ok FROM flat)
SELECT tool, count(*) AS n, count(*) FILTER (WHERE ok) AS n_conformant, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6) AS conformance_rate
FROM told GROUP BY tool""",
    "score_trace": _with_scored() + """
SELECT record_id AS sample_id, query,
  to_json(list_transform(json_extract(tools, '$[*]'), lambda t:
      CASE WHEN json_type(t, '$.name') = 'VARCHAR' THEN json_extract_string(t, '$.name') END))::VARCHAR AS available_tools,
  answers AS answers_str_raw, ground_truth_parsing_error,
  CASE WHEN answers IN ('', '[]') OR ground_truth_parsing_error THEN '[]' ELSE json(answers)::VARCHAR END AS parsed_answers,
  raw_response, has_thought, has_tool_call, is_valid_json, is_abort,
  CASE WHEN is_valid_json THEN json(body)::VARCHAR END AS parsed_json,
  outcome, error_category, latency_ms, generated_tokens
FROM scored""",
    "confusion": _with_scored() + """
SELECT count(*) AS total_samples,
  count(*) FILTER (WHERE outcome = 'True Positive') AS true_positives,
  count(*) FILTER (WHERE outcome = 'False Positive') AS false_positives,
  count(*) FILTER (WHERE outcome = 'True Negative') AS true_negatives,
  count(*) FILTER (WHERE outcome = 'False Negative') AS false_negatives,
  count(*) FILTER (WHERE outcome = 'Invalid') AS invalid, CAST(0 AS BIGINT) AS no_output
FROM scored""",
    "error_distribution": _error_distribution(False),
    "failure_table": _error_distribution(True),
    "perf": _with_scored() + """
SELECT count(*) AS total_samples,
  round(coalesce(sum(latency_ms), 0) / greatest(1, count(*)), 6) AS avg_latency_ms,
  round(CASE WHEN coalesce(sum(latency_ms), 0) > 0 THEN sum(generated_tokens) / (sum(latency_ms) / 1000) ELSE 0 END, 6) AS tokens_per_second
FROM scored""",
    "confusion_table": _with_scored() + """
SELECT a.actual, a.predicted, CAST(count(s.outcome) AS BIGINT) AS n
FROM (VALUES ('Positive', 'Positive', 'True Positive'), ('Negative', 'Positive', 'False Positive'),
             ('Positive', 'Negative', 'False Negative'), ('Negative', 'Negative', 'True Negative')) AS a(actual, predicted, outcome)
LEFT JOIN scored s ON s.outcome = a.outcome
GROUP BY a.actual, a.predicted""",
    "score_by_tool": _with_scored() + """
SELECT tool,
  count(*) AS total_samples,
  count(*) FILTER (WHERE outcome = 'True Positive') AS true_positives,
  count(*) FILTER (WHERE outcome = 'False Positive') AS false_positives,
  count(*) FILTER (WHERE outcome = 'True Negative') AS true_negatives,
  count(*) FILTER (WHERE outcome = 'False Negative') AS false_negatives,
  count(*) FILTER (WHERE outcome = 'Invalid') AS invalid, CAST(0 AS BIGINT) AS no_output,
  CAST(grouping(tool) AS BIGINT) AS level
FROM (SELECT *, CASE WHEN truth_truthy THEN g_name ELSE '(none)' END AS tool FROM scored)
GROUP BY ROLLUP (tool)""",
}


# -- N: record normalisation ----------------------------------------------

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _jt(s: str) -> str:
    """json_type that is NULL for invalid text."""
    return f"json_type(CASE WHEN json_valid({s}) THEN {s} END)"


def _jv(s: str) -> str:
    return f"json(CASE WHEN json_valid({s}) THEN {s} END)::VARCHAR"


def _has_name(s: str) -> str:
    return f"coalesce(json_exists(CASE WHEN json_valid({s}) THEN {s} END, '$.name'), false)"


def _norm_answers(c: str) -> str:
    s = f"trim({c}, {_WS})"
    f = f"replace({s}, '''', '\"')"
    return f"""(CASE WHEN {c} IS NULL OR {c} = '' THEN '[]'
  WHEN {_jt(s)} = 'ARRAY' THEN {_jv(s)}
  WHEN {_jt(s)} = 'OBJECT' AND {_has_name(s)} THEN '[' || {_jv(s)} || ']'
  WHEN {_jt(f)} = 'ARRAY' THEN {_jv(f)}
  WHEN {_jt(f)} = 'OBJECT' AND {_has_name(f)} THEN '[' || {_jv(f)} || ']'
  ELSE '[]' END)"""


_TAG = r"'(?s)<tool_call>\s*(.*?)\s*</tool_call>'"


def _fence(r: str) -> str:
    r1 = f"(CASE WHEN starts_with({r}, '```json') THEN {r}[8:] WHEN starts_with({r}, '```') THEN {r}[4:] ELSE {r} END)"
    return f"trim(CASE WHEN ends_with({r1}, '```') THEN {r1}[1:length({r1}) - 3] ELSE {r1} END, {_WS})"


def _extract_answers(c: str) -> str:
    body = f"trim(regexp_extract({c}, {_TAG}, 1), {_WS})"
    g = f"regexp_extract({c}, '(?s)\\[.*\\]', 0)"
    first = f"json_extract(CASE WHEN json_valid({g}) THEN {g} END, '$[0]')"
    return f"""(CASE WHEN {c} IS NULL OR {c} = '' THEN '[]'
  WHEN regexp_matches({c}, {_TAG}) THEN {_norm_answers(_fence(body))}
  WHEN {_jt(g)} = 'ARRAY' AND json_array_length(CASE WHEN json_valid({g}) THEN {g} END) > 0
       AND json_type({first}) = 'OBJECT' AND json_exists({first}, '$.name') THEN {_jv(g)}
  ELSE '[]' END)"""


ORACLE["normalize_conversations"] = fixture_cte("turns") + f"""
, t AS (
  SELECT conv_id, turn, content,
    CASE WHEN lower(role) IN ('user', 'human') THEN 'query'
         WHEN lower(role) IN ('function_call', 'tool_call', 'tool') THEN 'call'
         WHEN lower(role) IN ('assistant', 'gpt', 'model') THEN 'assistant' END AS kind
  FROM turns),
t2 AS (
  SELECT conv_id, turn, kind, content,
    CASE WHEN kind = 'call' THEN {_norm_answers('content')}
         WHEN kind = 'assistant' THEN {_extract_answers('content')} END AS norm
  FROM t),
stage AS (
  SELECT conv_id, coalesce(arg_max(content, turn) FILTER (WHERE kind = 'query'), '') AS query,
         max(turn) FILTER (WHERE kind = 'call') AS last_call
  FROM t2 GROUP BY conv_id),
chosen AS (
  SELECT s.conv_id, arg_min(c.norm, c.turn) AS answers
  FROM stage s JOIN t2 c ON c.conv_id = s.conv_id
  WHERE c.kind IN ('call', 'assistant') AND c.norm <> '[]' AND (s.last_call IS NULL OR c.turn >= s.last_call)
  GROUP BY s.conv_id)
SELECT s.conv_id AS record_id, s.query, coalesce(c.answers, '[]') AS answers, '[]' AS tools
FROM stage s LEFT JOIN chosen c ON c.conv_id = s.conv_id"""

_FLAT_ERROR = f"""CASE WHEN tools IS NULL THEN 'tools_missing'
    WHEN NOT json_valid(tools) THEN 'tools_not_json'
    WHEN query IS NULL THEN 'query_not_string'
    WHEN {_jt('tools')} <> 'ARRAY' THEN 'tools_not_list'
    WHEN list_bool_or(list_transform(json_extract(CASE WHEN json_valid(tools) THEN tools END, '$[*]'),
                                     lambda x: json_type(x) <> 'OBJECT')) THEN 'tool_not_object' END"""

ORACLE["normalize_flat"] = fixture_cte("flat_rows") + f"""
SELECT row_id AS record_id, query, {_jv('tools')} AS tools, coalesce(answers, '[]') AS answers
FROM flat_rows WHERE ({_FLAT_ERROR}) IS NULL"""

ORACLE["quarantine_records"] = fixture_cte("flat_rows") + f"""
SELECT row_id AS record_id, error FROM (SELECT row_id, {_FLAT_ERROR} AS error FROM flat_rows)
WHERE error IS NOT NULL"""


# -- T / V4: training corpus --------------------------------------------------



def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NL = "chr(10)"
_CORPUS = fixture_cte("records") + f"""
, p AS (
  SELECT record_id, query, tools, answers, json(tools)::VARCHAR AS tools_text,
    coalesce(nullif(array_to_string(list_transform(json_extract(tools, '$[*]'), lambda t:
      coalesce(CASE WHEN json_type(t, '$.function') = 'OBJECT' THEN json_extract_string(t, '$.function.name')
                    ELSE json_extract_string(t, '$.name') END, 'unknown')), ', '), ''), 'None') AS tool_list,
    answers IN ('', '[]') OR NOT json_valid(answers) OR json_array_length(CASE WHEN json_valid(answers) THEN answers END) = 0 AS is_negative
  FROM records),
p2 AS (
  SELECT *,
    CASE WHEN NOT is_negative THEN json_extract_string(answers, '$[0].name') END AS target,
    CASE WHEN NOT is_negative THEN json_extract(answers, '$[0].arguments')::VARCHAR END AS params,
    CASE WHEN NOT is_negative THEN json(answers)::VARCHAR END AS calls
  FROM p),
p3 AS (
  SELECT *, list_filter(json_extract(tools, '$[*]'), lambda t: json_extract_string(t, '$.name') = target)[1] AS tool
  FROM p2),
p4 AS (
  SELECT *,
    CASE WHEN json_type(tool, '$.parameters') = 'OBJECT' AND json_exists(tool, '$.parameters.required') THEN json_extract(tool, '$.parameters.required')
         WHEN json_exists(tool, '$.required') THEN json_extract(tool, '$.required') END AS req
  FROM p3),
corpus AS (
  SELECT record_id,
    '<|im_start|>system' || {_NL} || {_lit(SYSTEM_PROMPT)} || '<|im_end|>' || {_NL}
    || '<|im_start|>user' || {_NL} || 'Available tools:' || {_NL} || tools_text || {_NL} || {_NL} || 'User Query: ' || query
    || '<|im_end|>' || {_NL} || '<|im_start|>assistant' || {_NL}
    || CASE WHEN is_negative THEN
         '<thought>' || {_NL} || '1. Tool Assessment: The available tools are: ' || tool_list || '.' || {_NL}
         || '2. Intent Matching: The user''s query is ''' || query || '''. None of the available tools match this intent.' || {_NL}
         || '3. Parameter Extraction: N/A' || {_NL} || '4. Validation: [ABORT: No matching tool]' || {_NL} || '</thought>' || {_NL}
         || 'I''m sorry, but I don''t have the tools to help you with that request.'
       ELSE
         '<thought>' || {_NL} || '1. Tool Assessment: The available tools are: ' || tool_list || '.' || {_NL}
         || '2. Intent Matching: The user''s query is ''' || query || '''. The tool ''' || target || ''' matches this intent.' || {_NL}
         || '3. Parameter Extraction: The required parameters are '
         || CASE WHEN req IS NOT NULL AND json_array_length(req) > 0 THEN req::VARCHAR ELSE 'None defined' END
         || '. Values extracted: ' || params || '.' || {_NL}
         || '4. Validation: All required parameters are present. Proceeding with tool call.' || {_NL} || '</thought>' || {_NL}
         || '<tool_call>' || {_NL} || calls || {_NL} || '</tool_call>'
       END || '<|im_end|>' || {_NL} AS text
  FROM p4),
checked AS (
  SELECT record_id, text,
    contains(text, '<thought>') AND contains(text, '</thought>') AS has_thought_tags,
    contains(text, '<tool_call>') AND contains(text, '</tool_call>') AS has_tool_call_tags,
    contains(text, '[ABORT:') AS has_abort,
    contains(text, '"unknown"') OR contains(lower(text), ': unknown') AS has_unknown_token,
    CAST(length(text) AS INTEGER) AS prompt_length_chars
  FROM corpus)
"""

ORACLE["sft_corpus"] = _CORPUS + "SELECT record_id, text FROM corpus"
ORACLE["corpus_profile"] = _CORPUS + """
SELECT record_id, NOT (has_abort AND NOT has_tool_call_tags) AS is_positive_case, has_thought_tags,
  has_tool_call_tags, has_abort, has_unknown_token, prompt_length_chars,
  CASE WHEN has_unknown_token THEN 'WARNING' ELSE 'OK' END AS status
FROM checked"""
ORACLE["corpus_summary"] = _CORPUS + """
SELECT count(*) AS samples_checked,
  count(*) FILTER (WHERE NOT (has_abort AND NOT has_tool_call_tags)) AS positive_cases,
  count(*) FILTER (WHERE has_unknown_token) AS warnings, count(*) FILTER (WHERE text IS NULL) AS errors,
  count(*) FILTER (WHERE NOT has_thought_tags) AS missing_thought_tags,
  min(prompt_length_chars) AS min_chars, max(prompt_length_chars) AS max_chars
FROM checked"""


# -- V / P / D ------------------------------------------------------------------

_RECORD_COLS = ("record_id", "query", "tools", "answers", "raw_response", "latency_ms", "generated_tokens")
_SPARK_TYPE = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' "
               "WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int' ELSE lower(typeof({c})) END")

ORACLE["dataset_profile"] = fixture_cte("records") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({i + 1} AS INTEGER) AS position, "
    f"any_value({_SPARK_TYPE.format(c=c)}) AS data_type, count(*) - count({c}) AS null_count, count(*) AS total_rows "
    f"FROM records" for i, c in enumerate(_RECORD_COLS))

ORACLE["dataset_examples"] = fixture_cte("records") + "\nSELECT * FROM records ORDER BY record_id LIMIT 3"

_ADAPTER = fixture_cte("flat_rows") + f"""
, n AS (
  SELECT row_id AS record_id, query, tools, coalesce(answers, '[]') AS answers, {_FLAT_ERROR} AS error
  FROM flat_rows),
c AS (
  SELECT *, answers NOT IN ('', '[]') AS needs,
    list_transform(list_filter(json_extract(CASE WHEN error IS NULL THEN tools END, '$[*]'),
                               lambda t: json_type(t) = 'OBJECT'), lambda t: json_extract(t, '$.name')) AS names_j
  FROM n),
c2 AS (
  SELECT *, needs AND NOT json_valid(answers) AS perr,
    coalesce(list_bool_or(list_transform(names_j, lambda x: x IS NULL OR json_type(x) = 'NULL'
        OR (json_type(x) = 'VARCHAR' AND json_extract_string(x, '$') = 'unknown'))), false) AS has_null
  FROM c),
checked AS (
  SELECT record_id,
    CASE WHEN error IS NOT NULL THEN 'ERROR' WHEN has_null OR perr THEN 'WARNING' ELSE 'OK' END AS status,
    CASE WHEN error IS NULL THEN substring(query, 1, 200) END AS query,
    CASE WHEN error IS NULL THEN CAST(json_array_length(tools) AS INTEGER) END AS tool_count,
    CASE WHEN error IS NULL THEN to_json(list_transform(names_j, lambda x:
        CASE WHEN json_type(x) = 'VARCHAR' THEN json_extract_string(x, '$') END))::VARCHAR END AS tool_names,
    CASE WHEN error IS NULL THEN has_null END AS has_null_tools,
    CASE WHEN error IS NULL THEN coalesce(substring(answers, 1, 300), '') END AS answers_raw,
    CASE WHEN error IS NULL THEN CAST(CASE WHEN needs AND {_jt('answers')} = 'ARRAY'
        THEN json_array_length(answers) ELSE 0 END AS INTEGER) END AS answers_parsed_count,
    CASE WHEN error IS NULL THEN
      CASE WHEN needs AND {_jt('answers')} = 'ARRAY'
           THEN to_json(list_transform(list_filter(json_extract(CASE WHEN json_valid(answers) THEN answers END, '$[*]'),
                  lambda a: json_type(a) = 'OBJECT'), lambda a: json_extract_string(a, '$.name')))::VARCHAR
           ELSE '[]' END END AS answer_tool_names,
    CASE WHEN error IS NULL THEN perr END AS answers_parse_error,
    error
  FROM c2)
"""
ORACLE["adapter_check"] = _ADAPTER + "SELECT * FROM checked"
ORACLE["adapter_summary"] = _ADAPTER + """
SELECT count(*) AS samples_checked, coalesce(bool_and(status = 'OK'), true) AS all_passed,
  count(*) FILTER (WHERE has_null_tools) AS null_tool_name_count,
  count(*) FILTER (WHERE answers_parse_error) AS answer_parse_error_count
FROM checked"""

ORACLE["divergence"] = fixture_cte("loss_log") + """
SELECT run_id, min(step) AS first_bad_step,
  CASE WHEN isnan(arg_min(loss, step)) THEN 'NaN' WHEN arg_min(loss, step) > 0 THEN 'Infinity'
       ELSE '-Infinity' END AS first_bad_loss,
  count(*) AS n_bad_steps
FROM loss_log WHERE isnan(loss) OR isinf(loss) GROUP BY run_id"""

ORACLE["item_rules"] = fixture_cte("items") + """
SELECT r.rule, CAST(r.violations AS BIGINT) AS violations, r.items FROM (
  SELECT 'item_code_length' AS rule, count(*) FILTER (WHERE NOT coalesce(length(item_code) BETWEEN 3 AND 20, false)) AS violations, count(*) AS items FROM items
  UNION ALL SELECT 'name_length', count(*) FILTER (WHERE NOT coalesce(length(name) BETWEEN 2 AND 50, false)), count(*) FROM items
  UNION ALL SELECT 'cost_positive', count(*) FILTER (WHERE NOT coalesce(cost > 0, false)), count(*) FROM items
  UNION ALL SELECT 'quantity_non_negative', count(*) FILTER (WHERE NOT coalesce(quantity >= 0, false)), count(*) FROM items) r"""

ORACLE["train_limit"] = fixture_cte("records") + "\nSELECT record_id, query FROM records ORDER BY record_id LIMIT 2000"
ORACLE["eval_tail"] = fixture_cte("records") + "\nSELECT record_id, query FROM records ORDER BY record_id DESC LIMIT 100"
ORACLE["overlap"] = fixture_cte("records", "flat_rows") + """
SELECT query, row_id AS record_id FROM flat_rows WHERE query IN (SELECT query FROM records)"""

ORACLE["tool_catalogue"] = fixture_cte("flat_rows") + f"""
, ok AS (SELECT tools FROM flat_rows WHERE ({_FLAT_ERROR}) IS NULL),
t AS (SELECT unnest(json_extract(tools, '$[*]')) AS t FROM ok),
f AS (SELECT CASE WHEN json_type(t, '$.function') = 'OBJECT' THEN json_extract(t, '$.function') ELSE t END AS t
      FROM t WHERE json_type(t) = 'OBJECT')
SELECT CASE WHEN json_type(t, '$.name') = 'VARCHAR' THEN json_extract_string(t, '$.name') END AS name,
  count(*) AS uses, count(DISTINCT json(t)::VARCHAR) AS n_schemas
FROM f GROUP BY 1"""


# -- C / A6: tool execution ------------------------------------------------------

_MONEY = "DECIMAL(20,6)"


def _rounded(v: str) -> str:
    """Two places, half up on the double's decimal text (as Spark rounds)."""
    return f"CAST(round(CAST(CAST({v} AS VARCHAR) AS DECIMAL(38,10)), 2) AS DOUBLE)"


_CALLS = fixture_cte("inventory_calls", "items") + f"""
, ex AS (
  SELECT call_id, i AS pos, json_extract(calls, '$[' || i || ']') AS c
  FROM (SELECT call_id, calls, unnest(range(CAST(json_array_length(calls) AS BIGINT))) AS i
        FROM inventory_calls WHERE json_valid(calls))),
by_code AS (SELECT item_code, sum(CAST(cost AS {_MONEY}) * quantity) AS v FROM items GROUP BY item_code),
first_by_name AS (SELECT name AS item_name, arg_min(item_code, item_order) AS item_code FROM items GROUP BY name)
"""

_INV_CTES = f"""
, inv AS (
  SELECT call_id, pos, json_extract(c, '$.arguments') AS args FROM ex
  WHERE json_extract_string(c, '$.name') = 'inventory_check'),
inv2 AS (
  SELECT call_id, pos, json_type(args, '$.item_codes') AS ck, json_extract(args, '$.item_codes') AS codes,
    CASE WHEN json_type(args, '$.conversion_rate') IN ('BIGINT', 'UBIGINT', 'DOUBLE')
         THEN CAST(json_extract(args, '$.conversion_rate') AS DOUBLE) END AS rate
  FROM inv),
inv3 AS (
  SELECT *, CASE WHEN ck IS NULL OR ck NOT IN ('NULL', 'ARRAY') OR rate IS NULL THEN 'bad_arguments' ELSE 'ok' END AS status,
    ck = 'NULL' OR (ck = 'ARRAY' AND json_array_length(codes) = 0) AS all_items
  FROM inv2),
listed AS (
  SELECT x.call_id, x.pos, sum(b.v) AS v
  FROM (SELECT DISTINCT call_id, pos, unnest(json_extract_string(codes, '$[*]')) AS code
        FROM inv3 WHERE status = 'ok' AND NOT all_items) x
  JOIN by_code b ON b.item_code = x.code GROUP BY x.call_id, x.pos)
"""
_INV_SELECT = f"""SELECT i.call_id, CAST(i.pos AS INTEGER) AS pos, i.status, i.all_items,
  CASE WHEN i.status = 'ok' THEN {_rounded(f"CAST(CASE WHEN i.all_items THEN (SELECT sum(CAST(cost AS {_MONEY}) * quantity) FROM items) ELSE coalesce(l.v, 0) END AS DOUBLE) * i.rate")} END AS value
FROM inv3 i LEFT JOIN listed l ON l.call_id = i.call_id AND l.pos = i.pos"""
ORACLE["inventory_value"] = _CALLS + _INV_CTES + _INV_SELECT

ORACLE["item_by_name"] = _CALLS + """
, fetched AS (
  SELECT call_id, pos, json_extract_string(c, '$.arguments.item_name') AS item_name FROM ex
  WHERE json_extract_string(c, '$.name') = 'fetch_item_by_name')
SELECT f.call_id, CAST(f.pos AS INTEGER) AS pos, f.item_name, n.item_code,
  CASE WHEN n.item_code IS NULL THEN 'not_found' ELSE 'found' END AS status
FROM fetched f LEFT JOIN first_by_name n ON n.item_name = f.item_name"""

ORACLE["chained_calls"] = _CALLS + f"""
, ch AS (
  SELECT call_id, json_extract_string(calls, '$[0].arguments.item_name') AS item_name,
    CAST(json_extract(calls, '$[1].arguments.conversion_rate') AS DOUBLE) AS rate
  FROM (SELECT call_id, CASE WHEN json_valid(calls) THEN calls END AS calls FROM inventory_calls)
  WHERE json_extract_string(calls, '$[0].name') = 'fetch_item_by_name'
    AND json_extract_string(calls, '$[1].name') = 'inventory_check')
SELECT ch.call_id, ch.item_name, n.item_code,
  CASE WHEN n.item_code IS NULL THEN 'not_found' ELSE 'ok' END AS status,
  CASE WHEN n.item_code IS NOT NULL THEN {_rounded("CAST(coalesce(b.v, 0) AS DOUBLE) * ch.rate")} END AS value
FROM ch LEFT JOIN first_by_name n ON n.item_name = ch.item_name
LEFT JOIN by_code b ON b.item_code = n.item_code"""

ORACLE["inventory_total"] = fixture_cte("items") + f"""
SELECT {_rounded(f"CAST(sum(CAST(cost AS {_MONEY}) * quantity) AS DOUBLE) * 1.0")} AS total_value,
  count(*) AS items FROM items"""

ORACLE["vector_sum"] = fixture_cte("vector_pairs") + """
SELECT vec_id, CAST(i AS INTEGER) AS pos, round(CAST(a[i + 1] AS DOUBLE) + CAST(b[i + 1] AS DOUBLE), 6) AS value,
  CAST(NULL AS VARCHAR) AS error
FROM (SELECT vec_id, a, b, unnest(range(len(a))) AS i FROM vector_pairs WHERE len(a) = len(b))
UNION ALL SELECT vec_id, NULL, NULL, 'Vectors must be of the same length' FROM vector_pairs WHERE len(a) <> len(b)"""

ORACLE["dot_product"] = fixture_cte("vector_pairs") + """
SELECT vec_id,
  CASE WHEN len(a) = len(b) THEN round(list_reduce(list_transform(range(len(a)), lambda i: CAST(a[i + 1] AS DOUBLE) * CAST(b[i + 1] AS DOUBLE)), lambda x, y: x + y), 6) END AS dot,
  CASE WHEN len(a) <> len(b) THEN 'Vectors must be of the same length' END AS error
FROM vector_pairs"""

ORACLE["stream_score"] = ORACLE["score_trace"]
ORACLE["stream_divergence"] = ORACLE["divergence"]

# Executed calls rendered as transcripts.
_Q = "How much is the total inventory cost of the items in this request?"
_CTX = ("You are a super helpful AI assistant.' || chr(10) || 'You are asked to answer a question based on the "
        "following context information.' || chr(10) || 'Question:' || chr(10) || '")
ORACLE["transcripts"] = _CALLS + _INV_CTES + """
, vals AS (""" + _INV_SELECT + f"""),
named AS (
  SELECT e.call_id, e.pos, json_extract_string(e.c, '$.name') AS name, json_extract(e.c, '$.arguments')::VARCHAR AS args_text,
    n.item_code
  FROM ex e LEFT JOIN first_by_name n
    ON json_extract_string(e.c, '$.name') = 'fetch_item_by_name' AND n.item_name = json_extract_string(e.c, '$.arguments.item_name')),
turns AS (
  SELECT n.call_id, n.pos,
    '<|im_start|>assistant' || chr(10) || '<tool_call>' || chr(10) || '{{"id":"' || substring(sha256(CAST(n.call_id AS VARCHAR) || ':' || CAST(n.pos AS VARCHAR)), 1, 9)
    || '","type":"function","function":{{"name":' || CAST(to_json(coalesce(n.name, '')) AS VARCHAR) || ',"arguments":' || coalesce(n.args_text, 'null') || '}}}}' || chr(10) || '</tool_call><|im_end|>' || chr(10)
    || '<|im_start|>tool' || chr(10) || coalesce(n.name, '') || chr(10)
    || coalesce(CASE WHEN n.name = 'inventory_check' THEN printf('%.2f', v.value) WHEN n.name = 'fetch_item_by_name' THEN n.item_code END, 'null')
    || '<|im_end|>' || chr(10) AS turn_text
  FROM named n LEFT JOIN vals v ON v.call_id = n.call_id AND v.pos = n.pos)
SELECT c.call_id,
  '<|im_start|>user' || chr(10) || '{_CTX}{_Q}' || '<|im_end|>' || chr(10)
  || coalesce(string_agg(t.turn_text, '' ORDER BY t.pos), '') || '<|im_start|>assistant' || chr(10) || 'Answer:' || chr(10) AS transcript
FROM inventory_calls c LEFT JOIN turns t ON t.call_id = c.call_id GROUP BY c.call_id"""

_ARRIVED = fixture_cte("records", "arrivals") + _SCORED + """
, arrived AS (
  SELECT strftime(time_bucket(INTERVAL 1 HOUR, a.event_time), '%Y-%m-%d %H:%M:%S') AS window_start,
    time_bucket(INTERVAL 1 HOUR, a.event_time) + INTERVAL 2 HOUR <= (SELECT max(event_time) FROM arrivals) AS closed,
    a.arrival, coalesce(s.outcome, 'No Truth') AS outcome
  FROM arrivals a LEFT JOIN scored s ON s.record_id = a.record_id)
"""
ORACLE["stream_outcome_windows"] = _ARRIVED + """
SELECT window_start, outcome, count(*) AS n FROM arrived WHERE closed AND arrival < 2 GROUP BY 1, 2"""
ORACLE["stream_late_rows"] = _ARRIVED + """
SELECT window_start, outcome, count(*) AS n_late FROM arrived WHERE arrival = 2 GROUP BY 1, 2"""
ORACLE["stream_alerts"] = fixture_cte("loss_log") + """
SELECT run_id, CAST(1 AS BIGINT) AS alerts FROM loss_log WHERE isnan(loss) OR isinf(loss) GROUP BY run_id"""
_COUNTS = """  count(*) AS total_samples,
  count(*) FILTER (WHERE outcome = 'True Positive') AS true_positives,
  count(*) FILTER (WHERE outcome = 'False Positive') AS false_positives,
  count(*) FILTER (WHERE outcome = 'True Negative') AS true_negatives,
  count(*) FILTER (WHERE outcome = 'False Negative') AS false_negatives,
  count(*) FILTER (WHERE outcome = 'Invalid') AS invalid, CAST(0 AS BIGINT) AS no_output"""
ORACLE["score_cube"] = _with_scored() + f"""
SELECT tool, day,
{_COUNTS}, CAST(grouping(tool, day) AS BIGINT) AS level
FROM (SELECT s.outcome, CASE WHEN truth_truthy THEN g_name ELSE '(none)' END AS tool, strftime(e.ts, '%Y-%m-%d') AS day
      FROM scored s JOIN events e ON e.event_id = s.record_id)
GROUP BY CUBE (tool, day)"""

ORACLE["score_by_day"] = _with_scored() + """
SELECT day,
  count(*) AS total_samples,
  count(*) FILTER (WHERE outcome = 'True Positive') AS true_positives,
  count(*) FILTER (WHERE outcome = 'False Positive') AS false_positives,
  count(*) FILTER (WHERE outcome = 'True Negative') AS true_negatives,
  count(*) FILTER (WHERE outcome = 'False Negative') AS false_negatives,
  count(*) FILTER (WHERE outcome = 'Invalid') AS invalid, CAST(0 AS BIGINT) AS no_output,
  CAST(grouping(day) AS BIGINT) AS level
FROM (SELECT s.outcome, strftime(e.ts, '%Y-%m-%d') AS day FROM scored s JOIN events e ON e.event_id = s.record_id)
GROUP BY ROLLUP (day)"""

ORACLE["normalize_nested"] = fixture_cte("nested_rows") + """
, n AS (SELECT e.event_id AS record_id,
    CASE WHEN e.event_id % 7 = 0 THEN 'messages_not_json' WHEN e.event_id % 11 = 0 THEN 'tools_not_json' END AS error,
    e.event_type, e.user_id FROM events e JOIN nested_rows r ON r.record_id = e.event_id)
SELECT record_id, error,
  CASE WHEN error IS NULL THEN CASE WHEN record_id % 7 = 2 THEN 'again'
       ELSE 'Log ' || event_type || ' for user ' || CAST(user_id AS VARCHAR) END END AS query,
  CASE WHEN error IS NULL THEN CASE WHEN record_id % 11 = 1 THEN '[]'
       ELSE '[{"name":"' || event_type || '"},{"name":"lookup"}]' END END AS tools,
  CASE WHEN error IS NULL THEN '[]' END AS answers
FROM n"""

ORACLE["rejected_counts"] = f"SELECT error, count(*) AS n FROM ({ORACLE['quarantine_records']}) GROUP BY error"

# What each fault of the odd records must give, written down by fault.
_ODD = """
WITH odd AS (SELECT event_id AS record_id, event_id % 13 AS v, event_id % 59 = 4 AS strayed, value FROM events),
told AS (SELECT record_id, v = 0 AS ground_truth_parsing_error, strayed, value, v,
  CASE WHEN v = 7 OR strayed THEN 'No Output'
       WHEN v = 0 THEN 'False Positive' WHEN v IN (1, 2, 11) THEN 'Invalid'
       WHEN v IN (3, 4, 9) THEN 'True Positive' ELSE 'False Negative' END AS outcome,
  CASE WHEN v = 7 OR strayed THEN 'no_output'
       WHEN v = 0 THEN 'error_hallucinated_tool' WHEN v = 1 THEN 'invalid_truth_not_a_list'
       WHEN v = 2 THEN 'invalid_truth_call_not_object' WHEN v = 11 THEN 'invalid_arguments_not_object'
       WHEN v = 5 THEN 'error_syntax' WHEN v = 6 THEN 'error_hallucinated_tool' WHEN v = 8 THEN 'error_missing_param'
       WHEN v = 10 THEN 'error_type_mismatch' WHEN v = 12 THEN 'error_type_mismatch' END AS error_category
  FROM odd)
"""
ORACLE["score_odd"] = _ODD + "SELECT record_id, ground_truth_parsing_error, outcome, error_category FROM told"
ORACLE["evaluation_report"] = _ODD + f"""
SELECT count(*) FILTER (WHERE outcome <> 'No Output') AS total_samples, count(*) FILTER (WHERE outcome = 'No Output') AS no_output,
  (SELECT count(*) FROM ({ORACLE["quarantine_records"]})) AS skipped, count(*) FILTER (WHERE strayed AND v <> 7) AS orphan_outputs,
  count(*) FILTER (WHERE outcome = 'True Positive') AS true_positives, count(*) FILTER (WHERE outcome = 'False Positive') AS false_positives,
  count(*) FILTER (WHERE outcome = 'True Negative') AS true_negatives, count(*) FILTER (WHERE outcome = 'False Negative') AS false_negatives,
  count(*) FILTER (WHERE outcome = 'Invalid') AS invalid,
  round(sum(value) FILTER (WHERE outcome <> 'No Output') / count(*) FILTER (WHERE outcome <> 'No Output'), 6) AS avg_latency_ms
FROM told"""

_LINES = fixture_cte("json_lines") + """
, told AS (SELECT line_no % 19 AS k, line_no, line,
    CASE WHEN line_no % 19 IN (4, 5, 6) THEN 'line_not_json' WHEN line_no % 19 = 7 THEN 'tools_not_json' END AS error FROM json_lines)
"""
ORACLE["json_lines"] = _LINES + """
SELECT CASE WHEN k NOT IN (4, 5, 6) THEN line_no END AS record_id, error, CASE WHEN k IN (4, 5, 6) THEN line END AS line FROM told"""
ORACLE["routed_corpus"] = _LINES + f"""
, texts AS (SELECT coalesce(error, '') AS error, json_exists(CASE WHEN error IS NULL THEN line END, '$.source') AS with_source,
    CASE WHEN error IS NULL THEN length('<|im_start|>system' || chr(10) || {_lit(SYSTEM_PROMPT)} || '<|im_end|>' || chr(10)
      || '<|im_start|>user' || chr(10) || 'Available tools:' || chr(10) || '[]' || chr(10) || chr(10) || 'User Query: ' || q
      || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
      || '<thought>' || chr(10) || '1. Tool Assessment: The available tools are: None.' || chr(10)
      || '2. Intent Matching: The user''s query is ''' || q || '''. None of the available tools match this intent.' || chr(10)
      || '3. Parameter Extraction: N/A' || chr(10) || '4. Validation: [ABORT: No matching tool]' || chr(10) || '</thought>' || chr(10)
      || 'I''m sorry, but I don''t have the tools to help you with that request.' || '<|im_end|>' || chr(10)) ELSE 0 END AS chars
  FROM (SELECT *, json_extract_string(CASE WHEN error IS NULL THEN line END, '$.query') AS q FROM told))
SELECT error, count(*) AS n, count(*) FILTER (WHERE with_source) AS with_source, CAST(sum(chars) AS BIGINT) AS chars, count(*) AS counted
FROM texts GROUP BY error"""

ORACLE["sft_messages"] = _CORPUS + """
, said AS (SELECT record_id, string_split(text, '<|im_start|>') AS parts FROM corpus),
one AS (SELECT record_id, i, parts[i + 2] AS part, string_split(parts[i + 2], chr(10))[1] AS role FROM said, (SELECT unnest(range(3)) AS i))
SELECT record_id, CAST(i AS INTEGER) AS pos, role,
  substring(part, length(role) + 2, length(part) - length(role) - 2 - length('<|im_end|>')) AS content
FROM one"""
ORACLE["normalize_chat"] = ORACLE["normalize_conversations"]

ORACLE["train_limit_by_time"] = fixture_cte("loss_log") + "\nSELECT run_id, step FROM loss_log ORDER BY ts LIMIT 2000"
ORACLE["eval_tail_by_name"] = fixture_cte("records") + """
SELECT record_id, query || ' ' || CAST(record_id AS VARCHAR) AS name FROM records ORDER BY name DESC LIMIT 100"""
ORACLE["item_quarantine"] = fixture_cte("items") + """
, told AS (SELECT *, concat_ws(',', CASE WHEN NOT coalesce(length(item_code) BETWEEN 3 AND 20, false) THEN 'item_code_length' END,
    CASE WHEN NOT coalesce(length(name) BETWEEN 2 AND 50, false) THEN 'name_length' END,
    CASE WHEN NOT coalesce(cost > 0, false) THEN 'cost_positive' END,
    CASE WHEN NOT coalesce(quantity >= 0, false) THEN 'quantity_non_negative' END) AS broken_rules FROM items)
SELECT item_code, name, CAST(cost AS DOUBLE) AS cost, quantity, item_order, broken_rules FROM told WHERE broken_rules <> ''"""
ORACLE["tool_conflicts"] = fixture_cte("flat_rows") + f"""
, ok AS (SELECT tools FROM flat_rows WHERE ({_FLAT_ERROR}) IS NULL),
t AS (SELECT unnest(json_extract(tools, '$[*]')) AS t FROM ok),
f AS (SELECT CASE WHEN json_type(t, '$.function') = 'OBJECT' THEN json_extract(t, '$.function') ELSE t END AS t FROM t WHERE json_type(t) = 'OBJECT'),
d AS (SELECT DISTINCT json_extract_string(t, '$.name') AS name, CAST(t AS VARCHAR) AS t FROM f WHERE json_type(t, '$.name') = 'VARCHAR'),
k AS (SELECT name, k AS key, json_extract(t, '$."' || k || '"')::VARCHAR AS val FROM (SELECT name, t, unnest(json_keys(t)) AS k FROM d)
      UNION ALL SELECT name, 'parameters.' || k, json_extract(t, '$.parameters."' || k || '"')::VARCHAR
      FROM (SELECT name, t, unnest(json_keys(t, '$.parameters')) AS k FROM d WHERE json_type(t, '$.parameters') = 'OBJECT')),
total AS (SELECT name, count(*) AS n_schemas FROM d GROUP BY name)
SELECT name, n_schemas, key, count(DISTINCT val) + CASE WHEN count(*) < n_schemas THEN 1 ELSE 0 END AS n_values
FROM k JOIN total USING (name) WHERE key <> 'name' GROUP BY name, n_schemas, key
HAVING count(DISTINCT val) + CASE WHEN count(*) < n_schemas THEN 1 ELSE 0 END > 1"""
