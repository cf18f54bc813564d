"""The rules of tool calls, conversion and evidence as DuckDB SQL, to hold the engine's results against.

Written from the definitions, in relational form: one row for each message, call and error.
"""

from __future__ import annotations

from trajlake.functions import calls as C
from trajlake.functions import keys
from trajlake.operators import convert as V

from .message_queries import MSG

BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || ' ' || chr(133) || chr(160) || chr(8232) || chr(8233) || chr(12288)"
NOTHING = ", ".join(f"'{x}'" for x in C.NOTHING)


def trimmed(x: str) -> str:
    return f"trim(coalesce({x}, ''), {BLANKS})"


#: One row a call of an assistant message: c its JSON, and kinds and texts of its members.
CALL_ROWS = f"""{MSG}, given AS (SELECT record_id, i, m.tool_calls AS t FROM msg WHERE m.role = 'assistant' AND m.tool_calls IS NOT NULL AND trim(m.tool_calls) <> ''),
lists AS (SELECT record_id, i, from_json(t, '["JSON"]') AS cs FROM given WHERE json_valid(t) AND json_type(t) = 'ARRAY'),
each_call AS (SELECT record_id, i, unnest(cs) AS c, generate_subscripts(cs, 1) AS j FROM lists),
call_rows AS (SELECT record_id, i, j, CASE WHEN json_type(c -> 'id') = 'VARCHAR' THEN c ->> 'id' END AS id, json_type(c -> 'function') AS f_kind, json_type(c -> 'function' -> 'name') AS n_kind,
  c -> 'function' ->> 'name' AS name, json_type(c -> 'function' -> 'arguments') AS a_kind, CASE WHEN json_type(c -> 'function' -> 'arguments') <> 'NULL' THEN c -> 'function' ->> 'arguments' END AS arguments FROM each_call),
typed_calls AS (SELECT *, coalesce(json_valid(arguments), false) AS valid, CASE WHEN json_valid(arguments) THEN json_type(CASE WHEN json_valid(arguments) THEN arguments END) END AS kind, CASE WHEN json_valid(arguments) THEN arguments::JSON END AS a FROM call_rows)"""

#: Equal parsed arguments have equal lists of places and values.
SIGNED = f"""{CALL_ROWS}, atoms AS (SELECT record_id, i, j, list_sort(list(concat_ws(' ', t.fullkey, t.type, t.atom))) AS parts FROM typed_calls, LATERAL (SELECT * FROM json_tree(a)) t WHERE valid GROUP BY ALL),
signed AS (SELECT record_id, c.i, c.j, coalesce(c.name, '') || chr(1) || coalesce(atoms.parts::VARCHAR, 'text ' || coalesce(c.arguments, '')) AS s FROM typed_calls c LEFT JOIN atoms USING (record_id, i, j)),
followed AS (SELECT *, lag(s) OVER (PARTITION BY record_id ORDER BY i, j) AS before FROM signed)"""


def _is(member: str, kind: str) -> str:
    return f"coalesce(json_type(a -> '{member}') = '{kind}', false)"


def _whole(member: str, least: int) -> str:
    kind = f"json_type(a -> '{member}')"
    return f"({kind} IS NULL OR {kind} = 'NULL' OR ({kind} IN ('BIGINT', 'UBIGINT') AND (a ->> '{member}')::DOUBLE >= {least}))"


def _names(table: dict, name: str) -> str:
    return "CASE " + " ".join(f"WHEN {name} = '{t}' THEN {list(table[t])}" for t in C.TOOLS) + " END"


WHOLE_EDITS = "json_type(a -> 'edits') = 'ARRAY' AND json_array_length(a, 'edits') > 0 AND len(list_filter(from_json(CASE WHEN json_type(a -> 'edits') = 'ARRAY' THEN a -> 'edits' END, '[\"JSON\"]'), lambda e: NOT (json_type(e) = 'OBJECT' AND coalesce(json_type(e -> 'oldText') = 'VARCHAR', false) AND coalesce(json_type(e -> 'newText') = 'VARCHAR', false) AND len(json_keys(e)) = 2))) = 0"
PROBLEM = f"""CASE WHEN name IS NULL OR name NOT IN {C.TOOLS} THEN 'noncanonical_tool_name' WHEN kind IS DISTINCT FROM 'OBJECT' THEN 'non_object_arguments'
WHEN NOT list_has_all(json_keys(a), {_names(C.REQUIRED, 'name')}) THEN 'missing_required_argument' WHEN NOT list_has_all({_names(C.ALLOWED, 'name')}, json_keys(a)) THEN 'noncanonical_argument_key'
WHEN name = 'bash' AND NOT ({_is('command', 'VARCHAR')} AND {_whole('timeout', 1)}) THEN 'invalid_argument_value'
WHEN name = 'read' AND NOT ({_is('path', 'VARCHAR')} AND {_whole('offset', 0)} AND {_whole('limit', 1)}) THEN 'invalid_argument_value'
WHEN name = 'write' AND NOT ({_is('path', 'VARCHAR')} AND {_is('content', 'VARCHAR')}) THEN 'invalid_argument_value'
WHEN name = 'edit' AND NOT ({_is('path', 'VARCHAR')} AND (({_is('oldText', 'VARCHAR')} AND {_is('newText', 'VARCHAR')}) OR coalesce({WHOLE_EDITS}, false))) THEN 'invalid_argument_value' END"""
#: record_id and status: the first problem of its calls.
TOOL_STATUS = f"""problems AS (SELECT record_id, i, j, {PROBLEM} AS problem FROM typed_calls),
tool_status AS (SELECT tr.record_id, CASE WHEN count(p.record_id) = 0 THEN 'no_tool_calls' ELSE coalesce(arg_min(p.problem, (p.i, p.j)) FILTER (p.problem IS NOT NULL), 'canonical') END AS status FROM tr LEFT JOIN problems p USING (record_id) GROUP BY ALL)"""

END = 2**31 - 1
SAID = f"CASE WHEN {trimmed('m.reasoning_content')} <> '' THEN '<think>' || chr(10) || {trimmed('m.reasoning_content')} || chr(10) || '</think>' || chr(10) || chr(10) ELSE '' END || {trimmed('m.content')}"


def _errors(rows: list[tuple[str, str, int, str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT record_id, {i} AS i, {j} AS j, {k} AS k, '{name}' AS error FROM {source}" for i, j, k, name, source in rows)


#: record_id and error: the first one in reading order.
ERRORS = f"""spoken AS (SELECT *, CASE WHEN m.role = 'assistant' THEN {SAID} END AS said FROM msg),
numbered_calls AS (SELECT *, row_number() OVER (PARTITION BY record_id, id ORDER BY i, j) AS nth FROM typed_calls),
responses AS (SELECT record_id, i, m.tool_call_id AS id, row_number() OVER (PARTITION BY record_id, m.tool_call_id ORDER BY i) AS nth FROM msg WHERE m.role = 'tool'),
errors AS ({_errors([
    ("i", "-1", 0, V.CONTENT, "msg WHERE m.content IS NULL"),
    ("i", "-1", 1, V.ROLE, "msg WHERE m.role IS NULL OR m.role NOT IN ('system', 'user', 'assistant', 'tool')"),
    ("i", "-1", 3, V.CALL_LIST, f"given WHERE NOT json_valid(t) OR (json_type(CASE WHEN json_valid(t) THEN t END) <> 'ARRAY' AND json(CASE WHEN json_valid(t) THEN t END) NOT IN ({NOTHING}))"),
    ("i", "j", 4, V.CALL_FUNCTION, "typed_calls WHERE f_kind IS DISTINCT FROM 'OBJECT'"),
    ("i", "j", 5, V.CALL_NAME, "typed_calls WHERE n_kind IS DISTINCT FROM 'VARCHAR' OR name = ''"),
    ("i", "j", 6, V.ARGUMENTS_JSON, "typed_calls WHERE a_kind = 'VARCHAR' AND NOT valid"),
    ("i", "j", 7, V.ARGUMENTS_OBJECT, "typed_calls WHERE a_kind = 'NULL' OR (valid AND kind <> 'OBJECT')"),
    ("i", "j", 8, V.TWICE_CALLED, "numbered_calls WHERE id IS NOT NULL AND nth > 1"),
    ("i", "-1", 9, V.UNKNOWN, "responses r WHERE NOT EXISTS (SELECT 1 FROM typed_calls c WHERE c.record_id = r.record_id AND c.id = r.id AND c.i < r.i)"),
    ("i", "-1", 10, V.TWICE_ANSWERED, "responses WHERE id IS NOT NULL AND nth > 1"),
    (END, "-1", 11, V.UNANSWERED, "typed_calls c WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM responses r WHERE r.record_id = c.record_id AND r.id = c.id)"),
    (END, "-1", 12, V.NOTHING, "tr WHERE record_id NOT IN (SELECT record_id FROM spoken WHERE said <> '') AND record_id NOT IN (SELECT record_id FROM typed_calls)"),
])}),
first_error AS (SELECT record_id, arg_min(error, (i, j, k)) AS error FROM errors GROUP BY ALL)"""

#: record_id, error and, without error, the statistics of what is converted.
CONVERTED = f"""{CALL_ROWS}, {ERRORS},
called AS (SELECT record_id, count(*) AS tool_calls, sum(length('{{"name":' || to_json(name)::VARCHAR || ',"arguments":' || coalesce(json(CASE WHEN valid THEN arguments END), '{{}}')::VARCHAR || '}}')) AS characters FROM typed_calls GROUP BY ALL),
told AS (SELECT record_id, count(*) FILTER (m.role = 'assistant' AND {trimmed('m.reasoning_content')} <> '') AS reasoning_messages, count(*) FILTER (said <> '') AS assistant_content_messages, count(*) FILTER (m.role = 'tool') AS tool_responses,
  count(*) FILTER (m.role IN ('system', 'user')) AS prompts, coalesce(sum(length(coalesce(said, m.content))), 0) AS characters,
  md5(coalesce(string_agg(CASE WHEN m.role = 'tool' THEN 'tool_response' ELSE m.role END || chr(1) || coalesce(said, m.content), chr(2) ORDER BY i) FILTER (coalesce(said, 'x') <> ''), '')) AS said_md5 FROM spoken GROUP BY ALL),
converted AS (SELECT record_id, error, CASE WHEN error IS NULL THEN reasoning_messages END AS reasoning_messages, CASE WHEN error IS NULL THEN assistant_content_messages END AS assistant_content_messages,
  CASE WHEN error IS NULL THEN coalesce(tool_calls, 0) END AS tool_calls, CASE WHEN error IS NULL THEN tool_responses END AS tool_responses,
  CASE WHEN error IS NULL THEN prompts + assistant_content_messages + coalesce(tool_calls, 0) + tool_responses END AS output_messages,
  CASE WHEN error IS NULL THEN (told.characters + coalesce(called.characters, 0))::BIGINT END AS characters, CASE WHEN error IS NULL THEN said_md5 END AS said_md5
  FROM tr LEFT JOIN first_error USING (record_id) LEFT JOIN told USING (record_id) LEFT JOIN called USING (record_id))"""


# --- evidence ------------------------------------------------------------------------------------

NUMBER = r"(?:^|[^A-Za-z_])([-+]?\d+(?:,\d{3})*(?:\.\d+)?%?)"
ITEM_PREFIX = r"(?m)^\s*(?:[-*]>#]+|\d+[.)、])\s*"


def folded(x: str) -> str:
    return rf"regexp_replace(lower({keys.narrow_sql(x)}), '[^\p{{L}}\p{{N}}]', '', 'g')"


def numbers(x: str) -> str:
    """The distinct numbers of a text in one spelling, as a sorted list."""
    # the sign of a number right after another one, and what follows a per cent sign, get something before them to match
    plain = rf"regexp_replace(regexp_replace(regexp_replace({keys.narrow_sql(x)}, '{ITEM_PREFIX}', '', 'g'), '([^A-Za-z_])([-+])', '\1' || chr(1) || '\2', 'g'), '%', '%' || chr(1), 'g')"
    spelled = "format('{:.12g}', replace(replace(replace(n, ',', ''), '%', ''), '+', '')::DOUBLE) || CASE WHEN ends_with(n, '%') THEN '%' ELSE '' END"
    return f"list_sort(list_distinct(list_transform(regexp_extract_all({plain}, '{NUMBER}', 1), lambda n: {spelled})))"


ANSWERS = f"answers AS (SELECT record_id, coalesce(list_filter(list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: {trimmed('m.content')}), lambda t: t <> '')[-1], '') AS answer FROM tr)"


def coverage(name: str, source: str, columns: str = "record_id, n, claim, evidence") -> str:
    """CTE name(record_id, n, coverage) of source(record_id, n, claim, evidence), both folded."""
    grams = lambda x: f"unnest(list_distinct(list_transform(range(1, greatest(1, length({x}) - 1) + 1), lambda p: substr({x}, p, 2))))"
    return f"""{name}_c AS (SELECT record_id, n, {grams('claim')} AS g FROM {source} WHERE claim <> '' AND evidence <> '' AND NOT contains(evidence, claim)),
{name}_e AS (SELECT record_id, {grams('evidence')} AS g FROM (SELECT DISTINCT record_id, evidence FROM {source})),
{name}_s AS (SELECT c.record_id, n, format('{{:.6f}}', count(e.g)::DOUBLE / count(*))::DOUBLE AS share FROM {name}_c c LEFT JOIN {name}_e e USING (record_id, g) GROUP BY ALL),
{name} AS (SELECT record_id, n, CASE WHEN claim = '' OR evidence = '' THEN 0.0 WHEN contains(evidence, claim) THEN 1.0 ELSE share END::DOUBLE AS coverage FROM {source} LEFT JOIN {name}_s USING (record_id, n))"""


def evidence(manifest: str) -> str:
    """CTEs up to decided(record_id, answer, status, reason, confidence and the scores)."""
    gold = "CASE WHEN json_valid(gold_answer) AND json_type(gold_answer) = 'OBJECT' THEN concat_ws(chr(10), coalesce(gold_answer ->> 'text', ''), CASE WHEN json_type(gold_answer -> 'value') <> 'NULL' THEN json(gold_answer -> 'value')::VARCHAR END) WHEN json_valid(gold_answer) THEN coalesce(gold_answer ->> '$', gold_answer) ELSE coalesce(gold_answer, '') END"
    ids = lambda *parts: f"list_sort(list_distinct(list_filter(list_concat({', '.join(parts)}), lambda x: x IS NOT NULL AND x <> '')))"
    claims = f"list_filter(list_transform(regexp_split_to_array(regexp_replace(answer, '{ITEM_PREFIX}', '', 'g'), '[。！？；' || chr(10) || ']+'), lambda t: {folded('t')}), lambda t: length(t) >= 8)"
    return f"""{CALL_ROWS}, {ANSWERS}, {manifest},
edges AS (SELECT version, task_id, min(fp) <> max(fp) AS conflict, arg_min(fp, fp) AS fp FROM mf GROUP BY ALL),
mm AS (SELECT DISTINCT ON (version, task_id) version, task_id, conflict, {gold} AS gold, CASE WHEN json_valid(gold_answer) AND json_type(gold_answer) = 'OBJECT' THEN coalesce(gold_answer ->> 'answer_type', '') ELSE '' END AS answer_type,
  coalesce(instruction, '') AS instruction, lower(type) AS m_type, {ids('[citation.doc_id]', 'coalesce(source_documents, [])')} AS documents,
  list_distinct(list_transform({ids('coalesce(expected_tables, [])', 'coalesce(verification_criteria.must_query_tables, [])')}, lambda t: lower(t))) AS tables FROM mf JOIN edges USING (version, task_id, fp)),
cat AS (SELECT record_id, version, {keys.task_sql('task_id')} AS task_id, {keys.label_sql('type')} AS type, {keys.tier_sql('quality_tier')} AS quality_tier
  FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY cataloged_at DESC NULLS LAST) AS n FROM token_catalog) WHERE n = 1),
heard AS (SELECT record_id, coalesce(string_agg(coalesce(m.content, ''), chr(10) ORDER BY i) FILTER (m.role = 'tool'), '') AS responses FROM msg GROUP BY ALL),
asked AS (SELECT record_id, string_agg(concat_ws(chr(10), coalesce(name, ''), arguments), chr(10) ORDER BY i, j) AS called FROM typed_calls GROUP BY ALL),
base AS (SELECT cat.record_id, quality_tier, CASE WHEN cat.type NOT IN ('unknown', '') THEN cat.type WHEN m_type NOT IN ('unknown', '') THEN m_type ELSE '' END AS type, coalesce(conflict, false) AS conflict, conflict IS NOT NULL AS present, coalesce(answer, '') AS answer,
  coalesce(responses, '') AS responses, coalesce(called, '') AS called, coalesce(gold, '') AS gold, coalesce(answer_type, '') AS answer_type, coalesce(instruction, '') AS instruction, coalesce(documents, []) AS documents, coalesce(tables, []) AS tables
  FROM cat JOIN (SELECT record_id FROM tr) USING (record_id) LEFT JOIN mm USING (version, task_id) LEFT JOIN answers USING (record_id) LEFT JOIN heard USING (record_id) LEFT JOIN asked USING (record_id)),
open_ AS (SELECT *, {claims} AS claims, {folded("responses")} AS known FROM base WHERE present AND NOT conflict),
claim_rows AS (SELECT record_id, unnest(CASE WHEN len(claims) > 0 THEN claims ELSE [{folded('answer')}] END) AS claim, generate_subscripts(CASE WHEN len(claims) > 0 THEN claims ELSE [''] END, 1) AS n, known AS evidence FROM open_),
{coverage('covered', 'claim_rows')},
weighted AS (SELECT record_id, max(len(o.claims)) AS n_claims, max(coverage) AS whole, sum(round(coverage * 1e6)::BIGINT * length(claim)) AS millionths, sum(length(claim)) AS size FROM covered JOIN claim_rows USING (record_id, n) JOIN open_ o USING (record_id) GROUP BY ALL),
supported AS (SELECT record_id, CASE WHEN n_claims > 0 THEN (millionths // size + CASE WHEN 2 * (millionths % size) > size OR (2 * (millionths % size) = size AND (millionths // size) % 2 = 1) THEN 1 ELSE 0 END) / 1e6 ELSE whole END::DOUBLE AS support FROM weighted),
gold_rows AS (SELECT record_id, 1 AS n, {folded('gold')} AS claim, {folded('answer')} AS evidence FROM open_),
{coverage('golden', 'gold_rows')},
scored AS (SELECT o.*, support, golden.coverage AS gold_overlap, {numbers('gold')} AS wanted, {numbers('answer')} AS given_, {numbers("responses || chr(10) || called || chr(10) || instruction")} AS seen,
  len(list_filter(documents, lambda d: contains({folded("responses || chr(10) || called")}, {folded('d')}))) AS documents_accessed, len(list_filter(tables, lambda t: contains(lower(called), t))) AS tables_accessed
  FROM open_ o JOIN supported USING (record_id) JOIN golden USING (record_id)),
metrics AS (SELECT record_id, support, gold_overlap, len(wanted) AS gold_numbers, list_has_all(given_, wanted) AS gold_numbers_match, len(list_filter(given_, lambda x: NOT list_contains(seen, x))) AS unsupported_numbers, documents_accessed, tables_accessed FROM scored),
shares AS (SELECT base.*, support, gold_overlap, gold_numbers, gold_numbers_match, unsupported_numbers, documents_accessed, tables_accessed, documents_accessed / greatest(1, len(documents)) AS doc_share, tables_accessed / greatest(1, len(tables)) AS table_share FROM base LEFT JOIN metrics USING (record_id)),
judged AS (SELECT *, CASE WHEN conflict THEN 'manual_review manifest_conflict high' WHEN NOT present THEN 'manual_review manifest_missing high'
  WHEN quality_tier = 'sql_result_verified' THEN 'auto_pass sql_result_verified high' WHEN answer = '' THEN 'auto_reject empty_final_answer high'
  WHEN type = 'kb' THEN CASE WHEN len(documents) > 0 AND doc_share = 0 AND support < 0.5 THEN 'auto_reject expected_document_not_used high' WHEN unsupported_numbers > 0 AND support < 0.7 THEN 'manual_review unsupported_numeric_claim medium'
    WHEN doc_share = 1 AND support >= 0.9 AND gold_numbers_match THEN 'auto_pass kb_grounded_in_expected_document high' WHEN doc_share = 1 AND support >= 0.8 AND gold_overlap >= 0.65 AND gold_numbers_match THEN 'auto_pass kb_gold_and_document_supported medium'
    ELSE 'manual_review kb_semantic_scope_uncertain medium' END
  WHEN len(tables) > 0 AND table_share < 1 THEN 'auto_reject expected_table_missing high' WHEN unsupported_numbers > 0 AND support < 0.5 THEN 'manual_review unsupported_numeric_claim medium'
  WHEN answer_type IN ('numeric', 'table') AND table_share = 1 AND support >= 0.85 AND gold_numbers_match AND unsupported_numbers = 0 THEN 'auto_pass recorded_query_evidence_matches_gold medium'
  ELSE 'manual_review execution_or_semantic_review_required medium' END AS verdict FROM shares),
decided AS (SELECT *, split_part(verdict, ' ', 1) AS status, split_part(verdict, ' ', 2) AS reason, split_part(verdict, ' ', 3) AS confidence FROM judged)"""
