"""Queries over the messages of trajectories."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions import calls as C
from trajlake.functions.labels import cases
from trajlake.operators import audit, convert
from trajlake.sources.tables import table

from .registry import query, sql

TR = "tr AS (SELECT DISTINCT ON (record_id) * FROM trajectories ORDER BY record_id, ingested_at NULLS LAST)"
MSG = f"{TR}, msg AS (SELECT record_id, unnest(messages) AS m, generate_subscripts(messages, 1) AS i FROM tr)"
# Letters of other scripts as 'x': RE2's word boundaries know ASCII only.
LATIN = r"regexp_replace({}, '[\p{{Lo}}\p{{Lm}}À-ɏ]', 'x', 'g')"
CALLS = f"""{MSG}, parsed AS (SELECT record_id, i, from_json(m.tool_calls, '[{{"id":"VARCHAR","function":{{"name":"VARCHAR","arguments":"JSON"}}}}]') AS cs FROM msg WHERE m.role = 'assistant' AND m.tool_calls IS NOT NULL),
each AS (SELECT record_id, i, unnest(cs) AS c, generate_subscripts(cs, 1) AS j FROM parsed),
calls AS (SELECT record_id, i, j, c.id AS id, c.function.name AS name, CASE WHEN json_type(c.function.arguments) = 'VARCHAR' THEN c.function.arguments ->> '$' ELSE c.function.arguments::VARCHAR END AS arguments FROM each)"""


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def deliveries(spark, folder, *more):
    """record_id, ingested_at and messages of every delivery, and more columns if named."""
    return table(spark, folder, "trajectories").select("record_id", "ingested_at", "messages", *more)


def once(rows):
    """One row a record. Rows are measured where they are read and the narrow results deduplicated, so no text is shuffled."""
    return audit.latest_delivery(rows).drop("ingested_at")


KEY = ["record_id", "ingested_at"]


@query(
    "role_profile",
    f"""WITH {MSG} SELECT m.role AS role, count(*) AS messages, count(m.content) AS with_content, count(m.reasoning_content) AS with_reasoning_content, count(m.tool_call_id) AS with_tool_call_id,
count(m.tool_calls) AS with_tool_calls, coalesce(sum(length(m.content)), 0)::BIGINT AS characters FROM msg GROUP BY ALL""",
)
def role_profile(spark, folder):
    return audit.role_profile_of(once(deliveries(spark, folder).select(*KEY, audit.message_fields(F.col("messages")).alias("fields"))))


@query("final_roles", f"WITH {TR} SELECT messages[-1].role AS role, count(*) AS records FROM tr GROUP BY ALL")
def final_roles(spark, folder):
    return once(deliveries(spark, folder).select(*KEY, C.last_role(F.col("messages")).alias("role"))).groupBy("role").agg(F.count(F.lit(1)).alias("records"))


@query(
    "first_and_last",
    f"""WITH {TR} SELECT record_id, length(list_filter(messages, lambda m: m.role = 'user' AND m.content IS NOT NULL)[1].content) AS first_user_chars,
length(coalesce(list_filter(list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: trim(coalesce(m.content, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(133) || chr(160) || chr(12288))), lambda t: t <> '')[-1], '')) AS answer_chars FROM tr""",
)
def first_and_last(spark, folder):
    m = F.col("messages")
    return once(deliveries(spark, folder).select(*KEY, F.length(C.first_user(m)).alias("first_user_chars"), F.length(C.final_answer(m)).alias("answer_chars")))


def _sum(role, field="content"):
    where = f" FILTER (m.role = '{role}')" if role else ""
    return f"coalesce(sum(length(m.{field})){where}, 0)::BIGINT"


AUDITED = ["system_chars", "system_fingerprint", "total_chars", "assistant_content_chars", "reasoning_chars", "tool_response_chars", "tool_response_char_ratio", "tool_response_messages", "tool_response_max_chars", "tool_response_over_4096", "tool_error_messages", "final_assistant_chars"]
TOTAL = f"({_sum('')} + {_sum('assistant', 'reasoning_content')})"


@query(
    "record_audit",
    f"""WITH {MSG} SELECT record_id, {_sum('system')} AS system_chars, sha256(coalesce(string_agg(coalesce(m.content, ''), chr(10) ORDER BY i) FILTER (m.role = 'system'), '')) AS system_fingerprint,
{TOTAL} AS total_chars, {_sum('assistant')} AS assistant_content_chars, {_sum('assistant', 'reasoning_content')} AS reasoning_chars, {_sum('tool')} AS tool_response_chars,
round_even(coalesce({_sum('tool')}::DOUBLE / nullif({TOTAL}, 0), 0), 6) AS tool_response_char_ratio, count(*) FILTER (m.role = 'tool') AS tool_response_messages,
coalesce(max(length(coalesce(m.content, ''))) FILTER (m.role = 'tool'), 0) AS tool_response_max_chars, count(*) FILTER (m.role = 'tool' AND length(m.content) > 4096) AS tool_response_over_4096,
count(*) FILTER (m.role = 'tool' AND regexp_matches({LATIN.format('m.content')}, {q(C.TOOL_ERROR)})) AS tool_error_messages, length(coalesce(arg_max(coalesce(m.content, ''), i) FILTER (m.role = 'assistant'), '')) AS final_assistant_chars,
any_value(listed) AS top_level_tools_present FROM msg JOIN (SELECT record_id, coalesce(json_type(CASE WHEN json_valid(tools) THEN tools END) = 'ARRAY', false) AS listed FROM tr) USING (record_id) GROUP BY record_id""",
)
def record_audit(spark, folder):
    rows = audit.audit(deliveries(spark, folder, "tools")).withColumn("top_level_tools_present", audit.is_list("tools"))
    return once(rows.select(*KEY, *AUDITED, "top_level_tools_present"))


ARGS = LATIN.format("arguments")
PATHS = f"len(regexp_extract_all(coalesce({{}}, ''), {q(C.LOCAL_PATH)}))"


def secret(x: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, {q(p)})" for p in C.SECRETS) + ")"



@query(
    "safety_audit",
    f"""WITH {CALLS}, a AS (SELECT record_id, count(*) AS n_calls, count(*) FILTER (name = 'bash' AND regexp_matches({ARGS}, {q(C.DESTRUCTIVE)})) AS destructive, count(*) FILTER (name = 'bash' AND regexp_matches({ARGS}, {q(C.NETWORK)})) AS network,
  sum({PATHS.format('arguments')}) AS paths, count(*) FILTER ({secret(ARGS)}) AS secrets FROM calls GROUP BY ALL),
b AS (SELECT record_id, sum({PATHS.format('m.content')} + CASE WHEN m.role = 'assistant' THEN {PATHS.format('m.reasoning_content')} ELSE 0 END) AS paths,
  count(*) FILTER ({secret(LATIN.format('m.content'))}) + count(*) FILTER (m.role = 'assistant' AND {secret(LATIN.format('m.reasoning_content'))}) AS secrets FROM msg GROUP BY ALL)
SELECT record_id, coalesce(n_calls, 0) AS tool_calls, coalesce(destructive, 0) AS destructive_commands, coalesce(network, 0) AS network_commands, (coalesce(a.paths, 0) + b.paths)::BIGINT AS nonportable_path_occurrences, coalesce(a.secrets, 0) + b.secrets AS secret_pattern_hits FROM b LEFT JOIN a USING (record_id)""",
)
def safety_audit(spark, folder):
    rows = audit.with_calls(deliveries(spark, folder))
    metrics = audit.record_metrics()
    names = ["destructive_commands", "network_commands", "nonportable_path_occurrences", "secret_pattern_hits"]
    return once(rows.select(*KEY, F.size("calls").alias("tool_calls"), *(metrics[n].alias(n) for n in names)))


@query("call_signatures")
def call_signatures(spark, folder):
    """Calls, repeated and directly repeated calls of each record."""
    signs = C.signatures(F.col("calls"))
    rows = audit.with_calls(deliveries(spark, folder)).select(*KEY, signs.alias("s"))
    return once(rows.select(*KEY, F.size("s").alias("calls"), C.repeats(F.col("s")).alias("duplicates"), C.adjacent_repeats(F.col("s")).alias("consecutive")))


@query("tool_usage", f"WITH {CALLS} SELECT name, count(*) AS calls, count(DISTINCT record_id) AS records, count(id) AS with_id FROM calls GROUP BY ALL")
def tool_usage(spark, folder):
    used = F.transform(C.tool_calls(F.col("messages")), lambda c: F.struct(c["name"].alias("name"), c["id"].isNotNull().alias("with_id")))
    rows = once(deliveries(spark, folder).select(*KEY, used.alias("used"))).select("record_id", F.inline("used"))
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("calls"), F.count_distinct("record_id").alias("records"), F.count_if("with_id").alias("with_id"))


@query(
    "argument_keys",
    f"""WITH {CALLS}, k AS (SELECT name, unnest(CASE WHEN json_valid(arguments) AND json_type(CASE WHEN json_valid(arguments) THEN arguments END) = 'OBJECT' THEN json_keys(CASE WHEN json_valid(arguments) THEN arguments END) ELSE [NULL] END) AS key FROM calls)
SELECT name, key, count(*) AS calls FROM k GROUP BY ALL""",
)
def argument_keys(spark, folder):
    return audit.argument_keys_of(once(deliveries(spark, folder).select(*KEY, audit.keys_used().alias("used"))))


@query("canonical_tools")
def canonical_tools(spark, folder):
    """Records by the first problem of their calls."""
    rows = once(audit.with_calls(deliveries(spark, folder)).select(*KEY, C.tools_status(F.col("calls")).alias("status")))
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("records"))


@query(
    "round_trips",
    f"""WITH {CALLS}, k AS (SELECT record_id, id, min(i) AS i FROM calls WHERE id IS NOT NULL GROUP BY ALL),
r AS (SELECT msg.record_id, m.tool_call_id AS id, k.id IS NOT NULL AS heard FROM msg LEFT JOIN k ON k.record_id = msg.record_id AND k.id = m.tool_call_id AND k.i < msg.i WHERE m.role = 'tool'),
n AS (SELECT record_id, count(*) AS calls FROM calls GROUP BY ALL), s AS (SELECT record_id, count(*) AS responses, count(*) FILTER (NOT heard) AS unknown, count(*) FILTER (heard) - count(DISTINCT id) FILTER (heard) AS repeated FROM r GROUP BY ALL),
u AS (SELECT record_id, count(*) AS unanswered FROM k WHERE NOT EXISTS (SELECT 1 FROM r WHERE heard AND r.record_id = k.record_id AND r.id = k.id) GROUP BY ALL)
SELECT record_id, coalesce(calls, 0) AS calls, coalesce(responses, 0) AS responses, coalesce(unknown, 0) AS unknown, coalesce(repeated, 0) AS repeated, coalesce(unanswered, 0) AS unanswered FROM tr LEFT JOIN n USING (record_id) LEFT JOIN s USING (record_id) LEFT JOIN u USING (record_id)""",
)
def round_trips(spark, folder):
    return once(audit.round_trips(deliveries(spark, folder), *KEY))


@query("converted_messages")
def converted_messages(spark, folder):
    """Error of each record's conversion, or its statistics and a digest of all texts but those of calls."""
    rows = convert.convert(deliveries(spark, folder))
    said = F.transform(F.filter("converted", lambda x: x["role"] != "tool_call"), lambda x: F.concat(x["role"], F.lit("\1"), x["content"]))
    return once(rows.select(*KEY, "error", "conversion.*", F.md5(F.array_join(said, "\2")).alias("said_md5")))


@query("conversion_errors")
def conversion_errors(spark, folder):
    rows = once(convert.convert(deliveries(spark, folder)).select(*KEY, "error", "conversion.output_messages"))
    return rows.groupBy(F.coalesce("error", F.lit("none")).alias("error")).agg(F.count(F.lit(1)).alias("records"), F.coalesce(F.sum("output_messages"), F.lit(0)).alias("messages"))


@query(
    "long_responses",
    f"WITH {MSG} SELECT CASE WHEN length(m.content) > 4096 THEN 'over_4096' WHEN length(m.content) > 512 THEN '513-4096' ELSE '0-512' END AS bucket, count(*) AS responses, count(DISTINCT record_id) AS records FROM msg WHERE m.role = 'tool' AND m.content IS NOT NULL GROUP BY ALL",
)
def long_responses(spark, folder):
    sizes = F.transform(F.filter("messages", lambda m: (m["role"] == "tool") & m["content"].isNotNull()), lambda m: F.length(m["content"]))
    rows = once(deliveries(spark, folder).select(*KEY, sizes.alias("sizes"))).select("record_id", F.explode("sizes").alias("n"))
    n = F.col("n")
    return rows.groupBy(cases([(n > 4096, "over_4096"), (n > 512, "513-4096")], F.lit("0-512")).alias("bucket")).agg(F.count(F.lit(1)).alias("responses"), F.count_distinct("record_id").alias("records"))


# the rules as SQL need the message tables above
from . import rules_sql as R  # noqa: E402

sql("call_signatures", f"WITH {R.SIGNED} SELECT record_id, count(s) AS calls, count(s) - count(DISTINCT s) AS duplicates, count(*) FILTER (s = before) AS consecutive FROM tr LEFT JOIN followed USING (record_id) GROUP BY ALL")
sql("canonical_tools", f"WITH {R.CALL_ROWS}, {R.TOOL_STATUS} SELECT status, count(*) AS records FROM tool_status GROUP BY ALL")
sql("converted_messages", f"WITH {R.CONVERTED} SELECT * FROM converted")
sql("conversion_errors", f"WITH {R.CONVERTED} SELECT coalesce(error, 'none') AS error, count(*) AS records, coalesce(sum(output_messages), 0)::BIGINT AS messages FROM converted GROUP BY ALL")
