"""Queries that join trajectories with manifests and verdicts: identity, candidates, evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions import calls as C
from trajlake.functions import keys
from trajlake.functions.labels import first_of
from trajlake.functions.text import bigram_coverage, nfkc, numbers
from trajlake.operators import audit, convert, identity, ingest, review
from trajlake.sources.jsonl import file_version
from trajlake.sources.tables import table

from .catalog_queries import catalog, settled_verdicts
from . import rules_sql as R
from .message_queries import TR
from .registry import query


def manifest(spark, folder):
    rows = table(spark, folder, "task_manifest").withColumnRenamed("v", "version")
    return rows.withColumn("task_id", keys.task_key(F.col("task_id")))


def settled_manifest(spark, folder):
    """One row a version and task, with conflict: whether rows of unlike contents exist."""
    rows = manifest(spark, folder).withColumn("fingerprint", review.manifest_fingerprint())
    return ingest.first_of_key(rows, ["version", "task_id"], "fingerprint", ["fingerprint"])


MANIFEST = f"""mf AS (SELECT v AS version, {keys.task_sql('task_id')} AS task_id, * EXCLUDE (v, task_id), concat_ws(chr(1), citation::VARCHAR, expected_tables::VARCHAR, gold_answer, coalesce(instruction, chr(2)), source_documents::VARCHAR, coalesce(type, chr(2))) AS fp FROM task_manifest)"""


@query("manifest_conflicts", f"WITH {MANIFEST} SELECT version, task_id, min(fp) <> max(fp) AS conflict FROM mf GROUP BY ALL")
def manifest_conflicts(spark, folder):
    return settled_manifest(spark, folder).select("version", "task_id", "conflict")


@query(
    "manifest_ordinals",
    f"""WITH {MANIFEST}, r AS (SELECT version, task_id, coalesce(nullif(regexp_extract(output, '([^/]+)/*$', 1), ''), task_id) AS k, coalesce(trim(instruction), '') AS i FROM mf WHERE instruction IS NOT NULL AND task_id IS NOT NULL)
SELECT version, task_id, row_number() OVER (PARTITION BY version ORDER BY k, task_id, i) AS ordinal FROM r""",
)
def manifest_ordinals(spark, folder):
    rows = manifest(spark, folder).select(F.col("version").alias("v"), "task_id", "instruction", "output", F.trim("instruction").alias("i"), F.col("task_id").alias("t"))
    return identity.manifest_index(rows, F.col("instruction"), F.col("output"), ["t", "i"]).select("version", F.col("task").alias("task_id"), "ordinal")


@query(
    "expected_ids",
    f"""WITH {MANIFEST} SELECT version, task_id, list_sort(list_distinct(list_filter(list_concat([citation.doc_id], coalesce(source_documents, [])), lambda x: x IS NOT NULL AND x <> ''))) AS documents,
list_sort(list_distinct(list_filter(list_concat(coalesce(expected_tables, []), coalesce(verification_criteria.must_query_tables, [])), lambda x: x IS NOT NULL AND x <> ''))) AS tables FROM mf""",
)
def expected_ids(spark, folder):
    rows = manifest(spark, folder)
    documents = review.expected(F.col("citation.doc_id"), [F.col("source_documents")])
    tables = review.expected(None, [F.col("expected_tables"), F.col("verification_criteria.must_query_tables")])
    return rows.select("version", "task_id", F.array_sort(documents).alias("documents"), F.array_sort(tables).alias("tables"))


def located(rows, *keep):
    """Deliveries with messages as one row a record: version, line, source (the task folder in _source), first user text and keep.

    What is needed of the messages is computed where they are read; the messages aren't shuffled.
    """
    folder_name = F.regexp_extract("_source", r"([^/]+)/[^/]+$", 1)
    rows = rows.select(
        "record_id",
        "ingested_at",
        "source_file",
        file_version(F.col("source_file"), strict=False).alias("version"),
        F.col("source_line").alias("line"),
        F.when(folder_name != "", keys.task_key(folder_name)).alias("source"),
        C.first_user(F.col("messages")).alias("user_text"),
        *keep,
    )
    return audit.latest_delivery(rows).drop("ingested_at")


def resolved(spark, folder, *keep, rows=None):
    if rows is None:
        rows = located(table(spark, folder, "trajectories"))
    rows = rows.withColumn("text", nfkc(F.col("user_text")))
    m = manifest(spark, folder)
    # sources are task folders here, so the manifest's output is compared without its ending
    m = m.select(F.col("version").alias("v"), "task_id", nfkc(F.col("instruction")).alias("instruction"), keys.task_key(F.regexp_replace("output", r"\.[a-z]+$", "")).alias("output"), F.col("task_id").alias("t"))
    m = m.withColumn("output", F.regexp_extract("output", r"([^/]+)/*$", 1)).distinct()
    index = identity.manifest_index(m, F.col("instruction"), keys.task_key(F.col("output")), ["t", "instruction"])
    return identity.resolve(rows.select("record_id", "version", "line", "source", "text", *keep), index)


# what NFKC and trimming change in these texts: width, and white space at the ends
def text_sql(x: str) -> str:
    return "regexp_replace(" + keys.narrow_sql(x) + r", '^\s+|\s+$', '', 'g')"


FIRST_USER = text_sql("list_filter(messages, lambda m: m.role = 'user' AND m.content IS NOT NULL)[1].content")


IDENTITY = f"""{TR}, {MANIFEST}, rec AS (SELECT record_id, regexp_extract(source_file, '_([0-9]{{8}}_v[0-9]+)_openai\\.jsonl$', 1) AS version, source_line AS line,
  nullif(regexp_extract(_source, '([^/]+)/[^/]+$', 1), '') AS s0, {FIRST_USER} AS text FROM tr),
rec2 AS (SELECT * EXCLUDE s0, CASE WHEN s0 IS NOT NULL THEN {keys.task_sql('s0')} END AS source FROM rec),
m0 AS (SELECT DISTINCT version, task_id AS task, {text_sql('instruction')} AS text, regexp_extract(regexp_replace(output, '\\.[a-z]+$', ''), '([^/]+)/*$', 1) AS o0 FROM mf WHERE instruction IS NOT NULL AND task_id IS NOT NULL),
m1 AS (SELECT version, task, text, CASE WHEN o0 <> '' THEN {keys.task_sql('o0')} END AS source FROM m0),
ix AS (SELECT *, row_number() OVER (PARTITION BY version ORDER BY coalesce(source, task), task, text) AS ordinal FROM m1),
bs AS (SELECT version, source, min(task) AS task FROM ix WHERE source IS NOT NULL GROUP BY ALL HAVING min(task) = max(task)),
bt AS (SELECT version, text, min(task) AS task FROM ix GROUP BY ALL HAVING min(task) = max(task)),
res AS (SELECT rec2.record_id, bs.task AS t1, CASE WHEN ix.text = rec2.text THEN ix.task END AS t2, bt.task AS t3 FROM rec2 LEFT JOIN bs ON bs.version = rec2.version AND bs.source = rec2.source
  LEFT JOIN ix ON ix.version = rec2.version AND ix.ordinal = rec2.line LEFT JOIN bt ON bt.version = rec2.version AND bt.text = rec2.text)"""


@query("identity_cascade", f"WITH {IDENTITY} SELECT record_id, coalesce(t1, t2, t3) AS task, CASE WHEN t1 IS NOT NULL THEN 'source' WHEN t2 IS NOT NULL THEN 'position' WHEN t3 IS NOT NULL THEN 'unique_text' ELSE 'unresolved' END AS method FROM res")
def identity_cascade(spark, folder):
    return resolved(spark, folder).select("record_id", "task", "method")


def candidate_status(spark, folder):
    """record_id, source_file and status: the first gate a record fails, or candidate."""
    trajectories = table(spark, folder, "trajectories").select("record_id", "ingested_at", "source_file", "source_line", "_source", "messages")
    # conversion and tool checks are narrow results of the row itself
    done = convert.convert(trajectories, keep_calls=True)
    done = done.withColumns({"n_calls": F.size("calls"), "tools": C.tools_status(F.col("calls")), "last_role": C.last_role(F.col("messages"))})
    kept = ["error", "n_calls", "tools", "last_role"]
    rows = resolved(spark, folder, "source_file", *kept, rows=located(done, *kept))
    verdicts = settled_verdicts(spark, folder).select(F.col("v").alias("version"), "task", "verdict")
    rows = rows.join(verdicts, ["version", "task"], "left")
    gates = [
        (F.col("task").isNotNull(), "unaligned"),
        (F.col("verdict").isNotNull(), "without_verdict"),
        (F.col("verdict") == "correct", "not_correct"),
        (F.col("error").isNull(), "conversion_error"),
        (F.col("last_role") == "assistant", "not_ended_by_assistant"),
        (F.col("n_calls") > 0, "without_tool_call"),
        (F.col("tools") == "canonical", "noncanonical_tools"),
    ]
    return rows.select("record_id", "source_file", first_of(gates, "candidate").alias("status"))


@query(
    "candidate_funnel",
    f"""WITH {R.CONVERTED}, {R.TOOL_STATUS}, {IDENTITY[len(TR) + 2:]},
settled AS (SELECT v, {keys.task_sql('task_id')} AS task, min(verdict) AS verdict FROM verdicts GROUP BY ALL HAVING min(coalesce(verdict, chr(1))) = max(coalesce(verdict, chr(1)))),
gates AS (SELECT rec2.record_id, tr.source_file, coalesce(t1, t2, t3) AS task, verdict, error, tr.messages[-1].role AS last_role, tool_status.status AS tools
  FROM rec2 JOIN tr USING (record_id) JOIN res USING (record_id) JOIN converted USING (record_id) JOIN tool_status USING (record_id) LEFT JOIN settled ON settled.v = rec2.version AND settled.task = coalesce(t1, t2, t3)),
s AS (SELECT source_file, CASE WHEN task IS NULL THEN 'unaligned' WHEN verdict IS NULL THEN 'without_verdict' WHEN verdict <> 'correct' THEN 'not_correct' WHEN error IS NOT NULL THEN 'conversion_error'
  WHEN last_role IS DISTINCT FROM 'assistant' THEN 'not_ended_by_assistant' WHEN tools = 'no_tool_calls' THEN 'without_tool_call' WHEN tools <> 'canonical' THEN 'noncanonical_tools' ELSE 'candidate' END AS status FROM gates)
SELECT source_file, status, count(*) AS records FROM s GROUP BY GROUPING SETS ((source_file, status), (status))""",
)
def candidate_funnel(spark, folder):
    """Records by file and status, with a row for all files."""
    return candidate_status(spark, folder).groupingSets([["source_file", "status"], ["status"]], "source_file", "status").agg(F.count(F.lit(1)).alias("records"))


def evidence_rows(spark, folder):
    """Deliveries of catalogued records with their manifest row and messages; to be made one row a record when the texts are gone."""
    m = settled_manifest(spark, folder)
    gold, answer_type = review.gold_answer(F.col("gold_answer"))
    m = m.select(
        "version",
        "task_id",
        "conflict",
        F.lit(True).alias("present"),
        gold.alias("gold"),
        answer_type.alias("answer_type"),
        F.lower("type").alias("m_type"),
        F.coalesce("instruction", F.lit("")).alias("instruction"),
        review.expected(F.col("citation.doc_id"), [F.col("source_documents")]).alias("documents"),
        F.array_distinct(F.transform(review.expected(None, [F.col("expected_tables"), F.col("verification_criteria.must_query_tables")]), lambda t: F.lower(t))).alias("tables"),
    )
    rows = catalog(spark, folder, "version", "task_id", "type", "quality_tier")
    messages = table(spark, folder, "trajectories").select("record_id", "messages", "ingested_at")
    rows = rows.join(m, ["version", "task_id"], "left").join(messages, "record_id")
    empty = F.array().cast("array<string>")
    fill = {c: F.coalesce(c, d) for c, d in (("conflict", F.lit(False)), ("present", F.lit(False)), ("gold", F.lit("")), ("answer_type", F.lit("")), ("documents", empty), ("tables", empty))}
    return rows.withColumns(fill).withColumn("type", review.task_type(F.col("type"), F.col("m_type"))).drop("m_type")


@query(
    "evidence_decisions",
    f"WITH {R.evidence(MANIFEST)} SELECT record_id, status, reason, confidence, support, gold_overlap, gold_numbers, gold_numbers_match, unsupported_numbers, documents_accessed, tables_accessed FROM decided",
)
def evidence_decisions(spark, folder):
    """Status, reason and evidence of every catalogued record that has a trajectory."""
    rows = review.with_evidence(evidence_rows(spark, folder)).select("record_id", "ingested_at", review.decide(*review.evidence_rules()).alias("d"), "evidence", "tables_accessed")
    return audit.latest_delivery(rows).select("record_id", "d.*", "evidence.*", "tables_accessed")


@query(
    "gold_coverage",
    f"""WITH {R.evidence(MANIFEST)}, g AS (SELECT record_id, 1 AS n, CASE WHEN conflict THEN '' ELSE {R.folded('gold')} END AS claim, {R.folded('answer')} AS evidence FROM base),
{R.coverage('found', 'g')} SELECT record_id, coverage FROM found""",
)
def gold_coverage(spark, folder):
    """How far each record's answer covers its gold answer; 0 without one, or where its manifest rows disagree."""
    rows = evidence_rows(spark, folder).select("record_id", "ingested_at", F.when(~F.col("conflict"), F.col("gold")).alias("gold"), C.final_answer(F.col("messages")).alias("answer"))
    rows = audit.latest_delivery(rows).select("record_id", nfkc(F.col("gold")).alias("gold"), nfkc(F.col("answer")).alias("answer"))
    return rows.select("record_id", bigram_coverage(F.col("gold"), F.col("answer")).alias("coverage"))


@query("answer_numbers", f"WITH {TR}, {R.ANSWERS} SELECT record_id, {R.numbers('answer')} AS numbers FROM answers")
def answer_numbers(spark, folder):
    """The distinct numbers of each final answer, sorted."""
    answers = audit.latest_delivery(table(spark, folder, "trajectories").select("record_id", "ingested_at", C.final_answer(F.col("messages")).alias("answer")))
    return answers.select("record_id", numbers(F.col("answer")).alias("numbers"))


@query(
    "decision_samples",
    f"""WITH {R.evidence(MANIFEST)}, r AS (SELECT *, replace(answer, chr(0), '') AS clean, row_number() OVER (PARTITION BY reason ORDER BY record_id) AS nth FROM decided)
SELECT record_id, CASE WHEN length(clean) > 200 THEN left(clean, 200) || '…' ELSE clean END AS answer, status, reason FROM r WHERE nth <= 2""",
)
def decision_samples(spark, folder):
    """Two records of each reason, with the answer cut to 200 characters."""
    rows = review.with_evidence(evidence_rows(spark, folder)).select("record_id", "ingested_at", "answer", review.decide(*review.evidence_rules()).alias("d"))
    rows = audit.latest_delivery(rows).select("record_id", "answer", "d.status", "d.reason")
    return review.sample_per_reason(rows, ["record_id"], 2, 200, ("answer",))


@query(
    "decision_inputs",
    f"""WITH {MANIFEST}, c AS (SELECT version, task_id, bool_or(fp <> lo) AS conflict FROM (SELECT *, min(fp) OVER (PARTITION BY version, task_id) AS lo FROM mf) GROUP BY ALL),
k AS (SELECT DISTINCT record_id, version, {keys.task_sql('task_id')} AS task_id FROM token_catalog)
SELECT coalesce(conflict, false) AS conflict, c.version IS NOT NULL AS present, count(*) AS records FROM k LEFT JOIN c USING (version, task_id) WHERE record_id IN (SELECT record_id FROM trajectories) GROUP BY ALL""",
)
def decision_inputs(spark, folder):
    return audit.latest_delivery(evidence_rows(spark, folder).select("record_id", "ingested_at", "conflict", "present")).groupBy("conflict", "present").agg(F.count(F.lit(1)).alias("records"))
