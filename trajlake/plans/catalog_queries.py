"""Queries over token_catalog, content_audit, dataset_plan, verdicts and calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions import keys
from trajlake.functions.labels import LONG_PHASE, RATIO_BOUNDS, TIERS, TOKEN_BOUNDS, evidence_tier, family_of_file, output_group, phase, ratio_bucket, stable_split, token_bucket
from trajlake.operators import calibrate, ingest, planning, stats
from trajlake.session import work_table
from trajlake.sources.tables import table

from .registry import query

PLACE = ["source_file", "source_line"]


def catalog(spark, folder, *columns):
    """token_catalog with canonical labels, the latest row of each record; only the named columns (and record_id) if any are named."""
    rows = table(spark, folder, "token_catalog")
    if columns:
        # the family may be told by the file
        rows = rows.select(*dict.fromkeys(["record_id", "cataloged_at", *columns, *(["source_file"] if "source_family" in columns else [])]))
    rows = ingest.last_wins(rows, ["record_id"], ["cataloged_at"])
    labels = {
        "source_family": lambda: keys.family_key(F.col("source_family"), F.col("source_file")),
        "type": lambda: keys.label_key(F.col("type")),
        "quality_tier": lambda: keys.tier_key(F.col("quality_tier")),
        "task_id": lambda: keys.task_key(F.col("task_id")),
    }
    rows = rows.withColumns({c: f() for c, f in labels.items() if c in rows.columns})
    return rows.select("record_id", *(c for c in dict.fromkeys(columns) if c != "record_id")) if columns else rows


CATALOG = f"""catalog AS (SELECT record_id, source_file, source_line, {keys.family_sql('source_family', 'source_file')} AS source_family, version,
  {keys.task_sql('task_id')} AS task_id, {keys.label_sql('type')} AS type, {keys.tier_sql('quality_tier')} AS quality_tier, characters, input_tokens,
  supervised_tokens, supervised_ratio, input_tokens_estimate_low, input_tokens_estimate_high, token_method
  FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY cataloged_at DESC NULLS LAST) AS n FROM token_catalog) WHERE n = 1)"""


def pct(x: str, r: float, where: str = "") -> str:
    """Nearest-rank percentile as SQL."""
    keep = f" FILTER ({x} IS NOT NULL{' AND ' + where if where else ''})"
    return f"CAST(list_sort(list({x}){keep})[CAST(round_even((count({x}){keep} - 1) * {r}, 0) AS INT) + 1] AS DOUBLE)"


def planning_rows(spark, folder):
    """Catalog and audit rows of the same place, put together."""
    audit = table(spark, folder, "content_audit").drop("record_id", "source_family", "version", "task_id", "type")
    return catalog(spark, folder).join(ingest.last_wins(audit, PLACE, ["total_chars"]), PLACE)


PLANNING = f"""{CATALOG}, audit AS (SELECT DISTINCT ON (source_file, source_line) * EXCLUDE (record_id, source_family, version, task_id, type) FROM content_audit ORDER BY source_file, source_line, total_chars DESC),
rows_ AS (SELECT * FROM catalog JOIN audit USING (source_file, source_line))"""
PHASE = f"CASE WHEN input_tokens > 0 AND input_tokens <= 8192 THEN 'core_8k' WHEN input_tokens > 8192 AND input_tokens <= 16384 THEN 'extension_16k' WHEN input_tokens > 16384 AND input_tokens <= 32768 THEN '{LONG_PHASE}' END"
REASONS = {
    "low_supervised_ratio": "supervised_ratio < 0.10",
    "short_final_answer": "final_assistant_chars < 50",
    "secret_pattern": "secret_pattern_hits > 0",
    "destructive_command": "destructive_commands > 0",
    "network_command": "network_commands > 0",
}
GATED = f"""{PLANNING}, gated AS (SELECT *, {PHASE} AS phase, CASE WHEN {PHASE} IS NULL THEN ['over_32k'] ELSE list_filter([{', '.join(f"CASE WHEN {c} THEN '{n}' END" for n, c in REASONS.items())}], lambda x: x IS NOT NULL) END AS reasons FROM rows_)"""


def tier_rank(names, otherwise):
    return "CASE quality_tier " + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(names)) + f" ELSE {otherwise} END"


ORDER = f"""{tier_rank(TIERS, 9)}, coalesce(network_commands, 0) > 0, least(coalesce(tool_error_messages, 0), 20), least(coalesce(duplicate_tool_calls, 0), 20),
coalesce(nonportable_path_occurrences, 0) > 0, input_tokens NULLS FIRST, supervised_ratio DESC NULLS LAST, final_assistant_chars DESC NULLS LAST, source_file, source_line"""


def gated_rows(spark, folder):
    return planning.gated(planning_rows(spark, folder))


def best_rows(spark, folder):
    """Rows that pass the gates, the best of each phase, version and task."""
    ok = gated_rows(spark, folder).filter(F.size("reasons") == 0)
    return planning.best_of(ok, ["phase", "version", "task_id"], planning.plan_order())


BEST = f"{GATED}, best AS (SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY phase, version, task_id ORDER BY {ORDER}) AS n FROM gated WHERE len(reasons) = 0) WHERE n = 1)"
DIVERSE = f"""{BEST}, by_family AS (SELECT *, row_number() OVER (PARTITION BY phase, task_id, source_family ORDER BY {ORDER}) AS s FROM best),
chosen AS (SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY phase, task_id ORDER BY s > 1, {ORDER}) AS n FROM by_family) WHERE n <= 3)"""


def plan_rows(spark, folder):
    rows = planning.diverse_k(best_rows(spark, folder), ["phase", "task_id"], "source_family", planning.plan_order(), 3)
    return rows.withColumn("split", stable_split(F.col("task_id")))


SHARE = "(CAST('0x' || substr(sha256(task_id), 1, 16) AS UBIGINT)::DOUBLE / 18446744073709551616.0)"
SPLIT = f"CASE WHEN task_id IS NULL THEN NULL WHEN {SHARE} < 0.85 THEN 'train' WHEN {SHARE} < 0.925 THEN 'validation' ELSE 'test' END"
PLANNED = f"{DIVERSE}, plan AS (SELECT *, {SPLIT} AS split FROM chosen)"


@query("catalog_counts", f"WITH {CATALOG} SELECT source_family, type, count(*) AS records, count(DISTINCT task_id) AS tasks FROM catalog GROUP BY ALL")
def catalog_counts(spark, folder):
    return catalog(spark, folder, "source_family", "type", "task_id").groupBy("source_family", "type").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("task_id").alias("tasks"))


@query(
    "file_families",
    f"""SELECT CASE {' '.join(f"WHEN starts_with(source_file, '{p}') THEN '{f}'" for p, f in keys.FAMILY_OF_FILE.items())} ELSE 'unknown' END AS family,
regexp_extract(source_file, '_([0-9]{{8}}_v[0-9]+)_openai\\.jsonl$', 1) AS version, count(*) AS records FROM token_catalog GROUP BY ALL""",
)
def file_families(spark, folder):
    name = F.col("source_file")
    rows = table(spark, folder, "token_catalog").select(family_of_file(name, keys.FAMILY_OF_FILE).alias("family"), F.regexp_extract(name, r"_(\d{8}_v\d+)_openai\.jsonl$", 1).alias("version"))
    return rows.groupBy("family", "version").agg(F.count(F.lit(1)).alias("records"))


@query(
    "token_summary",
    f"""WITH {CATALOG} SELECT source_family, type, count(*) AS records, coalesce(sum(input_tokens), 0)::BIGINT AS input_tokens, coalesce(sum(supervised_tokens), 0)::BIGINT AS supervised_tokens,
round_even(coalesce(sum(supervised_tokens), 0)::DOUBLE / greatest(1, coalesce(sum(input_tokens), 0)), 6) AS weighted_ratio, coalesce(max(input_tokens), 0) AS largest,
{pct('input_tokens', 0.5)} AS input_tokens_p50, {pct('input_tokens', 0.95)} AS input_tokens_p95 FROM catalog GROUP BY ALL""",
)
def token_summary(spark, folder):
    # summed and ranked: two readings of one table that is made once
    rows = work_table(catalog(spark, folder, "source_family", "type", "input_tokens", "supervised_tokens"), "catalog")
    return stats.group_summary(rows, ["source_family", "type"], "input_tokens", "supervised_tokens")


@query("median_tokens", f"WITH {CATALOG} SELECT source_family, trunc(median(input_tokens))::BIGINT AS median, min(input_tokens) AS least, max(input_tokens) AS largest FROM catalog GROUP BY ALL")
def median_tokens(spark, folder):
    return catalog(spark, folder, "source_family", "input_tokens").groupBy("source_family").agg(stats.median_truncated("input_tokens").alias("median"), F.min("input_tokens").alias("least"), F.max("input_tokens").alias("largest"))


def _histogram_sql(bucket, value, weight):
    total = lambda x: f"round_even({x}::DOUBLE / greatest(1, sum({x}) OVER ()), 6)"
    return f"""WITH {CATALOG}, b AS (SELECT {bucket} AS bucket, min({value})::DOUBLE AS position, count(*) AS records, coalesce(sum({weight}), 0)::BIGINT AS {weight} FROM catalog WHERE {value} IS NOT NULL GROUP BY ALL)
SELECT *, {total('records')} AS record_share, {total(weight)} AS weight_share FROM b"""


TOKEN_BUCKET = "CASE " + " ".join(f"WHEN input_tokens <= {h} THEN '{lo + 1}-{h}'" for lo, h in zip((0, *TOKEN_BOUNDS), TOKEN_BOUNDS)) + f" ELSE '>{TOKEN_BOUNDS[-1]}' END"
RATIO_BUCKET = "CASE " + " ".join(f"WHEN supervised_ratio < {h} THEN '{lo:.0%}-<{h:.0%}'" for lo, h in zip((0.0, *RATIO_BOUNDS), RATIO_BOUNDS)) + f" ELSE '>={RATIO_BOUNDS[-1]:.0%}' END"


@query("length_histogram", _histogram_sql(TOKEN_BUCKET, "input_tokens", "input_tokens"))
def length_histogram(spark, folder):
    rows = catalog(spark, folder, "input_tokens").filter("input_tokens IS NOT NULL")
    return stats.histogram(rows, token_bucket(F.col("input_tokens")), "input_tokens", F.col("input_tokens").cast("double"))


@query("ratio_histogram", _histogram_sql(RATIO_BUCKET, "supervised_ratio", "input_tokens"))
def ratio_histogram(spark, folder):
    rows = catalog(spark, folder, "supervised_ratio", "input_tokens").filter("supervised_ratio IS NOT NULL")
    return stats.histogram(rows, ratio_bucket(F.col("supervised_ratio")), "input_tokens", F.col("supervised_ratio"))


@query("stable_split", f"WITH {CATALOG} SELECT DISTINCT task_id, {SPLIT} AS split FROM catalog")
def stable_splits(spark, folder):
    return catalog(spark, folder, "task_id").select("task_id", stable_split(F.col("task_id")).alias("split")).distinct()


@query("duplicate_places", "SELECT count(*) AS groups, coalesce(sum(c), 0)::BIGINT AS records FROM (SELECT count(*) AS c FROM token_catalog GROUP BY source_file, source_line HAVING count(*) > 1)")
def duplicate_places(spark, folder):
    return stats.duplicate_groups(table(spark, folder, "token_catalog"), PLACE)


@query(
    "key_reconcile",
    """SELECT count(*) FILTER (l AND r) AS both_sides, count(*) FILTER (NOT r) AS left_only, count(*) FILTER (NOT l) AS right_only FROM
(SELECT source_file, source_line, bool_or(l) AS l, bool_or(NOT l) AS r FROM (SELECT source_file, source_line, true AS l FROM token_catalog UNION ALL SELECT source_file, source_line, false FROM content_audit) GROUP BY ALL)""",
)
def key_reconcile(spark, folder):
    return ingest.reconcile(table(spark, folder, "token_catalog"), table(spark, folder, "content_audit"), PLACE)


@query(
    "missing_verdicts",
    f"WITH {CATALOG} SELECT version, task_id, count(*) AS records FROM catalog WHERE NOT EXISTS (SELECT 1 FROM verdicts v WHERE v.v = version AND {keys.task_sql('v.task_id')} = catalog.task_id) GROUP BY ALL",
)
def missing_verdicts(spark, folder):
    known = table(spark, folder, "verdicts").select(F.col("v").alias("version"), keys.task_key(F.col("task_id")).alias("task_id"))
    return catalog(spark, folder, "version", "task_id").join(known, ["version", "task_id"], "left_anti").groupBy("version", "task_id").agg(F.count(F.lit(1)).alias("records"))


@query(
    "verdict_conflicts",
    f"SELECT v, {keys.task_sql('task_id')} AS task, count(*) AS rows_seen, min(coalesce(verdict, chr(1))) <> max(coalesce(verdict, chr(1))) AS conflict FROM verdicts GROUP BY ALL",
)
def verdict_conflicts(spark, folder):
    rows = table(spark, folder, "verdicts").withColumn("task", keys.task_key(F.col("task_id")))
    return ingest.conflicts(rows, ["v", "task"], F.col("verdict"))


def settled_verdicts(spark, folder):
    """The verdict row of every version and task that has no conflicting ones."""
    rows = table(spark, folder, "verdicts").select("v", keys.task_key(F.col("task_id")).alias("task"), "verdict", F.lower("type").alias("type"), "evidence")
    sure = ingest.conflicts(rows, ["v", "task"], F.col("verdict")).filter("NOT conflict").select("v", "task")
    latest = ingest.last_wins(rows, ["v", "task"], ["verdict", "type", "evidence"])
    return latest.join(sure, ["v", "task"])


@query(
    "verdict_tiers",
    f"""WITH {CATALOG}, vv AS (SELECT v, {keys.task_sql('task_id')} AS task, verdict, lower(type) AS type, evidence.agent_sql_ok AS ok, evidence.is_report AS rep, evidence.answer_type AS answer FROM verdicts),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY v, task ORDER BY verdict DESC NULLS LAST, type DESC NULLS LAST, ok DESC NULLS LAST, rep DESC NULLS LAST, answer DESC NULLS LAST) AS n,
  min(coalesce(verdict, chr(1))) OVER (PARTITION BY v, task) AS lo, max(coalesce(verdict, chr(1))) OVER (PARTITION BY v, task) AS hi FROM vv) WHERE n = 1 AND lo = hi)
SELECT coalesce(verdict, 'missing') AS verdict, CASE WHEN coalesce(ok, false) THEN '{TIERS[0]}' WHEN coalesce(rep, false) THEN '{TIERS[2]}' WHEN one.type = 'kb' THEN '{TIERS[3]}' ELSE '{TIERS[1]}' END AS tier, count(*) AS records
FROM catalog LEFT JOIN one ON v = version AND task = task_id GROUP BY ALL""",
)
def verdict_tiers(spark, folder):
    v = settled_verdicts(spark, folder).select(F.col("v").alias("version"), F.col("task").alias("task_id"), "verdict", F.col("type").alias("v_type"), "evidence")
    rows = catalog(spark, folder, "version", "task_id").join(v, ["version", "task_id"], "left")
    tier = evidence_tier(F.col("evidence.agent_sql_ok"), F.col("evidence.is_report"), F.col("v_type"))
    return rows.groupBy(F.coalesce("verdict", F.lit("missing")).alias("verdict"), tier.alias("tier")).agg(F.count(F.lit(1)).alias("records"))


@query("plan_gate_reasons", f"WITH {GATED} SELECT reason, count(*) AS records FROM (SELECT unnest(reasons) AS reason FROM gated) GROUP BY ALL")
def plan_gate_reasons(spark, folder):
    return planning.reason_counts(gated_rows(spark, folder))


@query("plan_best", f"WITH {BEST} SELECT phase, version, task_id, record_id FROM best")
def plan_best(spark, folder):
    return best_rows(spark, folder).select("phase", "version", "task_id", "record_id")


@query("plan_rows", f"WITH {PLANNED} SELECT phase, split, task_id, record_id, quality_tier <> 'sql_result_verified' AS requires_rejudge, nonportable_path_occurrences > 0 AS requires_path_normalization FROM plan")
def plan_rows_query(spark, folder):
    rows = plan_rows(spark, folder)
    return rows.select("phase", "split", "task_id", "record_id", (F.col("quality_tier") != TIERS[0]).alias("requires_rejudge"), (F.col("nonportable_path_occurrences") > 0).alias("requires_path_normalization"))


@query(
    "plan_summary",
    f"WITH {PLANNED} SELECT phase, split, count(*) AS records, count(DISTINCT task_id) AS tasks, round_even(coalesce(sum(supervised_tokens), 0)::DOUBLE / greatest(1, coalesce(sum(input_tokens), 0)), 6) AS weighted_ratio FROM plan GROUP BY GROUPING SETS ((phase, split), (phase), (split), ())",
)
def plan_summary(spark, folder):
    rows = plan_rows(spark, folder).groupingSets([["phase", "split"], ["phase"], ["split"], []], "phase", "split")
    return rows.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("task_id").alias("tasks"), stats.weighted_ratio("supervised_tokens", "input_tokens").alias("weighted_ratio"))


@query(
    "output_groups",
    f"WITH {PLANNED} SELECT CASE WHEN phase = '{LONG_PHASE}' THEN phase WHEN coalesce(split <> 'train', true) THEN 'heldout' WHEN quality_tier = 'sql_result_verified' THEN 'train_strong_verified' ELSE 'train_review' END AS grp, count(*) AS records FROM plan GROUP BY ALL",
)
def output_groups(spark, folder):
    rows = plan_rows(spark, folder)
    return rows.groupBy(output_group(F.col("phase"), F.col("split"), F.col("quality_tier")).alias("grp")).agg(F.count(F.lit(1)).alias("records"))


UPPER = "coalesce(input_tokens_estimate_high, input_tokens)"


@query("longest_rows", f"WITH {PLANNED} SELECT record_id, {UPPER} AS upper_tokens FROM plan WHERE split = 'train' AND phase <> '{LONG_PHASE}' AND {UPPER} <= 16384 ORDER BY {UPPER} DESC, input_tokens DESC, source_file DESC, source_line DESC LIMIT 32")
def longest_rows(spark, folder):
    return planning.longest(plan_rows(spark, folder), 32, 16_384).select("record_id", planning.upper_tokens().alias("upper_tokens"))


@query(
    "nearest_rows",
    f"""WITH {CATALOG} SELECT target, record_id, input_tokens FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY abs(input_tokens - target), coalesce(supervised_ratio, 0) < 0.10,
{tier_rank(planning.BENCHMARK_TIERS, 4)}, -coalesce(supervised_tokens, 0), source_file, source_line) AS n FROM catalog, (SELECT unnest([1024, 2048, 4096, 8192]) AS target) WHERE input_tokens IS NOT NULL) WHERE n = 1""",
)
def nearest_rows(spark, folder):
    return planning.nearest(catalog(spark, folder, "input_tokens", "supervised_ratio", "quality_tier", "supervised_tokens", "source_file", "source_line"), [4096, 1024, 8192, 2048]).select("target", "record_id", "input_tokens")


@query(
    "status_summary",
    f"WITH {CATALOG}, r AS (SELECT *, {PHASE} AS phase FROM catalog) "
    + " UNION ALL ".join(
        f"SELECT '{'+'.join(s) or 'all'}' AS grouping, {', '.join(c if c in s else f'NULL AS {c}' for c in ('phase', 'type', 'source_family'))}, count(*) AS records, coalesce(sum(input_tokens), 0)::BIGINT AS tokens FROM r" + (f" GROUP BY {', '.join(s)}" if s else "")
        for s in (["phase"], ["phase", "type"], ["type", "phase"], ["phase", "source_family"], [])
    ),
)
def status_summary(spark, folder):
    rows = catalog(spark, folder, "type", "source_family", "input_tokens").withColumn("phase", phase(F.col("input_tokens"))).select("phase", "type", "source_family", "input_tokens")
    sets = [["phase"], ["phase", "type"], ["type", "phase"], ["phase", "source_family"], []]
    return stats.counts_by(rows, sets, F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("tokens"))


AUDIT_FIELDS = ["total_chars", "tool_response_messages", "tool_error_messages", "duplicate_tool_calls", "destructive_commands", "network_commands", "nonportable_path_occurrences", "final_assistant_chars"]


@query(
    "audit_distribution",
    " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) FILTER ({f} > 0) AS records_nonzero, round_even(coalesce(sum({f}::DOUBLE), 0), 6) AS total, coalesce(max({f})::DOUBLE, 0) AS largest, {pct(f, 0.5)} AS p50, {pct(f, 0.95)} AS p95, {pct(f, 0.99)} AS p99 FROM content_audit"
        for f in AUDIT_FIELDS
    ),
)
def audit_distribution(spark, folder):
    return stats.distribution(table(spark, folder, "content_audit"), AUDIT_FIELDS)


@query(
    "quality_by_family",
    f"""WITH a AS (SELECT {keys.family_sql('source_family', 'source_file')} AS source_family, * EXCLUDE (source_family), tool_error_messages::DOUBLE / greatest(1, tool_response_messages) AS error_rate FROM content_audit)
SELECT source_family, count(*) AS records, count(*) FILTER (tool_error_messages > 0) AS with_errors, count(*) FILTER (duplicate_tool_calls > 0) AS with_duplicates, count(*) FILTER (destructive_commands > 0) AS with_destructive,
count(*) FILTER (network_commands > 0) AS with_network, count(*) FILTER (nonportable_path_occurrences > 0) AS with_paths, count(*) FILTER (secret_pattern_hits > 0) AS with_secrets,
{pct('error_rate', 0.5)} AS error_rate_p50, {pct('error_rate', 0.95)} AS error_rate_p95 FROM a GROUP BY ALL""",
)
def quality_by_family(spark, folder):
    rows = table(spark, folder, "content_audit").withColumn("source_family", keys.family_key(F.col("source_family"), F.col("source_file")))
    rows = rows.withColumn("error_rate", F.col("tool_error_messages") / F.greatest(F.lit(1), F.col("tool_response_messages")))
    having = {"errors": "tool_error_messages", "duplicates": "duplicate_tool_calls", "destructive": "destructive_commands", "network": "network_commands", "paths": "nonportable_path_occurrences", "secrets": "secret_pattern_hits"}
    counts = rows.groupBy("source_family").agg(F.count(F.lit(1)).alias("records"), *(F.count_if(F.col(c) > 0).alias(f"with_{n}") for n, c in having.items()))
    return stats.join_on_nullable(counts, stats.nearest_rank(rows, ["source_family"], ["error_rate"], [0.5, 0.95]), ["source_family"])


RATES = {"tool_error_records": "tool_error_messages", "duplicate_call_records": "duplicate_tool_calls", "nonportable_path_records": "nonportable_path_occurrences", "destructive_command_records": "destructive_commands", "secret_pattern_records": "secret_pattern_hits"}


@query(
    "quality_groups",
    f"""WITH {CATALOG}, a AS (SELECT catalog.source_family, catalog.type, catalog.quality_tier, {', '.join(RATES.values())}, tool_response_messages::DOUBLE / greatest(1, total_chars) AS density
  FROM (SELECT DISTINCT ON (source_file, source_line) * FROM content_audit ORDER BY source_file, source_line, total_chars DESC) JOIN catalog USING (source_file, source_line)),
g AS (SELECT 'source_family' AS field, source_family AS value, * FROM a UNION ALL SELECT 'type', type, * FROM a UNION ALL SELECT 'quality_tier', quality_tier, * FROM a)
SELECT field, value, count(*) AS records, {', '.join(f'count(*) FILTER ({c} > 0) AS {n}' for n, c in RATES.items())}, {pct('density', 0.5)} AS density_p50, {pct('density', 0.95)} AS density_p95 FROM g GROUP BY field, value""",
)
def quality_groups(spark, folder):
    """Quality rates by family, by type and by tier, and percentiles of tool responses a character, from one scan."""
    metrics = table(spark, folder, "content_audit").select(*PLACE, *RATES.values(), "tool_response_messages", "total_chars")
    rows = ingest.last_wins(metrics, PLACE, ["total_chars"]).join(catalog(spark, folder, *PLACE, "source_family", "type", "quality_tier"), PLACE)
    rows = rows.withColumn("density", F.col("tool_response_messages") / F.greatest(F.lit(1), F.col("total_chars")))
    fields = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in ("source_family", "type", "quality_tier")))
    rows = work_table(rows.select(F.explode(fields).alias("g"), *RATES.values(), "density").select("g.*", *RATES.values(), "density"), "quality_groups")
    counts = rows.groupBy("field", "value").agg(F.count(F.lit(1)).alias("records"), *(F.count_if(F.col(c) > 0).alias(n) for n, c in RATES.items()))
    return stats.join_on_nullable(counts, stats.nearest_rank(rows, ["field", "value"], ["density"], [0.5, 0.95]), ["field", "value"])


def _ratio_sql(group, name_family, name_type):
    r = "input_tokens::DOUBLE / greatest(1, characters)"
    return f"SELECT {name_family} AS source_family, {name_type} AS type, {pct('x', 0.05)} AS chars_p05, {pct('x', 0.5)} AS chars_p50, {pct('x', 0.95)} AS chars_p95, {pct('supervised_ratio', 0.5)} AS supervised_p50 FROM (SELECT *, {r} AS x FROM calibration) {group}"


CALIBRATION = _ratio_sql("GROUP BY source_family, type", "source_family", "type") + " UNION ALL " + _ratio_sql("GROUP BY source_family", "source_family", "NULL") + " UNION ALL " + _ratio_sql("", "NULL", "NULL")


@query("calibration_ratios", CALIBRATION)
def calibration_ratios(spark, folder):
    return calibrate.ratios(table(spark, folder, "calibration"))


@query(
    "estimated_tokens",
    f"""WITH {CATALOG}, c AS ({CALIBRATION}), e AS (SELECT record_id, input_tokens, characters, a.chars_p50 AS a50, coalesce(g.chars_p05, f.chars_p05, a.chars_p05) AS p05, coalesce(g.chars_p50, f.chars_p50, a.chars_p50) AS p50, coalesce(g.chars_p95, f.chars_p95, a.chars_p95) AS p95,
  coalesce(g.supervised_p50, f.supervised_p50, a.supervised_p50) AS s50 FROM catalog LEFT JOIN c g ON g.source_family = catalog.source_family AND g.type = catalog.type
  LEFT JOIN c f ON f.source_family = catalog.source_family AND f.type IS NULL JOIN c a ON a.source_family IS NULL)
SELECT record_id, greatest(1, round_even(characters * p50, 0))::BIGINT AS estimate, greatest(1, round_even(characters * p05, 0))::BIGINT AS low, greatest(1, round_even(characters * p95, 0))::BIGINT AS high,
greatest(1, round_even(greatest(1, round_even(characters * p50, 0)) * s50, 0))::BIGINT AS supervised FROM e WHERE characters IS NOT NULL""",
)
def estimated_tokens(spark, folder):
    rows = catalog(spark, folder, "source_family", "type", "characters").filter("characters IS NOT NULL")
    return calibrate.estimate(rows, table(spark, folder, "calibration")).select("record_id", "estimate", "low", "high", "supervised")


@query(
    "boundary_estimates",
    f"WITH {CATALOG} SELECT source_family, count(*) AS estimated, count(*) FILTER (len(list_filter([8192, 16384, 32768, 1024], lambda b: input_tokens_estimate_low <= b AND b < input_tokens_estimate_high)) > 0) AS boundary_sensitive FROM catalog WHERE input_tokens_estimate_low IS NOT NULL GROUP BY ALL",
)
def boundary_estimates(spark, folder):
    rows = catalog(spark, folder, "source_family", "input_tokens_estimate_low", "input_tokens_estimate_high").filter("input_tokens_estimate_low IS NOT NULL")
    return rows.groupBy("source_family").agg(F.count(F.lit(1)).alias("estimated"), calibrate.boundary_sensitive("input_tokens_estimate_low", "input_tokens_estimate_high", [8192, 16384, 32768, 1024]).alias("boundary_sensitive"))
