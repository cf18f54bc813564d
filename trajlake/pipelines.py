"""End-to-end runs over files, one function for each entry point; `python -m trajlake.pipelines NAME --help`.

Each reads JSON lines, writes JSON lines or JSON, and returns its summary. Checks that fail raise before
anything is published.
"""

from __future__ import annotations

import argparse
import inspect
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions import calls as C
from trajlake.functions.labels import LONG_PHASE, TIERS, output_group, stable_split
from trajlake.functions.text import nfkc
from trajlake.operators import audit, convert, identity, ingest, planning, review, stats
from trajlake.session import release, work_table
from trajlake.sources import jsonl, sinks

PLACE = ["source_file", "source_line"]
GROUPS = ["train_strong_verified", "train_review", "heldout", LONG_PHASE]
TOKENS = "source_file string, source_line bigint, source_family string, version string, task_id string, type string, quality_tier string, characters bigint, input_tokens bigint, supervised_tokens bigint, supervised_ratio double, input_tokens_estimate_high bigint"


def records(spark: SparkSession, path: str, per_file: int = 0) -> DataFrame:
    """source_file, source_line and the conversation of every line; a line that is no object raises."""
    rows = jsonl.parsed(jsonl.first_lines(jsonl.read_lines(spark, path), per_file))
    bad = F.assert_true(F.col("status") == "object", F.concat(F.lit("no JSON object: "), "file", F.lit(":"), F.col("line").cast("string")))
    return jsonl.conversations(rows.filter(bad.isNull())).withColumnsRenamed({"file": "source_file", "line": "source_line"})


def rows_of(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed rows of a JSON-lines output of this engine (a folder of part files) or of single files."""
    return spark.read.schema(schema).json(path)


def manifest_rows(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    rows = jsonl.typed(jsonl.read_lines(spark, path), jsonl.manifest_schema())
    return rows.filter(F.col("v") == version) if version else rows


def verdict_rows(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The last verdict of each version and task, with conflict."""
    rows = jsonl.typed(jsonl.read_lines(spark, path), jsonl.verdict_schema())
    rows = rows.filter(F.col("v") == version) if version else rows
    unlike = ingest.conflicts(rows, ["v", "task_id"], F.col("verdict")).select("v", "task_id", "conflict")
    return ingest.last_wins(rows, ["v", "task_id"], ["file", "line"]).join(unlike, ["v", "task_id"])


def aligned(spark: SparkSession, rows: DataFrame, manifests: str, version: str) -> DataFrame:
    """rows of one version with task and method; a text that the manifest doesn't have is never matched."""
    m = manifest_rows(spark, manifests, version)
    m = m.withColumn("instruction", nfkc(F.col("instruction")))
    index = identity.manifest_index(m, F.col("instruction"), F.col("output"), ["file", "line"])
    rows = rows.withColumns({"version": F.lit(version), "line": F.col("source_line"), "text": nfkc(C.first_user(F.col("messages")))})
    found = identity.resolve(rows, index)
    known = index.select("version", "text", F.lit(True).alias("_known")).distinct()
    found = found.join(known, ["version", "text"], "left")
    return found.withColumns({"task": F.when(F.col("_known"), F.col("task")), "method": F.when(F.col("_known"), F.col("method")).otherwise("unresolved")}).drop("_known")


def prepare(spark: SparkSession, input: str, manifests: str, verdicts: str, output: str, metadata_output: str, allowed_verdict: str = "correct", max_samples: int = 0, select_shortest: bool = False, require_tool_roundtrip: bool = False, skip_conversion_errors: bool = False) -> dict:
    """One raw file to training rows and their metadata, strictly: any unmatched record, missing or conflicting
    verdict or (unless skipped) conversion error raises. allowed_verdict: names separated by commas."""
    name = input.rstrip("/").rsplit("/", 1)[-1]
    version = spark.range(1).select(jsonl.file_version(F.lit(name))).first()[0]
    v = verdict_rows(spark, verdicts, version).withColumnRenamed("task_id", "task")
    if (clash := v.filter("conflict").count()) > 0:
        raise ValueError(f"{clash} tasks with conflicting verdicts")
    rows = aligned(spark, records(spark, input), manifests, version).join(v.select("task", "verdict", "type"), "task", "left")
    rows = convert.convert(rows).drop("messages", "line", "text", "tools")
    rows = work_table(rows.withColumn("converted", F.when(F.col("verdict").isin(*allowed_verdict.split(",")), F.col("converted"))), "prepared")
    counts = rows.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("task").isNull()).alias("unmatched"), F.count_if(F.col("task").isNotNull() & F.col("verdict").isNull()).alias("missing_verdict")).first().asDict()
    chosen = rows.filter(F.col("verdict").isin(*allowed_verdict.split(",")))
    errors = {r["error"]: r["n"] for r in chosen.filter("error IS NOT NULL").groupBy("error").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts["unmatched"] or counts["missing_verdict"] or (errors and not skip_conversion_errors):
        raise ValueError(f"nothing written: {counts}, conversion errors {errors}")
    good = chosen.filter("error IS NULL")
    if require_tool_roundtrip:
        good = convert.closed_round_trips(good)
    order = [F.col("conversion.characters"), F.col("source_line")] if select_shortest else [F.col("source_file"), F.col("source_line")]
    if max_samples:
        good = good.orderBy(*order).limit(max_samples)
    n = good.count()
    training = convert.training_rows(good, *PLACE, "conversion").orderBy(*order).select("tools", "messages")
    sinks.write_jsonl(training, output, expected=n)
    sinks.write_jsonl(good.select(*PLACE, "version", F.col("task").alias("task_id"), "type", "verdict", "conversion"), metadata_output, order, expected=n)
    report = counts | {"written": n, "conversion_errors": errors, "methods": sinks.nested_counts(rows, ["method"])}
    release(spark)
    return report


AUDIT_FIELDS = ["tool_response_char_ratio", "tool_response_max_chars", "tool_error_messages", "duplicate_tool_calls", "consecutive_duplicate_tool_calls", "destructive_commands", "network_commands", "nonportable_path_occurrences", "secret_pattern_hits", "final_assistant_chars"]
RATES = {"tool_error_records": "tool_error_messages", "duplicate_call_records": "duplicate_tool_calls", "nonportable_path_records": "nonportable_path_occurrences", "destructive_command_records": "destructive_commands", "secret_pattern_records": "secret_pattern_hits"}


def _rates(metrics: DataFrame, by: str) -> dict:
    """Quality rates and percentiles of the response share of each value of a column."""
    counts = metrics.groupBy(by).agg(F.count(F.lit(1)).alias("records"), *(F.count_if(F.col(c) > 0).alias(n) for n, c in RATES.items()))
    rows = stats.join_on_nullable(counts, stats.nearest_rank(metrics, [by], ["tool_response_char_ratio"], [0.5, 0.95]), [by])
    return {str(r[by]): {k: v for k, v in r.asDict().items() if k != by} for r in rows.collect()}


def audit_quality(spark: SparkSession, data_dir: str, candidate_catalog: str, record_output: str, summary_output: str) -> dict:
    """Content metrics of the catalogued records; every one of them must be in the raw data. Of repeated catalog places the last row counts."""
    catalog = rows_of(spark, candidate_catalog, TOKENS).withColumn("_at", F.monotonically_increasing_id())
    catalog = work_table(ingest.last_wins(catalog, PLACE, ["_at"]).drop("_at"), "catalog")
    rows = catalog.join(records(spark, data_dir).select(*PLACE, "messages", (F.col("tools_type") == "list").alias("top_level_tools_present")), PLACE)
    metrics = work_table(audit.audit(rows), "metrics")
    ingest.require_complete(catalog, metrics, PLACE)
    sinks.write_jsonl(metrics, record_output, PLACE, expected=catalog.count())
    some = lambda c: F.count_if(c)
    totals = metrics.agg(
        F.count(F.lit(1)).alias("records"),
        some(F.col("top_level_tools_present")).alias("top_level_tools_present"),
        some(F.col("system_chars") > 0).alias("system_message_present"),
        F.count_distinct("system_fingerprint").alias("distinct_system_prompts"),
        some(F.col("system_tool_contract_present")).alias("system_tool_contract_present"),
        *(F.coalesce(F.sum(f"tool_response_over_{b}"), F.lit(0)).alias(f"tool_response_over_{b}_messages") for b in audit.RESPONSE_BOUNDS),
    )
    summary = totals.first().asDict() | {"distribution": {r["field"]: r.asDict() for r in stats.distribution(metrics, AUDIT_FIELDS).collect()}}
    summary |= {f"by_{c}": _rates(metrics, c) for c in ("source_family", "type", "quality_tier")}
    sinks.write_summary(spark, summary_output, summary)
    release(spark)
    return summary


def plan(spark: SparkSession, token_catalog: str, content_quality_catalog: str, output: str, summary_output: str, max_per_task_per_phase: int = 3, train_share: float = 0.85, validation_share: float = 0.075, min_final_answer_chars: int = 50, production_max_tokens: int = 16_384) -> dict:
    """Gates, best of each version and task, source-diverse limit, stable split; token and quality keys must agree."""
    if max_per_task_per_phase < 1 or min_final_answer_chars < 0:
        raise ValueError("limits must be positive")
    tokens = ingest.last_wins(rows_of(spark, token_catalog, TOKENS), PLACE, ["input_tokens"])
    quality = spark.read.json(content_quality_catalog)
    rows = ingest.merge_exact(tokens, ingest.last_wins(quality, PLACE, ["total_chars"]), PLACE)
    rows = work_table(planning.gated(rows, production_max_tokens, min_final_chars=min_final_answer_chars), "gated")
    kept = rows.filter(F.size("reasons") == 0).drop("reasons")
    best = work_table(planning.best_of(kept, ["phase", "version", "task_id"], planning.plan_order()), "best")
    chosen = planning.diverse_k(best, ["phase", "task_id"], "source_family", planning.plan_order(), max_per_task_per_phase)
    chosen = chosen.withColumns(
        {
            "split": stable_split(F.col("task_id"), train_share, validation_share),
            "requires_rejudge": F.coalesce(F.col("quality_tier") != TIERS[0], F.lit(True)),
            "requires_path_normalization": F.coalesce(F.col("nonportable_path_occurrences") > 0, F.lit(False)),
        }
    )
    chosen = work_table(chosen, "plan")
    sinks.write_jsonl(chosen, output, ["phase", "split", "task_id", *planning.plan_order()])
    summary = {
        "candidates": rows.count(),
        "excluded": {r["reason"]: r["records"] for r in planning.reason_counts(rows).collect()},
        "before_deduplication": kept.count(),
        "after_deduplication": best.count(),
        "selected": chosen.count(),
        "by_phase": sinks.nested_counts(chosen, ["phase", "split"]),
        "by_family": sinks.nested_counts(chosen, ["source_family"]),
    }
    sinks.write_summary(spark, summary_output, summary)
    release(spark)
    return summary


PLAN = TOKENS + ", phase string, split string, requires_rejudge boolean"


def materialize_plan_sets(spark: SparkSession, plan: str, data_dir: str, output_dir: str, summary_output: str) -> dict:
    """The plan's records converted and routed to their groups, published together; a missing record or one that can't be converted raises."""
    rows = ingest.require_unique(rows_of(spark, plan, PLAN), PLACE)
    found = rows.join(records(spark, data_dir).select(*PLACE, "messages"), PLACE)
    ingest.require_complete(rows, found, PLACE)
    done = work_table(convert.convert(found).drop("messages"), "converted")
    if bad := done.filter("error IS NOT NULL").select(*PLACE, "error").limit(10).collect():
        raise ValueError(f"records that can't be converted: {[tuple(r) for r in bad]}")
    sets = done.select(output_group(F.col("phase"), F.col("split"), F.col("quality_tier")).alias("set"), F.lit(convert.tool_schema()).alias("tools"), F.col("converted").alias("messages"))
    counts = sinks.write_groups(sets, "set", output_dir, GROUPS)
    files = [r.asDict() for r in sinks.checksums(spark, output_dir).filter("file LIKE 'part%'").orderBy("file").collect()]
    summary = {"records": rows.count(), "sets": counts, "files": files}
    sinks.write_summary(spark, summary_output, summary)
    release(spark)
    return summary


def select_longest(spark: SparkSession, plan: str, output: str, summary_output: str, limit: int = 32, max_tokens: int = 16_384) -> dict:
    """Exactly `limit` of the longest train rows within max_tokens."""
    rows = planning.exactly(planning.longest(rows_of(spark, plan, PLAN), limit, max_tokens), limit)
    upper = planning.upper_tokens()
    sinks.write_jsonl(rows, output, [upper.desc(), F.col("input_tokens").desc(), F.col("source_file").desc(), F.col("source_line").desc()], files=1, expected=limit)
    summary = rows.agg(F.count(F.lit(1)).alias("records"), F.min(upper).alias("shortest"), F.max(upper).alias("longest")).first().asDict()
    sinks.write_summary(spark, summary_output, summary)
    return summary


def rejudge(spark: SparkSession, plan: str, data_dir: str, manifests_dir: str, output: str, summary_output: str, phase: str = "core_8k") -> dict:
    """Evidence decisions for the plan rows of a phase."""
    # the plan's own order, which the decisions keep
    rows = ingest.require_unique(work_table(rows_of(spark, plan, PLAN).withColumn("plan_order", F.monotonically_increasing_id()).filter(F.col("phase") == phase), "planned"), PLACE)
    m = manifest_rows(spark, manifests_dir).withColumnsRenamed({"v": "version"})
    m = m.withColumn("fingerprint", review.manifest_fingerprint())
    m = ingest.first_of_key(m, ["version", "task_id"], "fingerprint", ["file", "line"])
    gold, kind = review.gold_answer(F.col("gold_answer"))
    m = m.select("version", "task_id", "conflict", F.lit(True).alias("present"), gold.alias("gold"), kind.alias("answer_type"), "instruction", F.col("type").alias("m_type"), review.expected(F.col("citation.doc_id"), [F.col("source_documents")]).alias("documents"), review.expected(None, [F.col("expected_tables"), F.col("verification_criteria.must_query_tables")]).alias("tables"))
    found = rows.join(records(spark, data_dir).select(*PLACE, "messages"), PLACE)
    ingest.require_complete(rows, found.select(*PLACE), PLACE)
    none = F.array().cast("array<string>")
    found = found.join(m, ["version", "task_id"], "left").withColumns({"conflict": F.coalesce("conflict", F.lit(False)), "present": F.coalesce("present", F.lit(False)), "documents": F.coalesce("documents", none), "tables": F.coalesce("tables", none), "type": review.task_type(F.col("type"), F.col("m_type"))})
    decided = review.with_evidence(found).withColumn("d", review.decide(*review.evidence_rules()))
    scores = F.when(F.col("evidence").isNotNull(), F.struct(F.length("answer").alias("final_answer_chars"), F.size("documents").alias("expected_documents"), F.size("tables").alias("expected_tables"), "tables_accessed", "evidence.*"))
    out = work_table(decided.select("plan_order", *PLACE, "source_family", "version", "task_id", "type", "phase", "split", "input_tokens", "quality_tier", "d.*", scores.alias("evidence")), "decisions")
    lines = out.orderBy("plan_order").drop("plan_order")
    sinks.write_jsonl(lines, output, expected=rows.count())
    summary = {"records": rows.count(), "by_status": sinks.nested_counts(out, ["status", "split"]), "by_reason": sinks.nested_counts(out, ["status", "reason"]), "by_type": sinks.nested_counts(out, ["type", "status"]), "unique_task_ids": out.select("task_id").distinct().count()}
    sinks.write_summary(spark, summary_output, summary)
    release(spark)
    return summary


def audit_trajectories(spark: SparkSession, input: str, max_records_per_file: int = 0) -> dict:
    """Counts of lines, keys, roles, argument keys and call pairing; never any text."""
    rows = jsonl.parsed(jsonl.first_lines(jsonl.read_lines(spark, input), max_records_per_file))
    lines = work_table(rows.select("file", "status", F.when(F.col("status") == "object", F.json_object_keys("value")).alias("keys")), "lines")
    m = F.col("messages")
    talks = jsonl.conversations(rows).withColumns(
        {"fields": audit.message_fields(m), "kinds": F.transform(m, lambda x: F.struct(x["role"].alias("role"), x["content_type"].alias("content_type"))), "used": audit.keys_used(), "last_role": C.last_role(m)}
    )
    # every count comes from these narrow facts, so the files are parsed twice at most
    facts = work_table(audit.round_trips(talks, "fields", "kinds", "used", "last_role"), "facts")
    report = {
        "lines": sinks.nested_counts(lines, ["file", "status"]),
        "keys": {r["key"]: r["n"] for r in lines.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()},
        "roles": {str(r["role"]): r["messages"] for r in audit.role_profile_of(facts).collect()},
        "content_types": sinks.nested_counts(facts.select(F.inline("kinds")), ["role", "content_type"]),
        "arguments": sinks.nested_counts(facts.select(F.inline("used")).select("name", F.explode_outer("keys").alias("key")), ["name", "key"]),
        "final_roles": sinks.nested_counts(facts, ["last_role"]),
        "pairing": facts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("calls", "responses", "unknown", "repeated", "unanswered"))).first().asDict(),
    }
    release(spark)
    return report


def audit_verdicts(spark: SparkSession, input: str) -> dict:
    """Counts of verdict lines by status, verdict, version and key; missing values as '<missing>'."""
    rows = jsonl.parsed(jsonl.read_lines(spark, input))
    typed = jsonl.typed(rows.filter("status = 'object'"), jsonl.verdict_schema()).withColumns({c: F.coalesce(c, F.lit("<missing>")) for c in ("v", "verdict", "type")})
    return {"lines": sinks.nested_counts(rows, ["file", "status"]), "verdicts": sinks.nested_counts(typed, ["v", "verdict"]), "types": sinks.nested_counts(typed, ["type"]), "keys": {r["key"]: r["objects"] for r in jsonl.key_profile(rows).collect()}}


ENTRIES = {f.__name__: f for f in (prepare, audit_quality, plan, materialize_plan_sets, select_longest, rejudge, audit_trajectories, audit_verdicts)}


def main(args: list[str] | None = None) -> None:
    from trajlake import catalog

    entries = ENTRIES | {f.__name__: f for f in catalog.ENTRIES}
    parser = argparse.ArgumentParser(prog="trajlake.pipelines")
    commands = parser.add_subparsers(dest="entry", required=True)
    for name, entry in entries.items():
        sub = commands.add_parser(name.replace("_", "-"), help=inspect.getdoc(entry))
        for p in list(inspect.signature(entry).parameters.values())[1:]:
            flag = "--" + p.name.replace("_", "-")
            if isinstance(p.default, bool):
                sub.add_argument(flag, action="store_true")
            elif p.default is inspect.Parameter.empty:
                sub.add_argument(flag, required=True)
            else:
                sub.add_argument(flag, type=type(p.default), default=p.default)
    given = vars(parser.parse_args(args))
    entry = entries[given.pop("entry").replace("-", "_")]
    from trajlake.session import build_session

    print(json.dumps(entry(build_session("trajlake"), **given), ensure_ascii=False, indent=2, sort_keys=True, default=str))


if __name__ == "__main__":
    main()
