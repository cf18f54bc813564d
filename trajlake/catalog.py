"""End-to-end runs over raw files: candidates, token catalogs, materialised sets, samples, encoding checks.

Like trajlake.pipelines, whose command line lists them too. Each run parses its files once: what later
steps and counts need lies in a work table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions import calls as C
from trajlake.functions.labels import evidence_tier, family_of_file, first_of, ratio_bucket, shortened, token_bucket
from trajlake.functions.text import nfkc
from trajlake.operators import calibrate, convert, identity, ingest, planning, review, stats, tokens
from trajlake.session import release, work_table
from trajlake.sources import jsonl, sinks
from trajlake.sources.layouts import FAMILIES, layout

from .pipelines import PLACE, manifest_rows, records, rows_of

BOUNDARIES = [8_192, 16_384, 32_768]


def companions(spark: SparkSession, data_dir: str, manifests_dir: str, verdicts_dir: str, verdict_layout="fixed") -> DataFrame:
    """source_file, version, manifest and verdicts (paths) of every trajectory file in a folder, one row a file."""
    rules, rows = layout(verdict_layout), []
    for name in sinks.files_in(spark, data_dir, ".jsonl"):
        manifest, verdict = rules.companions(name, manifests_dir, verdicts_dir, exists=lambda p: sinks.exists(spark, p))
        version = spark.range(1).select(jsonl.file_version(F.lit(name))).first()[0]
        rows.append((name, version, manifest, verdict))
    if not rows:
        raise FileNotFoundError(f"no trajectory files in {data_dir}")
    return spark.createDataFrame(rows, "source_file string, version string, manifest string, verdicts string")


def _lines_of(spark: SparkSession, files: DataFrame, column: str, schema) -> DataFrame:
    """Typed lines of the companion files, once for each trajectory file they belong to; versions must agree."""
    paths = sorted({r[column] for r in files.select(column).collect()})
    read = None
    for path in paths:
        one = jsonl.typed(jsonl.read_lines(spark, path, pattern=""), schema).withColumn(column, F.lit(path))
        read = one if read is None else read.unionByName(one)
    # one row a trajectory file: as many as the folder lists
    return read.join(F.broadcast(files.select("source_file", "version", column)), column).filter(F.col("v") == F.col("version")).drop(column)


def aligned(spark: SparkSession, data_dir: str, files: DataFrame) -> DataFrame:
    """Every record with task, method and its file's verdict row (verdict, type, evidence); conflicting verdicts raise."""
    verdicts = _lines_of(spark, files, "verdicts", jsonl.verdict_schema())
    clash = ingest.conflicts(verdicts, ["source_file", "task_id"], F.col("verdict")).filter("conflict").select("source_file", "task_id").limit(10).collect()
    if clash:
        raise ValueError(f"conflicting verdicts: {[tuple(r) for r in clash]}")
    verdicts = ingest.last_wins(verdicts, ["source_file", "task_id"], ["file", "line"]).select("source_file", F.col("task_id").alias("task"), "verdict", "type", "evidence")
    m = _lines_of(spark, files, "manifest", jsonl.manifest_schema()).drop("v").withColumn("instruction", nfkc(F.col("instruction"))).withColumnRenamed("source_file", "v")
    index = identity.manifest_index(m, F.col("instruction"), F.col("output"), ["file", "line"])
    # a task is looked up in the manifest of the record's own file
    rows = records(spark, data_dir).withColumns({"version": F.col("source_file"), "line": F.col("source_line"), "text": nfkc(C.first_user(F.col("messages")))})
    rows = identity.resolve(rows, index).drop("version", "line", "text").join(F.broadcast(files.select("source_file", "version")), "source_file")
    return rows.join(verdicts, ["source_file", "task"], "left")


def candidates(rows: DataFrame) -> DataFrame:
    """Aligned records with status (the first gate that isn't passed, or 'candidate'), problem, conversion and converted, as a work table."""
    rows = convert.convert(rows, keep_calls=True)
    last = F.try_element_at("converted", F.lit(-1))["role"]
    tools = C.tools_status(F.col("calls"))
    gates = [
        (F.col("task").isNotNull(), "unaligned"),
        (F.col("verdict") == "correct", "not_correct"),
        (F.col("error").isNull(), "conversion_error"),
        (last == "assistant", "no_final_assistant"),
        (F.size("calls") > 0, "no_tool_roundtrip"),
        (tools == "canonical", "noncanonical_tools"),
    ]
    status = first_of(gates, "candidate")
    problem = F.when(status == "conversion_error", F.col("error")).when(status == "noncanonical_tools", tools)
    kept = [*PLACE, "version", F.col("task").alias("task_id"), "method", "verdict", "type", "evidence", status.alias("status"), problem.alias("problem"), "conversion"]
    return work_table(rows.select(*kept, F.when(status == "candidate", F.col("converted")).alias("converted")), "candidates")


def _counts(rows: DataFrame, *columns: str) -> dict:
    return sinks.nested_counts(rows, list(columns))


def _spread(rows: DataFrame, values: dict[str, Column], ratios: list[float]) -> dict:
    """min, max, total and nearest-rank percentiles of several values of rows."""
    named = rows.select(*(v.cast("double").alias(n) for n, v in values.items()))
    ends = named.agg(*(f(n).alias(f"{n}_{k}") for n in values for k, f in (("min", F.min), ("max", F.max), ("total", F.sum)))).first()
    ranks = stats.nearest_rank(named, [], list(values), ratios).first()
    pick = lambda n: {k: ends[f"{n}_{k}"] for k in ("min", "max", "total")} | {f"p{round(r * 100):02d}": ranks[f"{n}_p{round(r * 100):02d}"] if ranks else None for r in ratios}
    return {n: pick(n) for n in values}


def catalog_candidates(spark: SparkSession, data_dir: str, manifests_dir: str, verdicts_dir: str, verdict_layout: str = "fixed") -> dict:
    """How many records of each file pass which gate, and the spread of the candidates' sizes."""
    rows = candidates(aligned(spark, data_dir, companions(spark, data_dir, manifests_dir, verdicts_dir, verdict_layout)))
    good = rows.filter("status = 'candidate'")
    sizes = {"characters": F.col("conversion.characters"), "messages": F.col("conversion.output_messages"), "tool_calls": F.col("conversion.tool_calls")}
    groups = lambda *by: {"unique": good.select(*by).distinct().count(), **stats.duplicate_groups(good, list(by)).first().asDict()}
    report = {
        "records": rows.count(),
        "methods": _counts(rows, "source_file", "method"),
        "verdicts": _counts(rows.filter("task_id IS NOT NULL"), "source_file", "verdict"),
        "status": _counts(rows, "source_file", "status"),
        "problems": _counts(rows.filter("problem IS NOT NULL"), "source_file", "problem"),
        "version_tasks": groups("version", "task_id"),
        "tasks": groups("task_id"),
        "sizes": _spread(good, sizes, [0.5, 0.9, 0.95]) if good.limit(1).count() else {},
    }
    release(spark)
    return report


def _described(rows: DataFrame) -> DataFrame:
    """Candidates as catalog rows, but for their token counts."""
    c = lambda n: F.col(f"conversion.{n}")
    return rows.select(
        *PLACE,
        family_of_file(F.col("source_file"), FAMILIES).alias("source_family"),
        "version",
        "task_id",
        "type",
        evidence_tier(F.col("evidence.agent_sql_ok"), F.col("evidence.is_report"), F.col("type")).alias("quality_tier"),
        F.coalesce("evidence.agent_sql_ok", F.lit(False)).alias("agent_sql_ok"),
        F.col("evidence.answer_type").alias("answer_type"),
        c("characters").cast("bigint").alias("characters"),
        c("output_messages").alias("messages"),
        c("tool_calls").alias("tool_calls"),
        c("assistant_content_messages").alias("assistant_messages"),
        F.lit(convert.tool_schema()).alias("tools"),
        F.col("converted").alias("training"),
    )


def _bucketed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"length_bucket": token_bucket(F.col("input_tokens")), "supervised_ratio_bucket": ratio_bucket(F.col("supervised_ratio"))})


def _grouped(rows: DataFrame, by: str) -> dict:
    return {str(r[by]): {k: v for k, v in r.asDict().items() if k != by} for r in stats.group_summary(rows, [by], "input_tokens", "supervised_tokens").collect()}


def _write_samples(spark: SparkSession, folder: str, chosen: list) -> dict:
    """For each chosen row (target, tools, training and its catalog fields) its training row and its metadata, in files of their own."""
    report = {}
    for r in chosen:
        row = r.asDict(recursive=True)
        target, tools, training = row.pop("target"), row.pop("tools"), row.pop("training")
        stem = f"{folder.rstrip('/')}/target_{target}_actual_{row['input_tokens']}"
        messages = [{k: v for k, v in m.items() if v is not None} for m in training]
        sinks.put_text(spark, f"{stem}.jsonl", json.dumps({"tools": tools, "messages": messages}, ensure_ascii=False, separators=(",", ":")) + "\n")
        sinks.write_summary(spark, f"{stem}.metadata.json", row)
        report[str(target)] = {"actual_tokens": row["input_tokens"], "data": f"{stem}.jsonl", "metadata": f"{stem}.metadata.json"}
    return report


def analyze_tokens(spark: SparkSession, data_dir: str, manifests_dir: str, verdicts_dir: str, vocab: str, catalog_output: str, summary_output: str, verdict_layout: str = "fixed", benchmark_output_dir: str = "", benchmark_targets: str = "4096,8192,16384,32768") -> dict:
    """The token catalog of all candidates, counted with the tokenizer of a rank file; its summary; one sample near each target."""
    targets = planning.parse_targets(benchmark_targets)
    rows = candidates(aligned(spark, data_dir, companions(spark, data_dir, manifests_dir, verdicts_dir, verdict_layout)))
    described = _described(rows.filter("status = 'candidate'"))
    plain = [c for c in described.columns if c not in ("tools", "training")]
    counted = tokens.token_totals(tokens.encode_rows(described.withColumnRenamed("training", "messages_").withColumnRenamed("messages", "n_messages").withColumnRenamed("messages_", "messages"), [c if c != "messages" else "n_messages" for c in plain], tokens.RankFile(vocab)))
    counted = counted.withColumnRenamed("n_messages", "messages").drop("problems")
    all_rows = work_table(_bucketed(counted.withColumn("supervised_ratio", tokens.supervised_ratio())), "token_catalog")
    kept = all_rows.filter("supervised_tokens > 0")
    n = kept.count()
    if not n:
        raise ValueError("no candidates were encoded")
    sinks.write_jsonl(kept, catalog_output, PLACE, expected=n)
    histogram = stats.histogram(kept, F.col("length_bucket"), "input_tokens", F.col("input_tokens").cast("double"))
    summary = {
        "records": rows.count(),
        "candidates": n,
        "alignment": _counts(rows, "method"),
        "status": _counts(rows, "status"),
        "without_supervised_tokens": all_rows.count() - n,
        "unique_task_ids": kept.select("task_id").distinct().count(),
        "duplicate_tasks": stats.duplicate_groups(kept, ["task_id"]).first().asDict(),
        "duplicate_version_tasks": stats.duplicate_groups(kept, ["version", "task_id"]).first().asDict(),
        "spread": _spread(kept, {c: F.col(c) for c in ("input_tokens", "supervised_tokens", "supervised_ratio")}, [0.01, 0.05, 0.5, 0.9, 0.95, 0.99]),
        "weighted_ratio": kept.agg(stats.weighted_ratio("supervised_tokens", "input_tokens")).first()[0],
        "length_buckets": {r["bucket"]: r.asDict() for r in histogram.orderBy("position").collect()},
        "supervised_ratio_buckets": _counts(kept, "supervised_ratio_bucket"),
        **{f"by_{c}": _grouped(kept, c) for c in ("source_family", "type", "quality_tier")},
    }
    best = planning.nearest(kept, targets)
    summary["benchmark_choices"] = {str(r["target"]): {k: v for k, v in r.asDict().items() if k != "target"} for r in best.collect()}
    sinks.write_summary(spark, summary_output, summary)
    if benchmark_output_dir:
        chosen = best.join(described.select(*PLACE, "tools", "training"), PLACE).collect()
        summary["benchmark_files"] = _write_samples(spark, benchmark_output_dir, chosen)
    release(spark)
    return summary


CALIBRATED = "source_file string, source_line bigint, source_family string, type string, characters bigint, input_tokens bigint, supervised_tokens bigint, supervised_ratio double"


def estimate_tokens(spark: SparkSession, data_dir: str, manifests_dir: str, verdicts_dir: str, calibration_catalog: str, catalog_output: str, summary_output: str, verdict_layout: str = "fixed") -> dict:
    """The token catalog of all candidates by ratios of a calibrated catalog, whose own counts are reused; and its summary."""
    rows = candidates(aligned(spark, data_dir, companions(spark, data_dir, manifests_dir, verdicts_dir, verdict_layout)))
    known = rows_of(spark, calibration_catalog, CALIBRATED)
    once = ingest.last_wins(known, PLACE, ["input_tokens"])
    guessed = calibrate.estimate(_described(rows.filter("status = 'candidate'")).drop("tools", "training"), known, once)
    reused = F.col("token_method") == "exact_reused"
    ratio = F.coalesce("_known_ratio", F.bround(F.col("supervised_tokens") / F.col("input_tokens"), 6))
    out = guessed.withColumnsRenamed({"estimate": "input_tokens", "supervised": "supervised_tokens", "low": "input_tokens_estimate_low", "high": "input_tokens_estimate_high"})
    out = out.withColumns({c: F.coalesce(c, "input_tokens") for c in ("input_tokens_estimate_low", "input_tokens_estimate_high")})
    out = out.join(once.select(*PLACE, F.col("supervised_ratio").alias("_known_ratio")), PLACE, "left").withColumn("supervised_ratio", ratio).drop("_known_ratio")
    out = work_table(_bucketed(out), "estimated_catalog")
    n = out.count()
    if not n:
        raise ValueError("no candidates were found")
    sinks.write_jsonl(out, catalog_output, PLACE, expected=n)
    places = ingest.reconcile(known, out, PLACE).first()
    per_char = known.withColumn("per_character", F.col("input_tokens") / F.greatest(F.lit(1), F.col("characters")))
    summary = {
        "records": n,
        "alignment": _counts(rows, "method"),
        "status": _counts(rows, "status"),
        "methods": _counts(out, "token_method"),
        "boundary_sensitive": out.filter(~reused).agg(calibrate.boundary_sensitive("input_tokens_estimate_low", "input_tokens_estimate_high", BOUNDARIES)).first()[0],
        "calibration_only": places["left_only"],
        "current_only": places["right_only"],
        "input_tokens": _spread(out, {"input_tokens": F.col("input_tokens")}, [0.5, 0.95])["input_tokens"],
        "calibration": known.agg(F.count(F.lit(1)).alias("records"), (F.sum("input_tokens") / F.sum("characters")).alias("tokens_per_character")).first().asDict() | _spread(per_char, {"per_character": F.col("per_character")}, [0.05, 0.5, 0.95]),
        "by_quality_tier": _counts(out, "quality_tier"),
        "by_length_bucket": _counts(out, "length_bucket"),
    }
    sinks.write_summary(spark, summary_output, summary)
    release(spark)
    return summary


def recheck(found: DataFrame) -> DataFrame:
    """Converted records, if each converts, ends with the assistant, calls tools and calls them canonically; else ValueError."""
    done = convert.convert(found, keep_calls=True).withColumn("tools_status", C.tools_status(F.col("calls"))).drop("calls")
    gates = [
        (F.col("error").isNull(), "conversion_error"),
        (F.try_element_at("converted", F.lit(-1))["role"] == "assistant", "lost_final_answer"),
        (F.col("conversion.tool_calls") > 0, "lost_tool_roundtrip"),
        (F.col("tools_status") == "canonical", "tool_schema_drift"),
    ]
    done = work_table(done.withColumn("gate", first_of(gates, "ok")).drop("messages"), "rechecked")
    if bad := done.filter("gate <> 'ok'").select(*PLACE, "gate", "error", "tools_status").limit(10).collect():
        raise ValueError(f"records that are no candidates any more: {[tuple(r) for r in bad]}")
    return done


def materialize_candidates(spark: SparkSession, catalog: str, data_dir: str, output: str) -> dict:
    """Training rows of every catalogued place, checked again; files in the order of their first appearance, lines ascending."""
    rows = rows_of(spark, catalog, "source_file string, source_line bigint")
    if rows.filter(F.col("source_file").isNull() | F.col("source_line").isNull()).limit(1).count():
        raise ValueError("catalog rows need a source_file and a source_line")
    rows = ingest.require_unique(rows, PLACE)
    order = [r["source_file"] for r in rows.withColumn("_at", F.monotonically_increasing_id()).groupBy("source_file").agg(F.min("_at").alias("_at")).orderBy("_at").collect()]
    if gone := sorted(set(order) - set(sinks.files_in(spark, data_dir, ".jsonl"))):
        raise FileNotFoundError(f"no files {gone}")
    found = rows.join(records(spark, data_dir).select(*PLACE, "messages"), PLACE)
    ingest.require_complete(rows, found.select(*PLACE), PLACE)
    done = recheck(found)
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("source_file")) if order else F.lit(0)
    out = done.select(*PLACE, F.lit(convert.tool_schema()).alias("tools"), F.col("converted").alias("messages")).orderBy(rank, "source_line").select("tools", "messages")
    n = rows.count()
    sinks.write_jsonl(out, output, expected=n)
    report = {"catalog": catalog, "output": output, "records": n, "source_files": len(order), "files": [r.asDict() for r in sinks.checksums(spark, output).filter("file LIKE 'part%'").orderBy("file").collect()]}
    release(spark)
    return report


def materialize_correct(spark: SparkSession, data_dir: str, manifests_dir: str, verdicts_dir: str, output: str, verdict_layout: str = "upstream_openai") -> dict:
    """The raw records of all correct verdicts; a correct verdict without record, or with two, raises.

    Lines are written as they were read, files by name, lines ascending.
    """
    files = companions(spark, data_dir, manifests_dir, verdicts_dir, verdict_layout)
    if gone := [r["verdicts"] for r in files.collect() if not sinks.exists(spark, r["verdicts"])]:
        raise FileNotFoundError(f"no verdict files {gone}")
    rows = work_table(aligned(spark, data_dir, files).select(*PLACE, "task", "verdict"), "aligned")
    chosen = rows.filter("verdict = 'correct'")
    ingest.require_unique(chosen, ["source_file", "task"])
    verdicts = ingest.last_wins(_lines_of(spark, files, "verdicts", jsonl.verdict_schema()), ["source_file", "task_id"], ["file", "line"])
    ingest.require_complete(verdicts.filter("verdict = 'correct'").select("source_file", F.col("task_id").alias("task")), chosen, ["source_file", "task"])
    raw = jsonl.read_lines(spark, data_dir).withColumnsRenamed({"file": "source_file", "line": "source_line"})
    n = chosen.count()
    lines = raw.join(chosen.select(*PLACE), PLACE).orderBy(*PLACE).select("value")
    sinks.publish(spark, output, lambda p: lines.write.text(p), lambda p: sinks.require_rows(spark, p, n))
    n_verdicts, n_rows = _counts(verdicts, "source_file"), _counts(rows, "source_file")
    correct = _counts(chosen, "source_file")
    report = {
        "output": output,
        "source_files": files.count(),
        "raw_records": rows.count(),
        "verdict_records": verdicts.count(),
        "correct_records": n,
        "by_source": {f: {"raw_records": n_rows[f], "verdict_records": n_verdicts.get(f, 0), "correct_records": correct.get(f, 0)} for f in n_rows},
        "files": [r.asDict() for r in sinks.checksums(spark, output).filter("file LIKE 'part%'").orderBy("file").collect()],
    }
    report["raw_records_without_verdict"] = report["raw_records"] - report["verdict_records"]
    release(spark)
    return report


NEAREST = CALIBRATED + ", version string, task_id string, quality_tier string, token_method string"


def benchmark_samples(spark: SparkSession, catalog: str, data_dir: str, output_dir: str, targets: str = "24576") -> dict:
    """The training row of the catalogued record nearest to each target, of exactly counted records if there are any."""
    rows = rows_of(spark, catalog, NEAREST)
    exact = rows.filter("token_method = 'exact_reused'")
    best = planning.nearest(exact if exact.limit(1).count() else rows, planning.parse_targets(targets))
    places = best.select(*PLACE).distinct()
    found = convert.convert(places.join(records(spark, data_dir).select(*PLACE, "messages"), PLACE))
    ingest.require_complete(places, found.select(*PLACE), PLACE)
    if bad := found.filter("error IS NOT NULL").select(*PLACE, "error").collect():
        raise ValueError(f"records that can't be converted: {[tuple(r) for r in bad]}")
    chosen = best.join(found.select(*PLACE, F.lit(convert.tool_schema()).alias("tools"), F.col("converted").alias("training")), PLACE).collect()
    return _write_samples(spark, output_dir, chosen)


DECISIONS = "source_file string, source_line bigint, version string, task_id string, status string, reason string, confidence string"


def decision_variants(decisions: DataFrame, manifests: DataFrame) -> DataFrame:
    """decisions (version, task_id) with manifest_variant_count, manifest_files and the manifest fields of the first variant.

    manifests: typed rows with file and line; rows of equal fingerprint are one variant.
    """
    m = manifests.withColumnRenamed("v", "version").withColumn("_print", review.manifest_fingerprint())
    groups = m.groupBy("version", "task_id").agg(
        F.count_distinct("_print").alias("manifest_variant_count"),
        F.array_sort(F.collect_set("file")).alias("manifest_files"),
        F.min_by(F.struct("gold_answer"), F.struct("file", "line")).alias("_first"),
    )
    out = decisions.join(groups, ["version", "task_id"], "left")
    return out.withColumns({"manifest_variant_count": F.coalesce("manifest_variant_count", F.lit(0)), "manifest_files": F.coalesce("manifest_files", F.array().cast("array<string>")), "gold_answer": F.col("_first.gold_answer")}).drop("_first")


def inspect_samples(spark: SparkSession, decisions: str, data_dir: str, manifests_dir: str, per_reason: int = 2, text_limit: int = 700) -> list[dict]:
    """The first decisions of each reason with their manifest variants and shortened texts; for people to read."""
    rows = rows_of(spark, decisions, DECISIONS).withColumn("_at", F.monotonically_increasing_id())
    chosen = planning.first_k(rows, ["reason"], [F.col("_at")], per_reason)
    chosen = decision_variants(chosen, manifest_rows(spark, manifests_dir))
    m = F.col("messages")
    found = chosen.join(records(spark, data_dir).select(*PLACE, "messages"), PLACE)
    ingest.require_complete(chosen.select(*PLACE), found.select(*PLACE), PLACE)
    texts = {"final_answer": C.final_answer(m), "gold_answer": F.coalesce(review.gold_answer(F.col("gold_answer"))[0], F.lit("")), "tool_responses": C.recorded_responses(m), "tool_calls": C.recorded_calls(C.tool_calls(m))}
    shown = found.withColumns({n: shortened(c, text_limit) for n, c in texts.items()}).drop("messages").orderBy("_at").drop("_at")
    return [r.asDict(recursive=True) for r in shown.collect()]


def verify_encoding(spark: SparkSession, dataset: str, vocab: str) -> dict:
    """Encodes every training row and checks tools contract, markers and supervision; ValueError names up to ten bad rows."""
    rows = spark.read.schema(f"tools string, messages {convert.OUT}").json(dataset).withColumn("record", F.monotonically_increasing_id())
    contract = tokens.training_problems(rows).select("record", F.array_intersect("problems", F.array(F.lit("tools_contract"))).alias("contract"))
    encoded = tokens.token_totals(tokens.encode_rows(rows, ["record"], tokens.RankFile(vocab))).join(contract, "record")
    done = work_table(encoded.withColumn("problems", F.concat("contract", "problems")).drop("contract").withColumn("supervised_ratio", tokens.supervised_ratio()), "encoded")
    if bad := done.filter(F.size("problems") > 0).select("record", "problems").limit(10).collect():
        raise ValueError(f"bad training rows: {[(r['record'], r['problems']) for r in bad]}")
    n = done.count()
    if not n:
        raise ValueError("the dataset is empty")
    report = {"records": n} | _spread(done, {c: F.col(c) for c in ("input_tokens", "supervised_tokens", "supervised_ratio")}, [0.5])
    release(spark)
    return report


def union_sets(spark: SparkSession, inputs: str, output: str) -> dict:
    """Several sets of JSON lines (paths separated by commas) as one, in the given order, with checksums; rows stay as they are."""
    paths = [p for p in inputs.split(",") if p]
    if not paths:
        raise ValueError("nothing to put together")
    parts, counts = [], {}
    for i, p in enumerate(paths):
        part = spark.read.text(p).filter(F.length("value") > 0)
        counts[p] = part.count()
        parts.append(part.withColumn("_set", F.lit(i)).withColumn("_at", F.monotonically_increasing_id()))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    n = sum(counts.values())
    sinks.publish(spark, output, lambda p: whole.orderBy("_set", "_at").select("value").write.text(p), lambda p: sinks.require_rows(spark, p, n))
    return {"records": n, "by_input": counts, "files": [r.asDict() for r in sinks.checksums(spark, output).filter("file LIKE 'part%'").orderBy("file").collect()]}


ENTRIES = (catalog_candidates, analyze_tokens, estimate_tokens, materialize_candidates, materialize_correct, benchmark_samples, inspect_samples, verify_encoding, union_sets)
