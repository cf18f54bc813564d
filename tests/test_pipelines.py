import json
import os

import pytest

from trajlake import pipelines
from trajlake.operators import convert, tokens

NAME = "quessel_20260527_v11_openai.jsonl"


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
    return str(folder)


def raw(question, answer="a long enough final answer for the plan, with some words", **more):
    call = {"id": "c1", "type": "function", "function": {"name": "bash", "arguments": json.dumps({"command": "ls"})}}
    return {"_source": None, "messages": [{"role": "system", "content": "bash read write edit"}, {"role": "user", "content": question}, {"role": "assistant", "content": "", "reasoning_content": "hm", "tool_calls": [call]}, {"role": "tool", "content": "out", "tool_call_id": "c1"}, {"role": "assistant", "content": answer}]} | more


@pytest.fixture
def files(tmp_path):
    data = put(tmp_path / "data", NAME, [raw("one"), raw("two", "short"), raw("three ")])
    manifests = put(tmp_path / "m", "m.jsonl", [{"v": "20260527_v11", "task_id": f"t{i}", "instruction": t, "type": "kb", "gold_answer": "x", "source_documents": ["d"]} for i, t in enumerate(["one", "two", "three"])])
    verdicts = put(tmp_path / "v", "v.jsonl", [{"v": "20260527_v11", "task_id": f"t{i}", "verdict": v, "type": "kb", "evidence": {}} for i, v in enumerate(["correct", "wrong", "correct"])])
    return data, manifests, verdicts, str(tmp_path)


def lines(spark, path):
    return [json.loads(r["value"]) for r in spark.read.text(path).collect()]


def test_prepare(spark, files):
    data, manifests, verdicts, out = files
    report = pipelines.prepare(spark, f"{data}/{NAME}", manifests, verdicts, f"{out}/train", f"{out}/meta", require_tool_roundtrip=True)
    assert report["written"] == 2 and report["unmatched"] == 0
    rows = lines(spark, f"{out}/train")
    assert [m["role"] for m in rows[0]["messages"]] == ["system", "user", "assistant", "tool_call", "tool_response", "assistant"]
    assert [(r["source_line"], r["task_id"], r["conversion"]["tool_calls"]) for r in lines(spark, f"{out}/meta")] == [(1, "t0", 1), (3, "t2", 1)]
    with open(f"{data}/{NAME}", "a") as f:
        f.write("\n" + json.dumps(raw("nobody asked this")))
    with pytest.raises(ValueError, match="nothing written"):
        pipelines.prepare(spark, f"{data}/{NAME}", manifests, verdicts, f"{out}/train2", f"{out}/meta2")
    assert not os.path.exists(f"{out}/train2")


def test_audit_plan_materialize_rejudge(spark, files):
    data, manifests, _, out = files
    catalog = [{"source_file": NAME, "source_line": i, "source_family": "quessel-v3", "version": "20260527_v11", "task_id": f"t{i - 1}", "type": "kb", "quality_tier": "kb_rule_only", "characters": 100, "input_tokens": 1000 + i, "supervised_tokens": 300, "supervised_ratio": 0.3} for i in (1, 2, 3)]
    put(out, "catalog.jsonl", catalog)
    summary = pipelines.audit_quality(spark, data, f"{out}/catalog.jsonl", f"{out}/quality", f"{out}/quality.json")
    assert summary["records"] == 3 and "one" not in json.dumps(lines(spark, f"{out}/quality"))
    assert summary["by_quality_tier"]["kb_rule_only"]["records"] == 3 and summary["by_type"]["kb"]["tool_error_records"] == 0
    assert summary["top_level_tools_present"] == 0 and summary["distinct_system_prompts"] == 1 and summary["system_tool_contract_present"] == 3
    # of a repeated place the last row counts
    put(out, "twice.jsonl", [catalog[0] | {"type": "old"}, *catalog])
    assert set(pipelines.audit_quality(spark, data, f"{out}/twice.jsonl", f"{out}/quality2", f"{out}/quality2.json")["by_type"]) == {"kb"}
    summary = pipelines.plan(spark, f"{out}/catalog.jsonl", f"{out}/quality", f"{out}/plan", f"{out}/plan.json")
    assert summary["excluded"] == {"short_final_answer": 1} and summary["selected"] == 2
    summary = pipelines.materialize_plan_sets(spark, f"{out}/plan", data, f"{out}/sets", f"{out}/sets.json")
    assert sum(summary["sets"].values()) == 2 and all(len(f["sha256"]) == 64 for f in summary["files"])
    summary = pipelines.rejudge(spark, f"{out}/plan", data, manifests, f"{out}/decisions", f"{out}/decisions.json")
    assert summary["records"] == 2 and set(summary["by_status"]) <= {"auto_pass", "auto_reject", "manual_review"}
    reversed_plan = lines(spark, f"{out}/plan")[::-1]
    put(out, "reversed.jsonl", reversed_plan)
    pipelines.rejudge(spark, f"{out}/reversed.jsonl", data, manifests, f"{out}/decisions2", f"{out}/decisions2.json")
    assert [r["source_line"] for r in lines(spark, f"{out}/decisions2")] == [r["source_line"] for r in reversed_plan]
    summary = pipelines.select_longest(spark, f"{out}/plan", f"{out}/longest", f"{out}/longest.json", limit=sum(r["split"] == "train" for r in lines(spark, f"{out}/plan")))
    assert summary["records"] == len(lines(spark, f"{out}/longest"))
    put(out, "bad.jsonl", catalog[:1] + [catalog[1] | {"source_line": 99}])
    with pytest.raises(ValueError, match="missing"):
        pipelines.audit_quality(spark, data, f"{out}/bad.jsonl", f"{out}/q2", f"{out}/q2.json")


def test_audits_hold_no_text(spark, files):
    data, _, verdicts, _ = files
    report = pipelines.audit_trajectories(spark, data)
    assert report["pairing"] == {"calls": 3, "responses": 3, "unknown": 0, "repeated": 0, "unanswered": 0}
    assert report["arguments"] == {"bash": {"command": 3}} and "final answer" not in json.dumps(report)
    assert pipelines.audit_trajectories(spark, data, 1)["final_roles"] == {"assistant": 1}
    assert pipelines.audit_verdicts(spark, verdicts)["verdicts"] == {"20260527_v11": {"correct": 2, "wrong": 1}}


def test_token_counts_and_problems(spark):
    kind = f"id int, tools string, messages {convert.OUT}"
    good = [("system", "s", None), ("tool_call", "{}", True), ("tool_response", "r", None), ("assistant", "a b", True)]
    bad = [("user", "u", True), ("tool_response", "r", True), ("tool_call", "{}", None), ("assistant", "<think>", True)]
    df = spark.createDataFrame([(1, convert.tool_schema(), good), (2, "[]", bad), (3, None, None)], kind)
    counted = {r["id"]: (r["input_tokens"], r["supervised_tokens"]) for r in tokens.count_tokens(df, "id", lambda: str.split, "{role} {content}").collect()}
    assert counted == {1: (9, 5), 2: (8, 6), 3: (0, 0)}
    got = {r["id"]: r["problems"] for r in tokens.training_problems(df).collect()}
    assert got[1] == [] and got[2] == ["tools_contract", "tool_call_not_supervised", "tool_response_supervised", "prompt_supervised", "open_thinking"]
    ratio = spark.createDataFrame([(3464, 416), (0, 0)], "input_tokens bigint, supervised_tokens bigint").select(tokens.supervised_ratio())
    assert [r[0] for r in ratio.collect()] == [0.120092, 0.0]
