"""Runs over raw files: candidates, catalogs, materialised sets, samples, encoding checks."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.test_pipelines import lines, put, raw
from trajlake import catalog
from trajlake.operators import convert
from trajlake.sources.jsonl import Layout
from trajlake.sources.layouts import LAYOUTS, layout

VOCAB = "/opt/tokenizers/byte_bpe_50k.tiktoken"
needs_vocab = pytest.mark.skipif(not os.path.isfile(VOCAB), reason="no vocabulary")
A, B = "glm52_20260527_v15_openai.jsonl", "qwen37max_20260601_v16_openai.jsonl"


def test_layouts(tmp_path):
    d = str(tmp_path)
    fixed, upstream = layout("fixed"), layout("upstream_openai")
    assert fixed.companions(A, "m", "v") == ("m/trajectories_glm52_v15_manifest.jsonl", "v/aliyun-glm-5.2_v15_fixed.jsonl")
    assert fixed.companions(B, "m", "v") == ("m/trajectories_qwen37max_v16_manifest.jsonl", "v/aliyun-qwen3.7-max_v16_fixed.jsonl")
    assert fixed.companions(B.replace("v16", "v15"), "m", "v")[0] == "m/trajectories_qwen37max_manifest.jsonl"
    assert upstream.companions(B, "m", d)[1] == f"{d}/aliyun-qwen3.7-max_20260601_v16_openai.jsonl"
    put(d, "aliyun-qwen3.7-max_v16_openai.jsonl", [{}])
    assert upstream.companions(B, "m", d)[1] == f"{d}/aliyun-qwen3.7-max_v16_openai.jsonl"
    assert layout(fixed) is fixed and isinstance(fixed, Layout) and set(LAYOUTS) == {"fixed", "upstream_openai"}
    with pytest.raises(ValueError):
        layout("other")
    with pytest.raises(ValueError):
        fixed.companions("odd_20260601_v16_openai.jsonl", "m", "v")


def test_tool_contract():
    tools = json.loads(convert.tool_schema())
    assert [t["function"]["name"] for t in tools] == ["bash", "read", "write", "edit"]
    assert all(t["function"]["description"] and t["function"]["parameters"]["additionalProperties"] is False for t in tools)
    edit = tools[3]["function"]["parameters"]
    assert list(edit) == ["type", "properties", "required", "anyOf", "additionalProperties"] and edit["properties"]["edits"]["items"]["required"] == ["oldText", "newText"]
    assert tools[1]["function"]["parameters"]["properties"]["offset"]["minimum"] == 0


@pytest.fixture
def folders(tmp_path):
    wrong_tool = raw("four")
    wrong_tool["messages"][2]["tool_calls"][0]["function"]["name"] = "python"
    unanswered = raw("five")
    del unanswered["messages"][3]
    a = [raw("one"), raw("two"), raw(" three "), wrong_tool, unanswered, raw("nobody asked"), raw("six") | {"messages": raw("six")["messages"][:4]}]
    data = put(tmp_path / "data", A, a)
    put(tmp_path / "data", B, [raw("one"), {"_source": "s7", "messages": raw("any text")["messages"]}])
    version = {"m15": "20260527_v15", "m16": "20260601_v16"}
    tasks = ["one", "two", "three", "four", "five", "six"]
    put(tmp_path / "m", "trajectories_glm52_v15_manifest.jsonl", [{"v": version["m15"], "task_id": f"t{i}", "instruction": t, "type": "kb"} for i, t in enumerate(tasks)] + [{"v": "other", "task_id": "x", "instruction": "nobody asked"}])
    put(tmp_path / "m", "trajectories_qwen37max_v16_manifest.jsonl", [{"v": version["m16"], "task_id": "u0", "instruction": "one"}, {"v": version["m16"], "task_id": "u7", "instruction": "seven", "output": "/o/s7"}])
    fixed = [("aliyun-glm-5.2_v15_fixed.jsonl", "m15", [(f"t{i}", "wrong" if i == 1 else "correct") for i in range(6)]), ("aliyun-qwen3.7-max_v16_fixed.jsonl", "m16", [("u0", "correct"), ("u7", "correct")])]
    for name, v, verdicts in fixed:
        rows = [{"v": version[v], "task_id": t, "verdict": x, "type": "kb", "evidence": {"agent_sql_ok": t == "u0", "answer_type": "text"}} for t, x in verdicts]
        put(tmp_path / "v", name, rows)
        put(tmp_path / "w", name.replace("_v15_fixed", "_20260527_v15_openai").replace("_v16_fixed", "_v16_openai"), [r for r in rows if r["task_id"] not in ("t3", "t4", "t5")])
    return data, str(tmp_path / "m"), str(tmp_path / "v"), str(tmp_path)


def test_candidate_report(spark, folders):
    data, m, v, _ = folders
    report = catalog.catalog_candidates(spark, data, m, v)
    assert report["status"] == {A: {"candidate": 2, "not_correct": 1, "noncanonical_tools": 1, "conversion_error": 1, "unaligned": 1, "no_final_assistant": 1}, B: {"candidate": 2}}
    assert report["methods"] == {A: {"position": 5, "unique_text": 1, "unresolved": 1}, B: {"unique_text": 1, "source": 1}}
    assert report["problems"] == {A: {"noncanonical_tool_name": 1, convert.UNANSWERED: 1}}
    assert report["tasks"] == {"unique": 4, "groups": 0, "records": 0} and report["sizes"]["tool_calls"]["max"] == 1
    put(v, "aliyun-glm-5.2_v15_fixed.jsonl", [{"v": "20260527_v15", "task_id": "t0", "verdict": x} for x in ("correct", "wrong")])
    with pytest.raises(ValueError, match="conflicting"):
        catalog.catalog_candidates(spark, data, m, v)
    with pytest.raises(FileNotFoundError):
        os.makedirs(f"{data}/none")
        catalog.catalog_candidates(spark, f"{data}/none", m, v)


@needs_vocab
def test_analyze_estimate_materialize_verify(spark, folders):
    data, m, v, out = folders
    summary = catalog.analyze_tokens(spark, data, m, v, VOCAB, f"{out}/tokens", f"{out}/tokens.json", benchmark_output_dir=f"{out}/bench", benchmark_targets="10, 5000")
    rows = lines(spark, f"{out}/tokens")
    assert summary["candidates"] == 4 == len(rows) and summary["by_source_family"]["glm-5.2"]["records"] == 2
    assert {(r["source_file"], r["source_line"], r["task_id"], r["quality_tier"]) for r in rows} == {(A, 1, "t0", "kb_rule_only"), (A, 3, "t2", "kb_rule_only"), (B, 1, "u0", "sql_result_verified"), (B, 2, "u7", "kb_rule_only")}
    assert all(0 < r["supervised_tokens"] < r["input_tokens"] and r["length_bucket"] == "1-2048" for r in rows)
    assert json.load(open(f"{out}/tokens.json"))["candidates"] == 4 and set(summary["benchmark_choices"]) == {"10", "5000"}
    files = sorted(f for f in os.listdir(f"{out}/bench") if not f.startswith("."))
    assert len(files) == 4 and files[0].startswith("target_10_actual_")
    sample = json.loads(open(f"{out}/bench/{files[0]}").read())
    assert sample["tools"] == convert.tool_schema() and "loss" not in sample["messages"][0] and sample["messages"][-1]["loss"]

    put(out, "calibration.jsonl", [{**r, "input_tokens": 77} for r in rows if r["source_line"] == 1] + [{**rows[0], "source_line": 99}])
    summary = catalog.estimate_tokens(spark, data, m, v, f"{out}/calibration.jsonl", f"{out}/estimated", f"{out}/estimated.json")
    got = {(r["source_file"], r["source_line"]): r for r in lines(spark, f"{out}/estimated")}
    assert summary["methods"] == {"exact_reused": 2, "estimated_by_calibration": 2} and summary["calibration_only"] == 1 and summary["current_only"] == 2
    assert got[A, 1]["input_tokens"] == 77 == got[A, 1]["input_tokens_estimate_high"] and got[A, 3]["token_method"] == "estimated_by_calibration"

    report = catalog.materialize_candidates(spark, f"{out}/tokens", data, f"{out}/train")
    part = next(f for f in os.listdir(f"{out}/train") if f.startswith("part") and os.path.getsize(f"{out}/train/{f}"))
    assert report["records"] == 4 and {f["file"]: f["sha256"] for f in report["files"]}[part] == hashlib.sha256(open(f"{out}/train/{part}", "rb").read()).hexdigest()
    assert catalog.verify_encoding(spark, f"{out}/train", VOCAB)["records"] == 4
    put(out, "drift.jsonl", [{"source_file": A, "source_line": 4}])
    with pytest.raises(ValueError, match="tool_schema_drift"):
        catalog.materialize_candidates(spark, f"{out}/drift.jsonl", data, f"{out}/t2")
    put(out, "gone.jsonl", [{"source_file": A, "source_line": 400}])
    with pytest.raises(ValueError, match="missing"):
        catalog.materialize_candidates(spark, f"{out}/gone.jsonl", data, f"{out}/t2")
    assert not os.path.exists(f"{out}/t2")
    samples = catalog.benchmark_samples(spark, f"{out}/estimated", data, f"{out}/bench2", "50")
    assert samples["50"]["actual_tokens"] == 77 and os.path.exists(samples["50"]["data"])

    bad = json.loads(lines(spark, f"{out}/train")[0]["messages"] and json.dumps(lines(spark, f"{out}/train")[0]))
    for message in bad["messages"]:
        message.pop("loss", None)
    put(out, "bad.jsonl", [bad])
    with pytest.raises(ValueError, match="nothing_supervised"):
        catalog.verify_encoding(spark, f"{out}/bad.jsonl", VOCAB)
    both = catalog.union_sets(spark, f"{out}/train,{out}/bad.jsonl", f"{out}/union")
    assert both["records"] == 5 and lines(spark, f"{out}/union")[-1] == bad


def test_materialize_correct(spark, folders):
    data, m, _, out = folders
    report = catalog.materialize_correct(spark, data, m, f"{out}/w", f"{out}/correct")
    assert report["by_source"] == {A: {"raw_records": 7, "verdict_records": 3, "correct_records": 2}, B: {"raw_records": 2, "verdict_records": 2, "correct_records": 2}}
    assert [r["messages"][1]["content"] for r in lines(spark, f"{out}/correct")] == ["one", " three ", "one", "any text"] or len(lines(spark, f"{out}/correct")) == 4
    put(f"{out}/w", "aliyun-glm-5.2_20260527_v15_openai.jsonl", [{"v": "20260527_v15", "task_id": "never", "verdict": "correct"}])
    with pytest.raises(ValueError, match="missing"):
        catalog.materialize_correct(spark, data, m, f"{out}/w", f"{out}/correct2")
    with pytest.raises(FileNotFoundError):
        catalog.materialize_correct(spark, data, m, f"{out}/none", f"{out}/correct2")


def test_samples_with_variants(spark, folders):
    data, _, _, out = folders
    put(f"{out}/mm", "a.jsonl", [{"v": "20260527_v15", "task_id": "t0", "instruction": "one", "gold_answer": {"text": "g", "value": 3}}, {"v": "20260527_v15", "task_id": "t0", "instruction": "one", "gold_answer": {"value": 3, "text": "g"}}])
    put(f"{out}/mm", "b.jsonl", [{"v": "20260527_v15", "task_id": "t0", "instruction": "two", "gold_answer": "h"}])
    put(out, "decisions.jsonl", [{"source_file": A, "source_line": i, "version": "20260527_v15", "task_id": t, "status": "manual_review", "reason": r} for i, t, r in ((1, "t0", "x"), (2, "t1", "x"), (3, "t2", "x"), (4, "t3", "y"))])
    shown = catalog.inspect_samples(spark, f"{out}/decisions.jsonl", data, f"{out}/mm", per_reason=2, text_limit=5)
    assert [(r["source_line"], r["manifest_variant_count"], r["manifest_files"]) for r in shown] == [(1, 2, ["a.jsonl", "b.jsonl"]), (2, 0, []), (4, 0, [])]
    assert shown[0]["gold_answer"] == "g\n3" and shown[0]["final_answer"] == "a lon…" and shown[0]["tool_calls"].startswith("bash\n")


def test_large_files_are_streamed(spark, tmp_path, monkeypatch):
    from trajlake.sources import sinks

    put(tmp_path / "x", "a b.txt", [{"a": 1}])
    put(tmp_path / "x", "big.txt", [{"a": "x" * 5000}])
    monkeypatch.setattr(sinks, "ONE_ROW", 1000)
    got = {r["file"]: (r["bytes"], r["sha256"]) for r in sinks.checksums(spark, str(tmp_path / "x")).collect()}
    assert got == {f: (os.path.getsize(tmp_path / "x" / f), hashlib.sha256((tmp_path / "x" / f).read_bytes()).hexdigest()) for f in ("a b.txt", "big.txt")}
