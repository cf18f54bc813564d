import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from trajlake.sources import jsonl, sinks
from trajlake.streaming import bronze

NAME = "quessel_20260527_v11_openai.jsonl"


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(text.encode())
    return path


def test_physical_lines_over_many_splits(spark, tmp_path):
    lines = [json.dumps({"i": i, "pad": "x" * (i % 50)}) if i % 7 else "" for i in range(1, 3000)]
    write(tmp_path, NAME, "\n".join(lines))
    write(tmp_path, "b b_20260527_v12_openai.jsonl", '{"i":1}\r\n\r\n{"i":3}\r\n')
    write(tmp_path, "other.txt", "no")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        rows = jsonl.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {(r["file"], r["line"]): json.loads(r["value"])["i"] for r in rows}
    wanted = {(NAME, i): i for i in range(1, 3000) if i % 7} | {("b b_20260527_v12_openai.jsonl", i): i for i in (1, 3)}
    assert got == wanted
    assert jsonl.first_lines(jsonl.read_lines(spark, str(tmp_path)), 2).count() == 4


def test_version_and_layout(spark, tmp_path):
    df = spark.createDataFrame([(NAME,), ("odd.jsonl",)], "f string")
    assert [r[0] for r in df.select(jsonl.file_version(F.col("f"), strict=False)).collect()] == ["20260527_v11", None]
    with pytest.raises(Exception, match="no version"):
        df.select(jsonl.file_version(F.col("f"))).collect()
    layout = jsonl.Layout([("quessel_", "special.jsonl", ["q_{version}.jsonl", "q_v{suffix}.jsonl"], "15"), ("quessel_", "q_{suffix}_manifest.jsonl", ["q_{version}.jsonl", "q_v{suffix}.jsonl"])])
    d = str(tmp_path)
    assert layout.companions(NAME, "m", d) == ("m/q_11_manifest.jsonl", f"{d}/q_20260527_v11.jsonl")
    write(d, "q_v11.jsonl", "")
    assert layout.companions(NAME, "m", d)[1] == f"{d}/q_v11.jsonl"
    assert layout.companions(NAME.replace("v11", "v15"), "m", d)[0] == "m/special.jsonl"
    with pytest.raises(FileNotFoundError):
        layout.companions(NAME.replace("v11", "v12"), "m", d, must_exist=True)
    with pytest.raises(ValueError):
        layout.companions("other_20260527_v11_openai.jsonl", "m", d)


def test_tolerant_parsing_and_conversations(spark, tmp_path):
    message = {"role": "assistant", "content": ["x"], "tool_calls": [{"id": "c", "function": {"name": "bash", "arguments": {"b": 1, "a": 2}}}]}
    write(tmp_path, NAME, "\n".join([json.dumps({"id": 5, "task_id": "t", "_source": "s", "tools": [], "messages": [message, {"role": "user", "content": "hi"}]}), "[1]", "{broken", '{"messages": null}']))
    rows = jsonl.parsed(jsonl.read_lines(spark, str(tmp_path)))
    assert {r["line"]: r["status"] for r in rows.collect()} == {1: "object", 2: "not_object", 3: "invalid", 4: "object"}
    with pytest.raises(ValueError, match="no JSON objects"):
        jsonl.require_objects(rows)
    got = {r["line"]: r for r in jsonl.conversations(rows).collect()}
    first = got[1]["messages"][0]
    assert (got[1]["id"], got[1]["task_id"], got[1]["tools_type"], got[4]["tools_type"]) == (None, "t", "list", "missing")
    assert (first["content"], first["content_type"], got[1]["messages"][1]["content"]) == (None, "list", "hi")
    assert json.loads(first["tool_calls"]) == message["tool_calls"] and got[4]["messages"] == []
    assert {r["key"]: r["objects"] for r in jsonl.key_profile(rows).collect()}["messages"] == 2
    assert {(r["file"], r["status"]): r["lines"] for r in jsonl.line_report(rows).collect()}[(None, None)] == 4


def test_typed_manifests(spark, tmp_path):
    write(tmp_path, "m.jsonl", '{"v":"1","task_id":"t","gold_answer":{"text":"x"},"expected_tables":["a"],"citation":{"doc_id":"d"}}\n{"v":"1","task_id":"u","gold_answer":"y"}')
    rows = jsonl.typed(jsonl.read_lines(spark, str(tmp_path)), jsonl.manifest_schema()).orderBy("line").collect()
    assert [json.loads(rows[0]["gold_answer"]), rows[1]["gold_answer"], rows[0]["citation"]["doc_id"]] == [{"text": "x"}, "y", "d"]


def test_jsonl_sink(spark, tmp_path):
    df = spark.createDataFrame([(2, "中"), (1, None)], "i int, t string")
    out = f"{tmp_path}/out"
    sinks.write_jsonl(df, out, ["i"], files=1, expected=2)
    text = "".join(open(f"{out}/{f}", encoding="utf-8").read() for f in os.listdir(out) if f.startswith("part"))
    assert text == '{"i":1}\n{"i":2,"t":"中"}\n'
    with pytest.raises(ValueError):
        sinks.write_jsonl(df, out, expected=3)
    assert spark.read.text(out).count() == 2 and os.listdir(tmp_path) == ["out"]
    sums = {r["file"]: r for r in sinks.checksums(spark, out).collect()}
    name = next(f for f in os.listdir(out) if f.startswith("part"))
    data = open(f"{out}/{name}", "rb").read()
    assert (sums[name]["bytes"], sums[name]["sha256"]) == (len(data), hashlib.sha256(data).hexdigest())


def test_groups_and_summary(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "g string, i int")
    assert sinks.write_groups(df, "g", f"{tmp_path}/sets", ["a", "b", "c"]) == {"a": 2, "b": 1, "c": 0}
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_path}/sets/group=a").collect()) == ['{"i":1}', '{"i":2}']
    with pytest.raises(ValueError, match="unknown groups"):
        sinks.write_groups(df, "g", f"{tmp_path}/other", ["a"])
    assert not os.path.exists(f"{tmp_path}/other")
    sinks.write_summary(spark, f"{tmp_path}/s.json", {"b": 1, "a": sinks.nested_counts(df, ["g", "i"])})
    assert json.load(open(f"{tmp_path}/s.json")) == {"a": {"a": {"1": 1, "2": 1}, "b": {"3": 1}}, "b": 1}
    assert sinks.without_text(df, ["i"]).columns == ["i"]
    with pytest.raises(ValueError):
        sinks.without_text(df, ["x"])


def test_stream(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    record = {"id": "r1", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "answer"}]}
    write(f"{tmp_path}/in", "a.jsonl", json.dumps(record) + "\n\n{broken\n")
    run = lambda: bronze.write_table(bronze.stream_audits(bronze.stream_lines(spark, f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    run()
    write(f"{tmp_path}/in", "b.jsonl", json.dumps(record | {"id": "r2"}) + "\n")
    run()
    got = {r["id"]: r["final_assistant_chars"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"r1": 6, "r2": 6}
    counts = bronze.status_counts(bronze.stream_lines(spark, f"{tmp_path}/in")).writeStream.format("memory").queryName("statuses").outputMode("complete").trigger(availableNow=True).start()
    counts.awaitTermination()
    assert {(r["file"], r["status"]): r["lines"] for r in spark.sql("SELECT * FROM statuses").collect()} == {("a.jsonl", "object"): 1, ("a.jsonl", "invalid"): 1, ("b.jsonl", "object"): 1}
