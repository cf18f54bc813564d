import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from trajlake.operators import audit, calibrate, convert, identity, ingest, planning, review, stats
from tests.test_functions import MESSAGES, call, m


def brute_rank(values, r):
    values = sorted(values)
    return values[round((len(values) - 1) * r)]


def test_nearest_rank_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.randint(0, 9) if rng.random() < 0.9 else None, rng.random()) for _ in range(300)] + [(None, 5, 0.5), ("d", None, None)]
    df = spark.createDataFrame(rows, "g string, x bigint, y double")
    got = {r["g"]: r for r in stats.nearest_rank(df, ["g"], ["x", "y"], [0.05, 0.5, 0.95]).collect()}
    assert set(got) == {"a", "b", "c", "d", None}
    for g in "abc":
        for name, i in (("x", 1), ("y", 2)):
            values = [r[i] for r in rows if r[0] == g and r[i] is not None]
            for p in (0.05, 0.5, 0.95):
                assert got[g][f"{name}_p{round(p * 100):02d}"] == brute_rank(values, p)
    assert got["d"]["x_p50"] is None
    assert stats.nearest_rank(df.filter("g = 'x'"), ["g"], ["x"], [0.5]).collect() == []


def test_percentile_of_four_is_half_even(spark):
    df = spark.range(1, 5).withColumnRenamed("id", "x")
    assert stats.nearest_rank(df, [], ["x"], [0.5]).first()["x_p50"] == 3
    assert df.agg(stats.median_truncated("x").alias("m")).first()["m"] == int(statistics.median([1, 2, 3, 4]))


def test_summary_with_null_groups(spark):
    df = spark.createDataFrame([("a", 100, 40), ("a", 300, 60), (None, None, None)], "g string, t bigint, s bigint")
    got = {r["g"]: r for r in stats.group_summary(df, ["g"], "t", "s").collect()}
    assert (got["a"]["records"], got["a"]["weighted_ratio"], got["a"]["t_p50"]) == (2, 0.25, 100)
    assert (got[None]["t"], got[None]["weighted_ratio"], got[None]["t_p50"]) == (0, 0.0, None)


def test_calibration_example(spark):
    cal = spark.createDataFrame([("f", "t", 100, 40, 0.1), ("f", "t", 100, 50, 0.2), ("f", "t", 100, 70, 0.3)], "source_family string, type string, characters bigint, input_tokens bigint, supervised_ratio double")
    rows = spark.createDataFrame([("f", "t", 200), ("f", "other", 200), ("g", None, 200), ("f", "t", 0)], "source_family string, type string, characters bigint")
    got = calibrate.estimate(rows, cal).select("characters", "estimate", "low", "high", "supervised").collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 1, 1)] + [(200, 100, 80, 140, 20)] * 3
    exact = spark.createDataFrame([("a", 1, 77, 7)], "source_file string, source_line bigint, input_tokens bigint, supervised_tokens bigint")
    rows = spark.createDataFrame([("f", "t", 200, "a", 1), ("f", "t", 200, "a", 2)], "source_family string, type string, characters bigint, source_file string, source_line bigint")
    got = {r["source_line"]: r for r in calibrate.estimate(rows, cal, exact).collect()}
    assert (got[1]["estimate"], got[1]["supervised"], got[1]["low"], got[1]["token_method"]) == (77, 7, None, "exact_reused")
    assert (got[2]["estimate"], got[2]["token_method"]) == (100, "estimated_by_calibration")


def brute_diverse(rows, k):
    rows = sorted(rows, key=lambda r: r[2])
    chosen, sources = [], set()
    for r in rows:
        if len(chosen) < k and r[1] not in sources:
            chosen.append(r)
            sources.add(r[1])
    for r in rows:
        if len(chosen) < k and r not in chosen:
            chosen.append(r)
    return chosen


def test_diverse_k_matches_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abcdef"), rng.choice("xyz"), i) for i in rng.sample(range(1000), 200)]
    got = planning.diverse_k(spark.createDataFrame(rows, "g string, s string, r int"), ["g"], "s", [F.col("r")], 3).collect()
    wanted = {r for g in "abcdef" for r in brute_diverse([x for x in rows if x[0] == g], 3)}
    assert {tuple(r) for r in got} == wanted


def test_gates(spark):
    columns = "input_tokens bigint, supervised_ratio double, final_assistant_chars bigint, secret_pattern_hits bigint, destructive_commands bigint, network_commands bigint"
    rows = [(100, 0.5, 100, 0, 0, 0), (100, 0.05, 10, 1, 1, 1), (0, 0.5, 100, 0, 0, 0), (40000, 0.01, 1, 0, 0, 0), (100, None, None, None, None, None), (None, 0.5, 100, 0, 0, 0)]
    got = [r["reasons"] for r in planning.gated(spark.createDataFrame(rows, columns)).collect()]
    every = ["low_supervised_ratio", "short_final_answer", "secret_pattern", "destructive_command", "network_command"]
    assert got == [[], every, ["over_32k"], ["over_32k"], [], ["over_32k"]]


def test_longest_and_nearest(spark):
    columns = "split string, phase string, input_tokens bigint, input_tokens_estimate_high bigint, source_file string, source_line bigint, supervised_ratio double, quality_tier string, supervised_tokens bigint"
    rows = [("train", "core_8k", 100, None, "a", 1, 0.5, "kb_rule_only", 5), ("train", "core_8k", 100, 150, "a", 2, 0.5, "judge_rule_only", 5), ("train", "core_8k", 100, None, "b", 1, 0.5, "kb_rule_only", 5), ("test", "core_8k", 900, None, "c", 1, 0.5, None, 5), ("train", "long_32k_review", 800, None, "c", 2, 0.5, None, 5)]
    df = spark.createDataFrame(rows, columns)
    assert [(r["source_file"], r["source_line"]) for r in planning.longest(df, 2, 1000).collect()] == [("a", 2), ("b", 1)]
    with pytest.raises(ValueError):
        planning.exactly(planning.longest(df, 9, 1000), 9)
    got = {r["target"]: (r["source_file"], r["source_line"]) for r in planning.nearest(df, [101, 850, 101]).collect()}
    assert got == {101: ("a", 1), 850: ("c", 1)}
    with pytest.raises(ValueError):
        planning.nearest(df, [0])


def test_ingest_rules(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 3, "a"), ("l", 1, None), ("l", 2, None), ("m", 1, None), ("m", 2, "x")], "k string, line int, v string")
    assert {r["k"]: r["v"] for r in ingest.last_wins(df, ["k"], ["line"]).collect()} == {"k": "a", "l": None, "m": "x"}
    assert {r["k"]: r["conflict"] for r in ingest.conflicts(df, ["k"], F.col("v")).collect()} == {"k": True, "l": False, "m": True}
    prints = df.withColumn("fp", F.coalesce("v", F.lit("")))
    got = {r["k"]: (r["line"], r["conflict"]) for r in ingest.first_of_key(prints, ["k"], "fp", ["line"]).collect()}
    assert got == {"k": (3, True), "l": (2, False), "m": (1, True)}
    with pytest.raises(ValueError, match="repeated"):
        ingest.require_unique(df, ["k"])
    other = spark.createDataFrame([("k",), ("z",)], "k string")
    with pytest.raises(ValueError, match="missing"):
        ingest.require_complete(other, df, ["k"])
    assert tuple(ingest.reconcile(df, other, ["k"]).first()) == (1, 2, 1)


def test_merge_exact(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y", 5)], "k int, v string, w int")
    assert [tuple(r) for r in ingest.merge_exact(a, b, ["k"]).collect()] == [(1, "x", 5)]
    with pytest.raises(Exception, match="key sets differ"):
        ingest.merge_exact(a, b.union(spark.createDataFrame([(2, "y", 5)], b.schema)), ["k"]).collect()


def records(spark, *messages):
    return spark.createDataFrame([(i, list(x) if x is not None else None) for i, x in enumerate(messages)], MESSAGES)


def test_conversion_of_a_whole_record(spark):
    df = records(spark, [m("system", "s"), m("user", "u"), m("assistant", " ", "inspect data", calls=[call("bash", {"command": "ls"})]), m("tool", "out", answers="c1"), m("assistant", "done")])
    r = convert.convert(df).first()
    assert r["error"] is None
    assert [x["role"] for x in r["converted"]] == ["system", "user", "assistant", "tool_call", "tool_response", "assistant"]
    assert r["converted"][2]["content"] == "<think>\ninspect data\n</think>\n\n"
    assert json.loads(r["converted"][3]["content"]) == {"name": "bash", "arguments": {"command": "ls"}}
    assert [x["loss"] for x in r["converted"]] == [None, None, True, True, None, True]
    assert (r["conversion"]["tool_calls"], r["conversion"]["output_messages"]) == (1, 6)
    assert convert.closed_round_trips(convert.convert(df)).count() == 1
    row = json.loads(convert.training_rows(convert.convert(df), "id").select(F.to_json(F.struct("tools", "messages")).alias("j")).first()["j"])
    assert "loss" not in row["messages"][0] and len(json.loads(row["tools"])) == 4


ERRORS = [
    (None, [m("user", "u"), m("assistant", "a")]),
    (convert.UNANSWERED, [m("assistant", "a", calls=[call("bash", {})])]),
    (convert.NOTHING, [m("user", "u")]),
    (convert.NOTHING, []),
    (convert.NOTHING, None),
    (convert.CONTENT, [m("user", None), m("robot", "x")]),
    (convert.ROLE, [m("robot", "x")]),
    (convert.CALL_LIST, [("assistant", "x", None, None, '{"a":1')]),
    (convert.CALL_NAME, [m("assistant", "x", calls=[call("", {})])]),
    (convert.ARGUMENTS_JSON, [m("assistant", "x", calls=[call("bash", "{broken")])]),
    (convert.ARGUMENTS_OBJECT, [m("assistant", "x", calls=[call("bash", "[1]")])]),
    (convert.TWICE_CALLED, [m("assistant", "x", calls=[call("bash", {}), call("bash", {})])]),
    (convert.UNKNOWN, [m("tool", "x", answers="zz"), m("robot", "x")]),
    (convert.UNKNOWN, [m("tool", "x", answers="c1"), m("assistant", "x", calls=[call("bash", {})])]),
    (convert.TWICE_ANSWERED, [m("assistant", "x", calls=[call("bash", {})]), m("tool", "x", answers="c1"), m("tool", "x", answers="c1")]),
    (convert.ARGUMENTS_JSON, [m("assistant", "x", calls=[call("bash", "{broken"), call("", {})]), m("robot", "x")]),
]


def test_first_error_wins(spark):
    got = {r["id"]: r["error"] for r in convert.convert(records(spark, *(x for _, x in ERRORS))).collect()}
    assert [got[i] for i in range(len(ERRORS))] == [e for e, _ in ERRORS]


def test_audit_example(spark):
    bad = {"command": "rm -rf /data/x"}
    df = records(spark, [m("system", "bash read write edit"), m("assistant", "", calls=[call("bash", bad), call("bash", bad, "c2")]), m("tool", "ERROR one", answers="c1"), m("tool", "Error: two", answers="c2"), m("assistant", "final")], [], None)
    r = {x["id"]: x for x in audit.audit(df).collect()}
    a = r[0]
    assert (a["tool_error_messages"], a["duplicate_tool_calls"], a["consecutive_duplicate_tool_calls"], a["destructive_commands"], a["nonportable_path_occurrences"], a["final_assistant_chars"]) == (2, 1, 1, 2, 2, 5)
    assert a["system_tool_contract_present"] and r[1]["total_chars"] == 0 and "messages" not in a.asDict()


def test_round_trips(spark):
    df = records(spark, [m("assistant", "", calls=[call("bash", {}), call("bash", {}, "c2"), call("bash", {}, None)]), m("tool", "", answers="c1"), m("tool", "", answers="c1"), m("tool", "", answers="zz")], [])
    assert [tuple(r)[1:] for r in audit.round_trips(df, "id").orderBy("id").collect()] == [(3, 3, 1, 1, 1), (0, 0, 0, 0, 0)]


def test_identity_order(spark):
    manifest = spark.createDataFrame([("v", "t1", "one", "x/a.md", 1), ("v", "t2", "two", "x/b.md", 2), ("v", "t3", "two", None, 3), ("v", "t4", "four", "x/a.md", 4), ("w", "t5", "five", None, 5)], "v string, task_id string, i string, o string, line int")
    index = identity.manifest_index(manifest, F.col("i"), F.col("o"), ["line"])
    assert {r["task"]: r["ordinal"] for r in index.filter("version = 'v'").collect()} == {"t1": 1, "t4": 2, "t2": 3, "t3": 4}
    rows = [("v", "b.md", 9, "x"), ("v", "a.md", 1, "one"), ("v", "none", 3, "two"), ("v", None, 8, "four"), ("v", None, 8, "two"), ("w", None, 7, "four"), ("w", None, 7, None)]
    got = identity.resolve(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, version string, source string, line int, text string"), index)
    assert {r["id"]: (r["task"], r["method"]) for r in got.collect()} == {0: ("t2", "source"), 1: ("t1", "position"), 2: ("t2", "position"), 3: ("t4", "unique_text"), 4: (None, "unresolved"), 5: (None, "unresolved"), 6: (None, "unresolved")}


def test_gold_and_expected(spark):
    rows = [('"text"',), ('{"text": "a", "value": {"n": 1}, "answer_type": "table"}',), ("plain text",), (None,), ('{"value": null}',)]
    gold, kind = review.gold_answer(F.col("g"))
    got = [tuple(r) for r in spark.createDataFrame(rows, "g string").select(gold, kind).collect()]
    assert got == [("text", ""), ('a\n{"n":1}', "table"), ("plain text", ""), ("", ""), ("", "")]
    df = spark.createDataFrame([("d1", ["d1", None, "", "d2"]), (None, None)], "c string, s array<string>")
    assert [r[0] for r in df.select(review.expected(F.col("c"), [F.col("s")])).collect()] == [["d1", "d2"], []]


def decision(spark, **given):
    base = dict(conflict=False, present=True, quality_tier="kb_rule_only", type="kb", answer_type="", gold="", instruction="", documents=[], tables=[], messages=[m("assistant", "the answer is here")])
    row = base | given
    schema = f"conflict boolean, present boolean, quality_tier string, type string, answer_type string, gold string, instruction string, documents array<string>, tables array<string>, {MESSAGES.split(', ', 1)[1]}"
    df = spark.createDataFrame([tuple(row[k] for k in base)], schema)
    return tuple(review.with_evidence(df).select(review.decide(*review.evidence_rules()).alias("d")).select("d.status", "d.reason").first())


def test_decisions(spark):
    answer = "库存共计 1,200 件，完成率 95%。"
    read = m("assistant", "", calls=[call("read", {"path": "docs/doc_038.md"})])
    grounded = [read, m("tool", answer, answers="c1"), m("assistant", answer)]
    assert decision(spark, conflict=True) == ("manual_review", "manifest_conflict")
    assert decision(spark, present=False) == ("manual_review", "manifest_missing")
    assert decision(spark, quality_tier="sql_result_verified", messages=[]) == ("auto_pass", "sql_result_verified")
    assert decision(spark, messages=[m("assistant", "  ")]) == ("auto_reject", "empty_final_answer")
    assert decision(spark, documents=["doc_038"], messages=grounded) == ("auto_pass", "kb_grounded_in_expected_document")
    assert decision(spark, documents=["doc_999"], messages=[m("assistant", "something else entirely here")]) == ("auto_reject", "expected_document_not_used")
    assert decision(spark, documents=["doc_038"], messages=[read, m("tool", "nothing", answers="c1"), m("assistant", "about 77 pieces in total here")]) == ("manual_review", "unsupported_numeric_claim")
    assert decision(spark, messages=grounded) == ("manual_review", "kb_semantic_scope_uncertain")
    assert decision(spark, type="dwh", tables=["dim_a"]) == ("auto_reject", "expected_table_missing")
    query = [m("assistant", "", calls=[call("bash", {"command": "select from DIM_A"})]), m("tool", answer, answers="c1"), m("assistant", answer)]
    assert decision(spark, type="dwh", tables=["dim_a"], answer_type="numeric", gold="1200 95%", messages=query) == ("auto_pass", "recorded_query_evidence_matches_gold")
    assert decision(spark, type="dwh", tables=["dim_a"], messages=query) == ("manual_review", "execution_or_semantic_review_required")


def test_sets_histograms_duplicates(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "x", 3)], "g string, h string, n bigint")
    got = {(r["grouping"], r["g"], r["h"]): r["records"] for r in stats.counts_by(df, [["g"], ["g", "h"], []]).collect()}
    assert got[("all", None, None)] == 3 and got[("g", None, None)] == 1 and got[("g+h", "a", "y")] == 1
    assert tuple(stats.duplicate_groups(df, ["g"]).first()) == (1, 2)
    hist = {r["bucket"]: r for r in stats.histogram(df, F.col("h"), "n", F.col("n")).collect()}
    assert (hist["x"]["records"], hist["x"]["record_share"], hist["x"]["weight_share"]) == (2, 0.666667, 0.666667)
    dist = stats.distribution(df.withColumn("z", F.lit(None).cast("int")), ["n", "z"]).collect()
    assert {r["field"]: (r["records_nonzero"], r["total"], r["p50"]) for r in dist} == {"n": (3, 6.0, 2.0), "z": (0, 0.0, None)}


def talk(*messages):
    """Messages as the conversion takes them: (role, content, reasoning, call id, tool_calls)."""
    return [dict(zip(("role", "content", "reasoning_content", "tool_call_id", "tool_calls"), (*m, None, None, None)[:5])) for m in messages]


def one_call(function, id_="c"):
    return json.dumps([{"id": id_, "type": "function", "function": function}])


GOOD = {"name": "bash", "arguments": {"command": "ls"}}
ASKED, HEARD = ("assistant", "a", None, None, one_call(GOOD)), ("tool", "out", None, "c")
CONVERSIONS = [
    (talk(("user", "q"), ASKED, HEARD, ("assistant", "b")), None),
    (talk(("user", None)), convert.CONTENT),
    (talk(("critic", "x")), convert.ROLE),
    (talk(("assistant", "a", None, None, '{"id": "c", "function": {"name": "bash"}}')), convert.CALL_LIST),
    (talk(("assistant", "a", None, None, '"bash"')), convert.CALL_LIST),
    (talk(("assistant", "a", None, None, "5")), convert.CALL_LIST),
    (talk(("assistant", "a", None, None, "[{")), convert.CALL_LIST),
    (talk(("assistant", "a", None, None, '["bash"]')), convert.CALL_FUNCTION),
    (talk(("assistant", "a", None, None, one_call("bash"))), convert.CALL_FUNCTION),
    (talk(("assistant", "a", None, None, one_call(None))), convert.CALL_FUNCTION),
    (talk(("assistant", "a", None, None, '[{"id": "c"}]')), convert.CALL_FUNCTION),
    (talk(("assistant", "a", None, None, one_call({"name": 5, "arguments": {}}))), convert.CALL_NAME),
    (talk(("assistant", "a", None, None, one_call({"name": "", "arguments": {}}))), convert.CALL_NAME),
    (talk(("assistant", "a", None, None, one_call({"arguments": {}}))), convert.CALL_NAME),
    (talk(("assistant", "a", None, None, one_call({"name": "bash", "arguments": '{"command'}))), convert.ARGUMENTS_JSON),
    (talk(("assistant", "a", None, None, one_call({"name": "bash", "arguments": ""}))), convert.ARGUMENTS_JSON),
    (talk(("assistant", "a", None, None, one_call({"name": "bash", "arguments": '{"command": "ls"} and more'}))), convert.ARGUMENTS_JSON),
    (talk(("assistant", "a", None, None, one_call({"name": "bash", "arguments": "[1]"}))), convert.ARGUMENTS_OBJECT),
    (talk(("assistant", "a", None, None, one_call({"name": "bash", "arguments": None}))), convert.ARGUMENTS_OBJECT),
    (talk(("assistant", "a", None, None, one_call({"name": "bash", "arguments": 7}))), convert.ARGUMENTS_OBJECT),
    (talk(ASKED, HEARD, ASKED), convert.TWICE_CALLED),
    (talk(HEARD), convert.UNKNOWN),
    (talk(ASKED, ("tool", "out")), convert.UNKNOWN),
    (talk(("assistant", "a", None, None, one_call(GOOD, 5)), ("tool", "out", None, "5")), convert.UNKNOWN),
    (talk(ASKED, HEARD, HEARD), convert.TWICE_ANSWERED),
    (talk(ASKED), convert.UNANSWERED),
    (talk(("user", "q"), ("assistant", "  ")), convert.NOTHING),
    ([], convert.NOTHING),
    # nothing given, whatever its type; a call without arguments or with an id that is no string
    (talk(*(("assistant", "a", None, None, nothing) for nothing in (None, "null", "[]", "{}", '""', "0", "false", ""))), None),
    (talk(("assistant", "", None, None, one_call({"name": "bash"}, None))), None),
    # the first error in reading order counts
    (talk(("assistant", "a", None, None, one_call("x")), ("user", None)), convert.CALL_FUNCTION),
    (talk(ASKED, ("user", None)), convert.CONTENT),
]


def test_every_conversion_error(spark):
    kind = "id int, messages array<struct<role:string,content:string,reasoning_content:string,tool_call_id:string,tool_calls:string>>"
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(CONVERSIONS)], kind)
    got = {r["id"]: r["error"] for r in convert.convert(df).collect()}
    assert got == {i: e for i, (_, e) in enumerate(CONVERSIONS)}
    named = [convert.CONTENT, convert.ROLE, convert.CALL_LIST, convert.CALL_FUNCTION, convert.CALL_NAME, convert.ARGUMENTS_JSON, convert.ARGUMENTS_OBJECT, convert.TWICE_CALLED, convert.UNKNOWN, convert.TWICE_ANSWERED, convert.UNANSWERED, convert.NOTHING]
    assert set(named) == set(got.values()) - {None}


def test_reasoning_of_a_wrong_type(spark):
    from trajlake.sources import jsonl

    rows = [({"messages": [{"role": "assistant", "content": "a", "reasoning_content": r}]},) for r in ("why", None, "", 0, [], 5, ["x"], {"a": 1}, True)]
    df = spark.createDataFrame([("f", i, json.dumps(r[0])) for i, r in enumerate(rows)], "file string, line bigint, value string")
    got = {r["line"]: r["error"] for r in convert.convert(jsonl.conversations(jsonl.parsed(df))).collect()}
    assert got == {i: None if i < 5 else convert.CONTENT for i in range(9)}


def test_fingerprint_has_six_fields(spark):
    from trajlake.operators import review

    kind = "v string, type string, instruction string, gold_answer string, expected_tables array<string>, citation struct<doc_id:string>, source_documents array<string>, verification_criteria struct<must_query_tables:array<string>>"
    base = ("v", "kb", "i", '{"text": "x", "value": 1}', ["t"], ("d",), ["s"], (["q"],))
    other = [("w", *base[1:]), (*base[:3], '{"value":1,"text":"x"}', *base[4:]), (*base[:7], (["else"],))]
    unlike = [(*base[:i], x, *base[i + 1 :]) for i, x in ((1, "sql"), (2, "j"), (3, "x"), (4, ["t", "u"]), (5, (None,)), (6, None), (1, None))]
    got = [r[0] for r in spark.createDataFrame([base, *other, *unlike], kind).select(review.manifest_fingerprint()).collect()]
    assert len(set(got[:4])) == 1 and len(set(got)) == 1 + len(unlike)
    types = spark.createDataFrame([("kb", "sql"), (None, "kb"), ("", "kb"), ("unknown", "kb"), (None, None)], "a string, b string")
    assert [r[0] for r in types.select(review.task_type(types.a, types.b)).collect()] == ["kb", "kb", "kb", "kb", ""]


@pytest.mark.parametrize("one_task", [0, 10, 10**6])
def test_ranks_by_ranges_equal_ranks_in_one_task(spark, one_task):
    rng = random.Random(11)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, rng.random(), 0.5, rng.randint(-3, 3)]), rng.randint(0, 5)) for _ in range(700)] + [("c", None, None)]
    df = spark.createDataFrame([(g, None if x is None else float(x), y) for g, x, y in rows], "g string, x double, y bigint").repartition(5)
    ratios = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {r["g"]: r for r in stats.nearest_rank(df, ["g"], ["x", "y"], ratios, one_task).collect()}
    assert set(got) == {"a", "b", "c", None}
    for g, r in got.items():
        for i, name in ((1, "x"), (2, "y")):
            values = [row[i] for row in rows if row[0] == g and row[i] is not None]
            assert [r[f"{name}_p{round(q * 100):02d}"] for q in ratios] == [brute_rank(values, q) if values else None for q in ratios]
    whole = stats.nearest_rank(df, [], ["x"], [0.5], one_task).first()
    assert whole["x_p50"] == brute_rank([r[1] for r in rows if r[1] is not None], 0.5)
    assert stats.nearest_rank(df.filter("false"), ["g"], ["x"], [0.5], one_task).count() == 0


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_numbers_by_ranges(spark, one_task):
    rng = random.Random(12)
    rows = [(rng.choice(["v", "v", "v", "w", None]), rng.choice("abcdefgh"), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k string, i bigint").repartition(6)
    got = {r["i"]: r["ordinal"] for r in identity.numbered(df, "g", ["k", "i"], one_task).collect()}
    for g in ("v", "w", None):
        mine = sorted((k, i) for x, k, i in rows if x == g)
        assert [got[i] for _, i in mine] == list(range(1, len(mine) + 1))
    assert identity.numbered(df.filter("false"), "g", ["k"], one_task).count() == 0
