import hashlib
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from trajlake.functions import calls as C
from trajlake.functions import keys, labels, text

MESSAGE = "role string, content string, reasoning_content string, tool_call_id string, tool_calls string"
MESSAGES = f"id int, messages array<struct<{', '.join(x.replace(' ', ':') for x in MESSAGE.split(', '))}>>"


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first()["y"]


def call(name, arguments, id_="c1"):
    return {"id": id_, "type": "function", "function": {"name": name, "arguments": arguments}}


def m(role, content="", reasoning=None, answers=None, calls=None):
    return (role, content, reasoning, answers, None if calls is None else json.dumps(calls, ensure_ascii=False))


def test_task_keys(spark):
    same = ["task_0000007", "TASK_0000007", "task-0000007", "Task 7", " task_0000007", "task_0000007\t", "task0000007", "task_０００００07", "task_000000007", "task_0000007@v12"]
    assert {one(spark, keys.task_key, x) for x in same} == {"task_7"}
    assert one(spark, keys.task_key, "Task 7B") == one(spark, keys.task_key, "task_0000007b") == "task_7b"
    assert one(spark, keys.task_key, "task_0000070") == "task_70"
    assert one(spark, keys.task_key, "task_000") == "task_0"
    assert one(spark, keys.task_key, " Odd name ") == "odd name"
    assert one(spark, keys.task_key, None) is None


def test_other_keys(spark):
    rows = [("QUESSEL_V3 ", "x", "quessel-v3"), (None, "vorlan14b_20260527_v11_openai.jsonl", "vorlan-14b"), ("unknown", "ondrei61_1.jsonl", "ondrei-6.1"), (None, None, "unknown")]
    got = spark.createDataFrame(rows, "f string, s string, y string").select(keys.family_key(F.col("f"), F.col("s")).alias("g"), "y").collect()
    assert all(r["g"] == r["y"] for r in got)
    assert [one(spark, keys.split_key, x) for x in ("Train", "training", "VALIDATION ", "dev", " test", "testing", "other", None)] == ["train", "train", "validation", "validation", "test", "test", None, None]
    assert {one(spark, keys.tier_key, x) for x in ("kb_rule_only", "KB_RULE_ONLY", "kb rule only", "kb_rule_only ", "kb-rule-only")} == {"kb_rule_only"}
    assert [one(spark, keys.lang_key, x) for x in ("en-US", "eng", "ZH", "cn", "jp", None, "", "xx")] == ["en", "en", "zh", "zh", "ja", "und", "und", "und"]
    assert [one(spark, keys.source_key, x) for x in ("SANDBOX-0007", "sandbox_0007 ", None, " ")] == ["sandbox_0007", "sandbox_0007", "unknown", "unknown"]


def test_buckets(spark):
    wanted = {0: "1-2048", 2048: "1-2048", 2049: "2049-4096", 262144: "131073-262144", 262145: ">262144"}
    assert {k: one(spark, labels.token_bucket, k, "bigint") for k in wanted} == wanted
    assert one(spark, labels.token_bucket, None, "bigint") is None
    wanted = {0.0: "0%-<5%", 0.05: "5%-<10%", 0.1: "10%-<20%", 0.2: "20%-<40%", 0.4: ">=40%"}
    assert {k: one(spark, labels.ratio_bucket, k, "double") for k in wanted} == wanted


def test_phases(spark):
    got = [one(spark, labels.phase, x, "bigint") for x in (0, 1, 8192, 8193, 16384, 16385, 32768, 32769, None)]
    assert got == [None, "core_8k", "core_8k", "extension_16k", "extension_16k", "long_32k_review", "long_32k_review", None, None]
    assert one(spark, lambda c: labels.phase(c, 24576), 20000, "bigint") == "extension_24k"
    with pytest.raises(ValueError):
        labels.phases(8192)


def test_tiers_and_groups(spark):
    rows = [(True, True, "kb", labels.TIERS[0]), (None, True, "kb", labels.TIERS[2]), (False, None, "kb", labels.TIERS[3]), (None, None, None, labels.TIERS[1])]
    got = spark.createDataFrame(rows, "a boolean, b boolean, t string, y string").select(labels.evidence_tier(F.col("a"), F.col("b"), F.col("t")).alias("g"), "y").collect()
    assert all(r["g"] == r["y"] for r in got)
    rows = [("long_32k_review", "train", "x", "long_32k_review"), ("core_8k", "test", "x", "heldout"), ("core_8k", None, "x", "heldout"), ("core_8k", "train", "sql_result_verified", "train_strong_verified"), ("extension_16k", "train", None, "train_review")]
    got = spark.createDataFrame(rows, "p string, s string, t string, y string").select(labels.output_group(F.col("p"), F.col("s"), F.col("t")).alias("g"), "y").collect()
    assert all(r["g"] == r["y"] for r in got)
    with pytest.raises(Exception, match="unknown phase"):
        spark.createDataFrame([("odd", "train", "x")], "p string, s string, t string").select(labels.output_group(F.col("p"), F.col("s"), F.col("t"))).collect()


def test_stable_split(spark):
    tasks = [f"task_{i}" for i in range(500)]

    def brute(t):
        share = int.from_bytes(hashlib.sha256(t.encode()).digest()[:8], "big") / 2**64
        return "train" if share < 0.85 else "validation" if share < 0.925 else "test"

    got = spark.createDataFrame([(t,) for t in tasks], "t string").select("t", labels.stable_split(F.col("t")).alias("s")).collect()
    assert {r["t"]: r["s"] for r in got} == {t: brute(t) for t in tasks}


def test_shortened_and_reasons(spark):
    assert one(spark, lambda c: labels.shortened(c, 3), "ab\0cde") == "abc…"
    assert one(spark, lambda c: labels.shortened(c, 3), "ab\0c") == "abc"
    assert one(spark, lambda c: labels.any_of([(c > 1, "big"), (c.isNull(), "null"), (c > 5, "huge")]), 7, "int") == ["big", "huge"]
    assert one(spark, lambda c: labels.any_of([(c > 1, "big"), (c.isNull(), "null")]), None, "int") == ["null"]
    assert one(spark, lambda c: labels.first_of([(c > 0, "a"), (c > 5, "b")], "ok"), 3, "int") == "b"
    assert one(spark, lambda c: labels.first_of([(c > 0, "a"), (c > 5, "b")], "ok"), None, "int") == "a"


def test_variant_types(spark):
    wanted = {"null": "null", "true": "boolean", "1": "integer", "1.5": "number", '"x"': "string", "[1]": "list", '{"a":1}': "object", "broken": "missing"}
    assert {k: one(spark, lambda c: labels.variant_type(F.try_parse_json(c)), k) for k in wanted} == wanted


def test_call_reading(spark):
    a = {"command": "ls", "timeout": 5}
    rows = [(1, [m("user", "q"), m("assistant", "x", calls=[call("bash", a), call("bash", json.dumps({"timeout": 5, "command": "ls"}, indent=1), "c2"), call("read", "{broken", "c3"), call("read", "{broken", "c4")])]), (2, None), (3, []), (4, [(None, None, None, None, None)])]
    df = spark.createDataFrame(rows, MESSAGES).withColumn("calls", C.tool_calls(F.col("messages")))
    got = {r["id"]: r for r in df.select("id", F.size("calls").alias("n"), C.repeats(C.signatures(F.col("calls"))).alias("d"), C.adjacent_repeats(C.signatures(F.col("calls"))).alias("c")).collect()}
    assert (got[1]["n"], got[1]["d"], got[1]["c"]) == (4, 2, 2)
    assert (got[3]["n"], got[3]["d"], got[4]["n"]) == (0, 0, 0)


@pytest.mark.parametrize(
    "name, arguments, problem",
    [
        ("bash", {"command": "ls", "timeout": 10}, None),
        ("bash", {"command": "ls", "timeout": 0}, "invalid_argument_value"),
        ("bash", {"command": "ls", "timeout": None}, None),
        ("bash", {"command": "ls", "timeout": True}, "invalid_argument_value"),
        ("bash", {"command": "ls", "timeout": "5"}, "invalid_argument_value"),
        ("bash", {"command": 3}, "invalid_argument_value"),
        ("bash", {"timeout": 3}, "missing_required_argument"),
        ("bash", {"command": "ls", "cwd": "/"}, "noncanonical_argument_key"),
        ("bash", ["ls"], "non_object_arguments"),
        ("python", {"code": "1"}, "noncanonical_tool_name"),
        (None, {}, "noncanonical_tool_name"),
        ("read", {"path": "a", "offset": 0, "limit": 1}, None),
        ("read", {"path": "a", "offset": -1}, "invalid_argument_value"),
        ("read", {"path": "a", "limit": 0}, "invalid_argument_value"),
        ("write", {"path": "a", "content": "b"}, None),
        ("write", {"path": "a"}, "missing_required_argument"),
        ("edit", {"path": "a", "oldText": "x", "newText": "y"}, None),
        ("edit", {"path": "a", "edits": [{"oldText": "x", "newText": "y"}]}, None),
        ("edit", {"path": "a", "edits": []}, "invalid_argument_value"),
        ("edit", {"path": "a", "edits": [{"oldText": "x", "newText": "y", "z": 1}]}, "invalid_argument_value"),
        ("edit", {"path": "a"}, "invalid_argument_value"),
    ],
)
def test_canonical_calls(spark, name, arguments, problem):
    df = spark.createDataFrame([(name, json.dumps(arguments))], "n string, a string")
    assert df.select(C.call_problem(F.col("n"), F.col("a")).alias("p")).first()["p"] == problem


def test_folded_text_and_numbers():
    assert text.folded(" Ａbc，１２ 中文。_") == "abc12中文"
    assert text.numbers_in("共 1,200 件，95%，n_0，+3.50") == {"1200", "95%", "3.5"}
    assert text.numbers_in("3.5 tons\n2) x") == {"5"}
    assert text.numbers_in(None) == set()
    assert text.coverage("", "x") == 0.0 and text.coverage("ab", "xaby") == 1.0
    assert text.support("短。这是一个很长的说法", "这是一个很长的说法") == 1.0
    # by the definition: sets of bigrams
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(2))
        grams = lambda t: {t[i : i + 2] for i in range(max(1, len(t) - 1))}
        assert text.coverage(a, b) == (0.0 if not a or not b else 1.0 if a in b else round(len(grams(a) & grams(b)) / len(grams(a)), 6))


def test_bigram_coverage_matches_python(spark):
    rng = random.Random(3)
    rows = [("".join(rng.choice("abc 中文，1") for _ in range(rng.randint(0, 12))), "".join(rng.choice("abc 中文，1") for _ in range(rng.randint(0, 30)))) for _ in range(200)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", text.bigram_coverage(F.col("a"), F.col("b")).alias("c")).collect()
    for r in got:
        fold = lambda s: "".join(ch for ch in unicodedata.normalize("NFKC", s).lower() if ch.isalnum())
        assert abs(r["c"] - text.coverage(fold(r["a"]), fold(r["b"]))) < 1e-9


def test_udfs_take_nulls(spark):
    df = spark.createDataFrame([(None,), ("ｘ 1,000 ",)], "t string")
    assert [tuple(r) for r in df.select(text.nfkc(F.col("t")), text.numbers(F.col("t"))).collect()] == [(None, []), ("x 1,000", ["1000"])]


def test_numbers_by_example():
    """Fixed by the rules: item numbers and identifiers are no numbers, separators and plus signs fall away."""
    cases = {
        "1. first 2 items\n2) second": ["2"],
        "doc_038 and a12 x-3": ["2", "3", "38"],
        "时限为48小时，+5% 和 1,234.50": ["1234.5", "48", "5%"],
        "１２ and -0.50": ["-0.5", "12"],
        "no number": [],
        "1,2345 7e3": ["1234", "5", "7"],
        "12345678901234567": ["1.23456789012e+16"],
    }
    for given, wanted in cases.items():
        assert sorted(text.numbers_in(given)) == sorted(wanted), given
    assert text.numbers_in(None) == set()
