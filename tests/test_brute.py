"""Queries that SQL can't express, against plain Python over the smallest tables."""

import json
import os
import unicodedata

import pyarrow.parquet as pq
import pytest

from trajlake.functions import text
from trajlake.operators import convert
from trajlake.plans import registry
from trajlake.session import shared_dir, work_table

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def talks():
    rows = pq.read_table(f"{FOLDER}/trajectories.parquet", columns=["record_id", "messages"]).to_pylist()
    return {r["record_id"]: r["messages"] for r in rows}


def calls(messages):
    for i, m in enumerate(messages):
        for c in json.loads(m["tool_calls"] or "[]") if m["role"] == "assistant" else []:
            yield i, c.get("id"), (c.get("function") or {}).get("name"), (c.get("function") or {}).get("arguments")


def parsed(arguments):
    try:
        return json.loads(arguments) if isinstance(arguments, str) else arguments
    except ValueError:
        return ("text", arguments)


def query(spark, name):
    return registry.QUERIES[name](spark, FOLDER).collect()


@needs_tables
def test_signatures(spark, talks):
    def brute(messages):
        signs = [(n, json.dumps(parsed(a), sort_keys=True)) for _, _, n, a in calls(messages)]
        return len(signs), len(signs) - len(set(signs)), sum(a == b for a, b in zip(signs, signs[1:]))

    assert {r["record_id"]: tuple(r)[1:] for r in query(spark, "call_signatures")} == {k: brute(m) for k, m in talks.items()}


@needs_tables
def test_tool_statuses(spark, talks):
    known = {"bash": ({"command"}, {"timeout"}), "read": ({"path"}, {"offset", "limit"}), "write": ({"path", "content"}, set()), "edit": ({"path"}, {"edits", "oldText", "newText"})}

    def problem(name, arguments):
        a = parsed(arguments)
        if name not in known:
            return "noncanonical_tool_name"
        if not isinstance(a, dict):
            return "non_object_arguments"
        must, may = known[name]
        if must - set(a):
            return "missing_required_argument"
        if set(a) - must - may:
            return "noncanonical_argument_key"
        whole = lambda k, least: a.get(k) is None or (type(a[k]) is int and a[k] >= least)
        ok = all(isinstance(a[k], str) for k in must) and whole("timeout", 1) and whole("offset", 0) and whole("limit", 1)
        if name == "edit":
            pair = lambda e: isinstance(e, dict) and isinstance(e.get("oldText"), str) and isinstance(e.get("newText"), str)
            ok = ok and (pair(a) or (bool(a.get("edits")) and all(pair(e) and len(e) == 2 for e in a["edits"])))
        return None if ok else "invalid_argument_value"

    wanted = {}
    for m in talks.values():
        own = [problem(n, a) for _, _, n, a in calls(m)]
        status = next(filter(None, own), "canonical") if own else "no_tool_calls"
        wanted[status] = wanted.get(status, 0) + 1
    assert {r["status"]: r["records"] for r in query(spark, "canonical_tools")} == wanted


def first_error(messages):
    asked, answered, spoke = [], set(), False
    for i, m in enumerate(messages):
        if m["content"] is None:
            return convert.CONTENT
        if m["role"] == "assistant":
            spoke |= bool(m["content"].strip() or (m["reasoning_content"] or "").strip())
            for at, id_, name, arguments in calls(messages):
                if at != i:
                    continue
                if not name:
                    return convert.CALL_NAME
                value = parsed(arguments if arguments is not None else {})
                if isinstance(value, tuple):
                    return convert.ARGUMENTS_JSON
                if not isinstance(value, dict):
                    return convert.ARGUMENTS_OBJECT
                if id_ in asked and id_ is not None:
                    return convert.TWICE_CALLED
                asked.append(id_)
                spoke = True
        elif m["role"] == "tool":
            if m["tool_call_id"] is None or m["tool_call_id"] not in asked:
                return convert.UNKNOWN
            if m["tool_call_id"] in answered:
                return convert.TWICE_ANSWERED
            answered.add(m["tool_call_id"])
        elif m["role"] not in ("system", "user"):
            return convert.ROLE
    if set(asked) - answered - {None}:
        return convert.UNANSWERED
    return None if spoke else convert.NOTHING


@needs_tables
def test_conversions(spark, talks):
    rows = {r["record_id"]: r for r in query(spark, "converted_messages")}
    assert {k: r["error"] for k, r in rows.items()} == {k: first_error(m) for k, m in talks.items()}
    for k, r in rows.items():
        if r["error"] is None:
            said = sum(m["role"] == "assistant" and bool(m["content"].strip() or (m["reasoning_content"] or "").strip()) for m in talks[k])
            assert (r["tool_calls"], r["assistant_content_messages"]) == (len(list(calls(talks[k]))), said)


def answer(messages):
    said = [m["content"].strip() for m in messages if m["role"] == "assistant" and (m["content"] or "").strip()]
    return said[-1] if said else ""


@needs_tables
def test_evidence(spark, talks):
    for r in query(spark, "evidence_decisions"):
        heard = "\n".join(m["content"] or "" for m in talks[r["record_id"]] if m["role"] == "tool")
        known = "".join(c for c in unicodedata.normalize("NFKC", heard).lower() if c.isalnum())
        claims = [c for c in (text.folded(x) for x in text.CLAIM_END.split(text.ITEM_PREFIX.sub("", answer(talks[r["record_id"]])))) if len(c) >= 8]
        if r["reason"] in ("manifest_conflict", "manifest_missing"):
            assert r["support"] is None and r["status"] == "manual_review"
            continue
        if claims and all(c in known for c in claims):
            assert r["support"] == 1.0
        if not known:
            assert r["support"] == 0.0


def test_work_tables(spark):
    df = spark.range(5)
    table = work_table(df, "numbers")
    assert table.count() == 5
    conf = type("Conf", (), {"get": lambda self, key, default: "file:///shared/"})()
    assert shared_dir(type("Session", (), {"conf": conf})()) == "file:///shared"
    conf = type("Conf", (), {"get": lambda self, key, default: None})()
    cluster = type("Context", (), {"master": "spark://host:7077"})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(type("Session", (), {"conf": conf, "sparkContext": cluster})())
