"""Null columns, empty tables, ties, repeated rows and clashing names."""

import pytest
from pyspark.sql import functions as F

from trajlake.operators import audit, convert, identity, ingest, planning, stats
from tests.test_functions import MESSAGES, m


def test_empty_tables(spark):
    none = spark.createDataFrame([], MESSAGES)
    assert audit.audit(none).count() == convert.convert(none).count() == audit.role_profile(none).count() == audit.argument_keys(none).count() == 0
    rows = spark.createDataFrame([], "k string, v string, n bigint")
    assert ingest.last_wins(rows, ["k"], ["n"]).count() == ingest.conflicts(rows, ["k"], F.col("v")).count() == 0
    assert tuple(ingest.reconcile(rows, rows, ["k"]).first()) == (0, 0, 0)
    assert tuple(stats.duplicate_groups(rows, ["k"]).first()) == (0, 0)
    assert stats.histogram(rows, F.col("k"), "n", F.col("n")).count() == stats.counts_by(rows, [["k"], []]).count() == 0
    assert planning.diverse_k(rows, ["k"], "v", [F.col("n")], 2).count() == planning.best_of(rows, ["k"], [F.col("n")]).count() == 0


def test_null_messages_and_fields(spark):
    df = spark.createDataFrame([(1, None), (2, [(None, None, None, None, None)]), (3, [m("assistant", None, None, None, None)]), (None, [m("tool", None)])], MESSAGES)
    got = {r["id"]: r for r in audit.audit(df).collect()}
    assert got[2]["total_chars"] == got[3]["total_chars"] == 0 and got[None]["tool_response_messages"] == 1
    assert {r["id"]: r["error"] for r in convert.convert(df).collect()} == {1: convert.NOTHING, 2: convert.CONTENT, 3: convert.CONTENT, None: convert.CONTENT}


def test_long_texts_and_many_calls(spark):
    text = "错误 error " * 50_000
    df = spark.createDataFrame([(1, [m("tool", text), m("assistant", text, text)])], MESSAGES)
    r = audit.audit(df).first()
    assert r["tool_error_messages"] == 1 and r["total_chars"] == 3 * len(text) and r["tool_response_over_65536"] == 1


def test_repeated_rows_and_ties(spark):
    rows = spark.createDataFrame([("k", "a", 1)] * 5 + [("k", "b", 1)] * 2, "k string, v string, n bigint")
    assert ingest.last_wins(rows, ["k"], ["n", "v"]).first()["v"] == "b"
    assert planning.first_k(rows, ["k"], [F.col("n"), F.col("v")], 3).select("v").collect() == [("a",)] * 3
    assert [r["v"] for r in planning.diverse_k(rows, ["k"], "v", [F.col("n"), F.col("v")], 3).orderBy("v").collect()] == ["a", "a", "b"]
    assert ingest.ordinals(rows, ["k"], ["n", "v"]).agg(F.max("ordinal")).first()[0] == 7


def test_extra_columns_stay(spark):
    df = spark.createDataFrame([(1, [m("user", "q"), m("assistant", "a")], "x", 7)], MESSAGES + ", line string, text int")
    assert {"line", "text"} <= set(audit.audit(df).columns) & set(convert.convert(df).columns)
    index = identity.manifest_index(spark.createDataFrame([("v", "t", "q", None, 1)], "v string, task_id string, i string, o string, n int"), F.col("i"), F.col("o"), ["n"])
    rows = spark.createDataFrame([("v", None, 1, "q", 5)], "version string, source string, line int, text string, ordinal int")
    assert identity.resolve(rows, index).first().asDict() == {"version": "v", "source": None, "line": 1, "text": "q", "ordinal": 5, "task": "t", "method": "position"}


def test_hot_group_percentiles(spark):
    df = spark.range(30_000).select(F.lit("hot").alias("g"), (F.col("id") % 100).alias("x"))
    values = sorted(i % 100 for i in range(30_000))
    got = stats.nearest_rank(df, ["g"], ["x"], [0.5, 0.95]).first()
    assert (got["x_p50"], got["x_p95"]) == (values[round(29_999 * 0.5)], values[round(29_999 * 0.95)])


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        planning.nearest(spark.createDataFrame([], "input_tokens bigint, supervised_ratio double, quality_tier string, supervised_tokens bigint, source_file string, source_line bigint"), [])
