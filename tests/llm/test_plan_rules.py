import random

import pytest
from pyspark.sql import functions as F

from trajlake.llm import cap, plan_table, regroup


def test_order_cap_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("abc") if rng.random() < 0.9 else None, rng.choice([0, 1, 2, None])) for i in rng.sample(range(10_000), 300)]
    df = spark.createDataFrame(rows, "id bigint, who string, tier int")
    kept = {r["id"] for r in cap.keep_per_contributor(df, ["who"], 3, "id", F.col("tier"), cap.sure_order(F.col("id"))).collect()}
    wanted = set()
    for w in ("a", "b", "c", None):
        wanted |= {r[0] for r in sorted((r for r in rows if r[1] == w), key=lambda r: (r[2] is None, r[2] or 0, r[0]))[:3]}
    assert kept == wanted
    gone = cap.given_up(df, cap.keep_per_contributor(df, ["who"], 3, "id", F.col("tier"), cap.sure_order(F.col("id"))), "id")
    assert {r["id"] for r in gone.collect()} == {r[0] for r in rows} - wanted


def test_hot_contributor_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("who"))
    plan = cap.keep_per_contributor(df, ["who"], 3, "id", F.lit(0), cap.sure_order(F.col("id")))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_weighted_draw_follows_the_scores(spark):
    df = spark.range(30_000).select("id", F.pmod("id", F.lit(3000)).alias("who"), F.when(F.pmod(F.floor(F.col("id") / 3000), F.lit(2)) == 0, 3.0).otherwise(1.0).alias("score"))
    kept = cap.keep_per_contributor(df, ["who"], 1, "id", F.lit(0), cap.log_of(F.col("score")))
    assert kept.count() == 3000
    heavy = kept.join(df.select("id", "score"), "id").filter("score = 3").count()
    assert abs(heavy / 3000 - 0.75) < 0.04
    assert kept.collect() == cap.keep_per_contributor(df, ["who"], 1, "id", F.lit(0), cap.log_of(F.col("score"))).collect()


def test_sure_order_holds_for_any_draw(spark):
    ids = [0, 1, 2, 3, -5, 10**6, 10**6 + 1, 10**12, 10**12 + 1, 2**62, 2**62 + 1, -(2**62)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").withColumn("w", F.lit(1))
    for seed in range(20):
        for n in (1, 4, 9):
            assert {r["id"] for r in cap.keep_per_contributor(df, ["w"], n, "id", F.lit(0), cap.sure_order(F.col("id")), seed).collect()} == set(sorted(ids)[:n])
    span = spark.range(200_000).select((-F.log(-F.log(cap.uniform(3, "id")))).alias("x")).agg(F.max("x") - F.min("x")).first()[0]
    assert span < cap.SURE


def test_weights_of_several_kept(spark):
    """Of ten records with scores 1 to 10 three stay: shares as in drawing one after the other, by simulation."""
    import numpy as np

    df = spark.range(60_000).select("id", F.floor(F.col("id") / 10).alias("who"), (F.pmod("id", F.lit(10)) + 1).cast("double").alias("score"))
    kept = cap.keep_per_contributor(df, ["who"], 3, "id", F.lit(0), cap.log_of(F.col("score"))).select((F.pmod("id", F.lit(10))).alias("k")).groupBy("k").count().collect()
    got = np.zeros(10)
    for r in kept:
        got[r["k"]] = r["count"] / 6_000
    rng, wanted = np.random.default_rng(1), np.zeros(10)
    p = np.arange(1, 11) / 55
    for _ in range(20_000):
        wanted[rng.choice(10, 3, replace=False, p=p)] += 1 / 20_000
    assert np.abs(got - wanted).max() < 0.03


def test_bad_scores_come_last(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 0.0), (4, -1.0), (5, 0.1)], "id bigint, s double")
    assert [r["id"] for r in cap.keep_per_contributor(df.withColumn("w", F.lit(1)), ["w"], 1, "id", F.lit(0), cap.log_of(F.col("s"))).collect()] == [5]
    assert cap.keep_per_contributor(df.filter("false").withColumn("w", F.lit(1)), ["w"], 1, "id", F.lit(0)).count() == 0
    assert cap.share_cap(df, 0.4) == 2 and cap.share_cap(df, 0.0) == 1
    with pytest.raises(ValueError):
        cap.keep_per_contributor(df, ["id"], -1, "id", F.lit(0))


def test_planned_rows(spark):
    columns = "record_id bigint, task_id string, source_family string, source_file string, split string, quality_tier string, type string"
    rows = [(1, "Task 7", None, "quessel_1.jsonl", "Train", "KB rule only", "KB"), (1, "Task 7", None, "quessel_1.jsonl", "Train", "KB rule only", "KB"), (None, "x", None, None, None, None, None), (2, None, None, None, None, None, None)]
    got = {r["record_id"]: tuple(r)[1:] for r in plan_table.planned(spark.createDataFrame(rows, columns)).collect()}
    assert got == {1: ("task_7", "quessel-v3", "train", "kb_rule_only", "kb"), 2: (None, "unknown", None, None, "unknown")}


def brute_components(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r, e in edges:
        find(("r", r))
        if e is not None:
            parent[find(("r", r))] = find(("e", e))
    groups = {}
    for r, _ in edges:
        groups.setdefault(find(("r", r)), []).append(r)
    return {r: min(g) for g in groups.values() for r in g}


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 150), rng.choice([None, *map(str, range(120))])) for _ in range(220)] + [(1000 + i, f"chain{i // 2}") for i in range(30)] + [(1000 + i, f"chain{(i + 1) // 2}") for i in range(30)]
    got = {r["r"]: r["component"] for r in regroup.components(spark.createDataFrame(edges, "r bigint, e string"), "r", "e").collect()}
    assert got == brute_components(edges)
    assert regroup.components(spark.createDataFrame([], "r bigint, e string"), "r", "e").count() == 0


def test_conflicts_and_new_splits(spark):
    rng = random.Random(6)
    rows = [(i, f"t{min(int(rng.expovariate(0.02)), 400)}" if i % 3 else "hot", rng.choice("xy"), rng.choice(["train", "test", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, task string, kind string, split string")
    parts = regroup.components(df, "id", "task")
    seen = {}
    for _, t, _, s in rows:
        seen.setdefault(t, set()).add(s)
    wanted = {i for i, t, _, s in rows if s and len(seen[t] - {None}) > 1}
    assert {r["id"] for r in regroup.conflicting(df, parts, "id", "split").collect()} == wanted
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    new = {r["id"]: r["new_split"] for r in regroup.new_splits(df, parts, shares, "id", F.col("kind")).collect()}
    assert set(new) == {r[0] for r in rows}
    assert all(len({new[r[0]] for r in rows if r[1] == t}) == 1 for t in seen)
    for kind in "xy":
        of = [new[r[0]] for r in rows if r[2] == kind]
        assert all(abs(of.count(s) / len(of) - p) < 0.03 for s, p in shares.items())
    with pytest.raises(ValueError):
        regroup.assign(df.select(F.col("id").alias("component"), F.col("kind").alias("stratum"), F.lit(1).alias("n")), {})
    assert regroup.new_splits(df.filter("false"), parts.filter("false"), shares, "id", F.col("kind")).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_joins_equal_plain_ones(spark, how):
    from trajlake.llm.lookup import join_hot

    rng = random.Random(8)
    rows = spark.createDataFrame([(rng.choice([None, 1, 1, 1, 2, *range(3, 2000)]) if i % 3 else 1, i) for i in range(4000)], "k bigint, i bigint")
    table = spark.createDataFrame([(k, k * 10) for k in range(0, 2000, 2)] + [(1, 10), (None, 5)], "k bigint, v bigint")
    plain = sorted(map(tuple, rows.join(table, "k", how).collect()), key=repr)
    assert sorted(map(tuple, join_hot(rows, table, "k", how, plain=0).collect()), key=repr) == plain
    assert join_hot(rows.filter("false"), table, "k", how, plain=-1).count() == 0


def test_components_with_hot_entities(spark, monkeypatch):
    from trajlake.llm import lookup

    monkeypatch.setattr(lookup, "PLAIN", 0)
    monkeypatch.setattr(lookup.join_hot, "__defaults__", ("inner", 0))
    rng = random.Random(9)
    edges = [(i, "hot" if i % 3 == 0 else f"e{rng.randint(0, 400)}") for i in range(900)]
    got = {r["r"]: r["component"] for r in regroup.components(spark.createDataFrame(edges, "r bigint, e string"), "r", "e").collect()}
    assert got == brute_components(edges)
