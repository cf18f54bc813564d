import random

import numpy as np
import pytest

from trajlake.llm import pack


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_constraints_hold_and_waste_is_small(rule):
    rng = np.random.default_rng(1)
    sizes = np.minimum(1000, rng.lognormal(4.5, 1.0, 3000).astype(np.int64))
    bins = pack.best_fit(sizes, 1000, 20, 4e5 + 6e5, rule)
    load = np.bincount(bins, sizes)
    assert load.max() <= 1000 and np.bincount(bins).max() <= 20
    assert np.bincount(bins, sizes.astype(float) ** 2).max() <= 1e6 * (1 + 1e-9)
    assert (bins >= 0).all()
    loose = pack.best_fit(sizes, 1000, 10_000, 1e9, rule)
    assert len(np.unique(loose)) <= np.ceil(sizes.sum() / 1000) * 1.02 + 1


def test_attention_binds():
    sizes = np.array([50] * 20)
    assert len(np.unique(pack.best_fit(sizes, 1000, 100, 1e4))) == 5  # 4 x 2500 within 1e4
    assert pack.best_fit(np.empty(0, np.int64), 10, 1, 1.0).size == 0
    assert len(np.unique(pack.best_fit(np.zeros(10, np.int64), 10, 4, 100.0))) == 3


def test_table(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 1, 5, 50, 100, 101, 250, 300])) for i in range(500)] + [(1000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint")
    got = pack.pack(df, 100, shard_items=100).collect()
    by_doc, by_bin = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append((r["part"], r["size"]))
        by_bin.setdefault(r["container_id"], []).append(r["size"])
    assert {i: sum(s for _, s in p) for i, p in by_doc.items()} == {i: n or 0 for i, n in rows}
    assert max(map(sum, by_bin.values())) <= 100
    assert {i for i, p in by_doc.items() if len(p) > 1} == {i for i, n in rows if n and n > 100} == {r["doc_id"] for r in pack.divided(pack.pack(df, 100)).collect()}
    assert all(sorted(p)[:-1] == [(k, 100) for k in range(len(p) - 1)] for p in by_doc.values())
    report = pack.fill_report(pack.pack(df, 100), 100).first()
    assert report["tokens"] == sum(n or 0 for _, n in rows) and report["fullest"] == 100 and report["used_share"] > 0.95


def test_empty_and_bad_arguments(spark):
    empty = spark.createDataFrame([], "doc_id bigint, n_tokens bigint")
    assert pack.pack(empty, 100).count() == 0
    assert pack.fill_report(pack.pack(empty, 100), 100).first()["containers"] == 0
    for wrong in ({"attention": 0.0}, {"attention": -1.0}, {"max_docs": 0}):
        with pytest.raises(ValueError):
            pack.pack(empty, 100, **wrong)
    assert pack.violated(pack.pack(empty, 100), 100).count() == 0


@pytest.mark.parametrize("attention, most", [(None, 512), (5_000.0, 512), (2_500.0, 3), (1.0, 2), (1e9, 4)])
def test_repeated_and_null_keys_under_every_constraint(spark, attention, most):
    rng = random.Random(7)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([0, 1, 10, 49, 51, 70, 100, 200, 250, 1000])) for _ in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint").repartition(3)
    done = pack.pack(df, 100, max_docs=most, attention=attention, shard_items=100)
    assert pack.violated(done, 100, most, attention).count() == 0
    got = done.collect()
    assert sum(r["size"] for r in got) == sum(n for _, n in rows)
    for k in (None, 1, 2, 3):
        wanted = sorted(s for i, n in rows if i == k for s in ([100] * ((n - 1) // 100) + [n - 100 * max(0, (n - 1) // 100)]))
        assert sorted(r["size"] for r in got if r["doc_id"] == k) == wanted
    load = {}
    for r in got:
        load.setdefault(r["container_id"], []).append(r["size"])
    cost = attention or pack.ATTENTION * 1e4
    assert max(map(sum, load.values())) <= 100 and max(map(len, load.values())) <= most
    assert all(sum(s * s for s in b) <= cost or len(b) == 1 for b in load.values())
    if cost <= 5_000:
        # 70 x 70 leaves no room for 49, nor does 51 for another 51
        assert any(sum(b) < 100 and len(b) > 1 and sum(s * s for s in b) > 0.9 * cost for b in load.values()) or cost == 1.0
    bad = spark.createDataFrame([(5, 0, 60, 7), (6, 0, 60, 7), (7, 0, 1, 8)], "doc_id bigint, part int, size bigint, container_id bigint")
    assert [r["container_id"] for r in pack.violated(bad, 100).collect()] == [7]
