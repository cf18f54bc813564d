import json
import random
import unicodedata

import numpy as np
import pytest

from trajlake.llm import repeats, trees
from trajlake.llm.units import grams, letter_units, repeated_units, repeated_windows


def is_ideograph(c):
    return any(lo <= c <= hi for lo, hi in ("぀ヿ", "㐀䶿", "一鿿", "豈﫿", "々〆", "\U00020000\U0003ffff"))


def brute_share(text):
    """By the definition: letters only; words, or in Chinese and Japanese (half of the letters) characters."""
    kept = "".join(c if c.isalpha() else " " for c in unicodedata.normalize("NFKC", text or "").lower())
    letters = kept.replace(" ", "")
    if letters and 2 * sum(map(is_ideograph, letters)) >= len(letters):
        units, run = list(letters), 16
    else:
        units, run = "".join(f" {c} " if is_ideograph(c) else c for c in kept).split(), 8
    seen, hit = set(), set()
    for i in range(len(units) - run + 1):
        k = tuple(units[i : i + run])
        if k in seen:
            hit |= set(range(i, i + run))
        seen.add(k)
    return len(hit), len(units)


def texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    out = ["", None, "a", "same word " * 4, "x " * 100, "1 2 3 4 5 6 7 8 9 " * 20, "中文" * 3, "这是一个很长的句子没有标点符号重复两次吧" * 2]
    # a sentence of fewer than 16 ideographs and words, but of more letters; few ideographs among Latin words; punctuation in kana
    out += ["分诊不累加吊车，除非order_id等于355。其他内容甲乙丙丁。分诊不累加吊车，除非order_id等于718。" * 2, "select a from b where 期间 = c and 范围 = d or e;\n" * 3, "カ・タ・カ・ナ・の・文" * 3, "ｗｉｄｅ　ｗｏｒｄｓ one " * 9]
    for i in range(120):
        words = [word() for _ in range(rng.randint(5, 120))]
        part = words[: rng.randint(1, len(words))]
        for _ in range(i % 4):
            words += [word() for _ in range(3)] + part
        out.append(" ".join(w.upper() if rng.random() < 0.3 else w + rng.choice(["", ",", " 12 "]) for w in words))
    return out


def test_document_shares_match_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["item_id"]: (r["repeated"], r["size"]) for r in repeats.shares(df, repeats.DOCUMENTS).collect()}
    assert got == {i: brute_share(t) for i, t in rows}
    found = {r["item_id"] for r in repeats.found(df, repeats.DOCUMENTS).collect()}
    assert found == {i for i, t in rows for a, n in [brute_share(t)] if n and a / n >= 0.3}
    assert found


def test_blocks_of_lists():
    import pyarrow as pa

    rows = [["x" * 3_000_000, None], None, [], ["y" * 3_000_000], ["z" * 9_000_000, "q"], ["r"], [None]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(rows, pa.list_(pa.string()))], ["id", "calls"])
    for given in (batch, batch.slice(1), batch.slice(3, 2)):
        parts = list(repeats._blocks(given))
        assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([given]))
    assert [p.num_rows for p in repeats._blocks(batch)] == [3, 1, 1, 2]
    assert list(repeats._blocks(batch.slice(0, 0))) == []


def test_units():
    units, letters = letter_units("Ａb c1d 中文_x")
    assert len(units) == 6 and not letters
    assert len(letter_units("STRASSE ")[0]) == 1 and letter_units("中文ab")[1] and not letter_units("中文abc")[1]
    assert len(grams(np.arange(5), 8)) == 0
    rows = [np.array(x, np.int64) for x in ([1, 2, 3, 1, 2, 9, 1, 2], [], [1, 2], [5, 5, 5, 5], [1])]
    assert repeated_units(rows, 2).tolist() == [4, 0, 0, 3, 0] and repeated_windows(rows, 2).tolist() == [2, 0, 0, 2, 0]
    assert repeated_units([], 2).tolist() == [] and repeated_windows(rows[1:2], 2).tolist() == [0]


def test_bound_holds():
    rng = np.random.default_rng(3)
    for n in range(0, 300, 3):
        units = rng.integers(0, rng.integers(1, 60), n)
        units = np.concatenate([units, units[: n // 2], rng.integers(0, 9, n // 4), units[n // 3 :]])
        items = [(units, bool(n % 2))]
        (x,), (most,) = repeats.doc_features(items)
        assert most >= repeats.doc_share(items)[0, 0] and len(x) == len(repeats.DOC_MONOTONE)


def test_bad_trees_lose_nothing(spark):
    """A gate whose trees score everything low still gives every case, by the bound."""
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    nothing = trees.fit(np.empty((0, 3)), np.empty(0), repeats.DOC_MONOTONE)
    got = df.mapInArrow(repeats._scored(repeats.DOCUMENTS, nothing, 1.0), repeats.SCORED).collect()
    assert {r["item_id"] for r in got if repeats.DOCUMENTS.reached(r["repeated"], r["size"])} == {i for i, t in rows for a, n in [brute_share(t)] if n and a / n >= 0.3}


def test_blocks_cut_long_texts():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(["x" * 3_000_000, None, "y" * 3_000_000, "z" * 9_000_000, ""])], ["id", "text"])
    parts = list(repeats._blocks(batch))
    assert [p.num_rows for p in parts] == [2, 1, 1, 1] and pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))


def call(name, arguments):
    return {"id": "c", "type": "function", "function": {"name": name, "arguments": arguments}}


def test_call_shares(spark):
    a, b = {"path": "x", "n": 1}, {"n": 1.0, "path": "x"}
    groups = [
        [json.dumps([call("read", a), call("read", b)]), None, json.dumps([call("read", json.dumps(b)), call("read", json.dumps(a, indent=2))])],  # 3 of 4
        [json.dumps([call("read", "{bad"), call("read", "{bad"), call("write", "{bad"), call("read", {"q": 1})])],  # 1 of 4
        [json.dumps([call("read", a), call("read", a)])],  # too few
        ["not json", '{"x": 1}', "[1, null]"],
        [json.dumps([call("bash", None), call("bash", {}), call("bash", None), call("bash", {})])],  # 2 of 4
        [json.dumps([call("r", {"t": "中"}), call("r", '{"t": "\\u4e2d"}'), call("r", {"t": "x"}), call("r", {"t": "X"}), call("r", {"t": True})])],
        None,
        [],
    ]
    rows = [(i, None if g is None else g) for i, g in enumerate(groups)] + [(0, groups[0])]
    df = spark.createDataFrame(rows, "record_id bigint, calls array<string>")
    got = {r["item_id"]: (r["repeated"], r["size"]) for r in repeats.shares(df, repeats.TRAJECTORIES).collect()}
    assert got == {0: (3, 4), 1: (1, 4), 2: (1, 2), 3: (0, 4), 4: (2, 4), 5: (1, 5), 6: (0, 0), 7: (0, 0)}
    assert {r["item_id"] for r in repeats.found(df, repeats.TRAJECTORIES).collect()} == {0, 4}
    assert repeats.found(df.filter("false"), repeats.TRAJECTORIES).count() == 0


def test_sample_is_bounded_and_misses_nothing(spark):
    rows = list(enumerate(texts() * 12))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    forest, cutoff = repeats.fit(df, repeats.DOCUMENTS, sample=300)
    assert 0 < cutoff <= repeats.DOC_SHARE / 2
    found = {r["item_id"] for r in repeats.found(df, repeats.DOCUMENTS, sample=300).collect()}
    assert found == {i for i, t in rows for a, n in [brute_share(t)] if n and a / n >= 0.3}
    assert repeats.candidates(df, repeats.DOCUMENTS, 300).count() < len(rows)


@pytest.mark.parametrize("seed", range(3))
def test_trees_fit_and_are_monotone(seed):
    rng = np.random.default_rng(seed)
    x = rng.random((2000, 3))
    y = np.sin(6 * x[:, 0]) + 2 * x[:, 1] - x[:, 2] + 0.1 * rng.standard_normal(2000)
    forest = trees.fit(x[:1500], y[:1500], [0, 1, -1])
    rest = y[1500:] - forest.score(x[1500:])
    assert (rest**2).mean() < 0.08 * y.var()
    for j, sign in ((1, 1), (2, -1)):
        at = np.repeat(rng.random((200, 1, 3)), 50, axis=1)
        at[:, :, j] = np.linspace(0, 1, 50)
        score = forest.score(at.reshape(-1, 3)).reshape(200, 50)
        assert (np.diff(score, axis=1) * sign >= -1e-12).all()


def test_trees_of_nothing():
    assert trees.fit(np.empty((0, 2)), np.empty(0), [0, 0]).score(np.ones((3, 2))).tolist() == [0.0] * 3
    flat = trees.fit(np.ones((50, 2)), np.full(50, 2.0), [0, 1])
    assert np.allclose(flat.score(np.array([[1.0, 1.0], [np.nan, 5.0]])), 2.0)
