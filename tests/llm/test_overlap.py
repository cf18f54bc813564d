import math
import random

import numpy as np
import pytest

from trajlake.llm import lookup, overlap
from trajlake.llm.units import word_units


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def edited(rng, words, edits, even=False):
    out = list(words)
    for e in range(edits):
        at = (e * len(words) // max(1, edits) if even else rng.randrange(len(out))) if out else 0
        kind = rng.random() if not even else 0.5
        if kind < 0.25:
            out.insert(at, f"new{rng.randrange(10**6)}")
        elif kind < 0.4 and len(out) > 1:
            del out[at]
        else:
            out[min(at, len(out) - 1)] = f"new{rng.randrange(10**6)}"
    return out


def test_banded_distance_is_exact():
    rng = random.Random(1)
    for _ in range(400):
        a = np.array([rng.randrange(4) for _ in range(rng.randrange(12))], np.int64)
        b = np.array([rng.randrange(4) for _ in range(rng.randrange(12))], np.int64)
        most = rng.randrange(8)
        assert overlap.edit_distance(a, b, most) == min(brute_distance(a, b), most + 1)


def test_alignment_decides_like_brute_force():
    rng = random.Random(2)
    hits = 0
    for k in range(300):
        a = [rng.randrange(30 if k % 2 else 10**6) for _ in range(rng.randrange(1, 80))]
        b = edited(rng, a, rng.randrange(0, 2 + len(a) // 6))
        b = [hash(x) % 10**9 if isinstance(x, str) else x for x in b]
        edits, common = overlap.align(np.array(a, np.int64), np.array(b, np.int64))
        wanted = brute_distance(a, b)
        within = wanted * 8 <= max(len(a), len(b))
        assert (edits >= 0) == within
        if within:
            assert wanted <= edits <= max(len(a), len(b)) // 8 and common == max(len(a), len(b)) - edits
            hits += 1
    assert hits > 30


def test_least_windows_is_a_bound():
    for gram, window, least, below in overlap.SCHEMES:
        span = gram + window - 1
        for n in range(least, min(below, 400)):
            # evenly spaced edits leave the fewest whole windows; every scheme leaves some
            for m in range(n, n * 8 // 7 + 2):
                whole = m - span + 1 - span * (m // 8)
                assert 1 <= overlap.least_windows(n, gram, window) <= whole
    assert overlap.schemes(6) == [] and overlap.schemes(15) == [0, 1] and overlap.schemes(120) == [1, 2] and overlap.schemes(128) == [2]
    # a pair within the limit has a scheme in common
    for n in range(7, 1000):
        for m in range(n, n * 8 // 7 + 1):
            assert set(overlap.schemes(n)) & set(overlap.schemes(m))
            assert abs(math.log(m) / math.log(overlap.BAND) // 1 - math.log(n) / math.log(overlap.BAND) // 1) <= 1


def test_units_ignore_what_does_not_matter():
    same = word_units("Read /workspace/a/b.txt, ＯＫ 12 中文")
    assert same.tolist() == word_units("read  b.txt ok... 12\n中 文").tolist() == word_units("read /other/place/b.txt ok 12 中文").tolist()
    assert len(word_units("")) == 0


def records(spark, rows):
    df = spark.createDataFrame([(i, t) for i, _, t in rows], "record_id bigint, text string")
    sides = spark.createDataFrame([(i, s) for i, s, _ in rows if s], "record_id bigint, side string").distinct()
    return overlap.sequences(df, sides)


def corpus(seed, n=60):
    """Records of shared phrases, some almost the same; lengths on both sides of every bound."""
    rng = random.Random(seed)
    phrases = [" ".join(f"w{rng.randrange(200)}" for _ in range(9)) for _ in range(25)]
    rows = []
    for i in range(n):
        size = rng.choice([1, 3, 7, 8, 9, 15, 16, 17, 40, 64, 100, 112, 120, 127, 128, 130, 160, 300])
        words = " ".join(rng.choice(phrases) if rng.random() < 0.6 else " ".join(f"u{rng.randrange(10**6)}" for _ in range(5)) for _ in range(size // 5 + 1)).split()[:size]
        rows.append((10 * i, rng.choice("ab"), " ".join(words)))
        for c in range(rng.randrange(3)):
            edits = rng.choice([0, len(words) // 16, len(words) // 8, len(words) // 8 + 1])
            rows.append((10 * i + c + 1, rng.choice("ab"), " ".join(edited(rng, words, edits, even=rng.random() < 0.5))))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_pairs_match_brute_force(spark, seed, monkeypatch):
    if seed:
        monkeypatch.setattr(lookup, "LOOK_UP", 0)  # the way beyond the broadcast
    rows = corpus(seed)
    seqs = records(spark, rows)
    got = [tuple(r) for r in overlap.record_pairs(overlap.similar_classes(seqs), overlap.members(seqs)).collect()]
    wanted = set()
    units = {i: word_units(t).tolist() for i, _, t in rows}
    for i, s, _ in rows:
        for j, r, _ in rows:
            if s == "a" and r == "b" and units[i] and units[j]:
                longer = max(len(units[i]), len(units[j]))
                if abs(len(units[i]) - len(units[j])) * 8 <= longer and brute_distance(units[i], units[j]) * 8 <= longer:
                    wanted.add((min(i, j), max(i, j)))
    assert len(got) == len(set(got)) and set(got) == wanted and wanted


def test_frequent_fingerprints_lose_nothing(spark):
    """One template in all records, more than the sample: its fingerprints are told beforehand."""
    rng = random.Random(9)
    template = [f"t{i}" for i in range(60)]
    rows, wanted = [], set()
    for i in range(300):
        own = [f"o{i}_{k}" for k in range(90)]
        rows.append((2 * i, "a", " ".join(template + own)))
        if i % 10 == 0:
            rows.append((2 * i + 1, "b", " ".join(edited(rng, template + own, 18, even=True))))
            wanted.add((2 * i, 2 * i + 1))
        else:
            rows.append((2 * i + 1, "b", " ".join(template + [f"p{i}_{k}" for k in range(90)])))
    seqs = records(spark, rows)
    assert len(overlap.frequent_prints(seqs, "record_id")[0]) > 30
    got = {tuple(r) for r in overlap.record_pairs(overlap.similar_classes(seqs), overlap.members(seqs)).collect()}
    assert got == wanted
    assert overlap.candidate_pairs(seqs).count() < 5_000


def test_copies_links_and_coverage(spark):
    text = " ".join(f"x{i}" for i in range(40))
    rows = [(1, "a", text), (2, "a", text.upper()), (3, "b", text), (4, "b", " ".join(text.split()[:-2] + ["y", "z"])), (5, "b", "other words here"), (6, "a", None), (7, "b", ""), (8, "", text), (3, "b", text)]
    seqs = records(spark, rows)
    similar = overlap.similar_classes(seqs)
    assert {tuple(r) for r in overlap.record_pairs(similar, overlap.members(seqs)).collect()} == {(1, 3), (2, 3), (1, 4), (2, 4)}
    got = {r["record_id"]: (r["links"], r["coverage"]) for r in overlap.class_links(similar, overlap.members(seqs)).collect()}
    assert got == {1: (2, 1.0), 2: (2, 1.0), 3: (2, 1.0), 4: (2, 0.95), 5: (0, 0.0), 6: (0, 0.0), 7: (0, 0.0)}


def test_coverage_below_the_limit(spark):
    """A record that holds half of another one's text is no case, but covered to that share."""
    word = lambda p, n: [f"{p}{i}" for i in range(n)]
    rows = [(1, "a", " ".join(word("x", 200))), (2, "b", " ".join(word("x", 100) + word("y", 100))), (3, "b", " ".join(word("z", 200))), (4, "b", " ".join(word("x", 200)[:-4] + word("v", 4)))]
    seqs = records(spark, rows)
    frequent = overlap.frequent_prints(seqs, "record_id")
    shared = overlap.shared_prints(seqs, frequent=frequent)
    got = {r["record_id"]: r for r in overlap.class_links(overlap.similar_classes(seqs, shared), overlap.members(seqs), overlap.containment(seqs, shared, frequent)).collect()}
    assert {k: r["links"] for k, r in got.items()} == {1: 1, 2: 0, 3: 0, 4: 1}
    assert got[1]["coverage"] == 0.98 and got[4]["coverage"] == 0.98 and got[3]["coverage"] == 0.0 and abs(got[2]["coverage"] - 0.5) < 0.04


def test_frequent_fingerprints_are_counted_exactly(spark):
    """Phrases about the limit, of all rows and not of a sample, some in one stretch of the table and some on one side."""
    rng = random.Random(4)
    n, rows = 3_000, []
    holders = {}
    for p in range(24):
        size = 18 + p
        side = range(n) if p % 3 else range(0, n, 2)
        holders[p] = set(rng.sample(side, size)) if p % 2 else set(side[100 * p : 100 * p + size])
    for i in range(n):
        words = [f"o{i}x{k}" for k in range(8)]
        for p in (p for p in holders if i in holders[p]):
            words += [f"p{p}x{k}" for k in range(7)]
        rows.append((i, "ab"[i % 2], " ".join(words)))
    seqs = records(spark, rows)
    df, in_a = {}, {}
    for _, side, text in rows:
        units = word_units(text)
        units = (units ^ (units >> 32)).astype(np.int32).astype(np.int64)
        for h in (h for k in overlap.schemes(len(units)) for h in overlap.fingerprints(units, k)[0].tolist()):
            df[h] = df.get(h, 0) + 1
            in_a[h] = in_a.get(h, 0) + (side == "a")
    wanted = {h: 0 < in_a[h] < df[h] for h in df if df[h] >= 30}
    assert set(wanted.values()) == {True, False} and any(25 < d < 30 for d in df.values())
    for some, small in ((seqs, {}), (seqs.repartition(5), {"chunk": 400})):
        prints, ranks = overlap.frequent_prints(some, "record_id", **small)
        assert (np.diff(prints) > 0).all() and {h: r >= 0 for h, r in zip(prints.tolist(), ranks.tolist())} == wanted
        both = [df[h] for _, h in sorted(zip(ranks.tolist(), prints.tolist())) if wanted[h]]
        assert both == sorted(both)


def test_coverage_counts_frequent_windows_by_side(spark):
    """A phrase of many records is coverage if it stands on the other side, and none if it stands on this side only."""
    word = lambda p, n: [f"{p}{i}" for i in range(n)]
    rows = []
    for i in range(60):
        a, b = word("only", 80) + word("both", 20) + word(f"a{i}x", 100), word("both", 20) + word(f"b{i}x", 180)
        rows += [(2 * i, "a", " ".join(a)), (2 * i + 1, "b", " ".join(b))]
    rows.append((500, "a", " ".join(word("both", 20) + word("c", 110))))
    seqs = records(spark, rows)
    frequent = overlap.frequent_prints(seqs, "record_id")
    shared = overlap.shared_prints(seqs, frequent=frequent)
    got = {r["record_id"]: r for r in overlap.class_links(overlap.similar_classes(seqs, shared), overlap.members(seqs), overlap.containment(seqs, shared, frequent)).collect()}
    seen = {r["record_id"]: (r["side"], np.frombuffer(r["units"], np.int32).astype(np.int64)) for r in seqs.collect()}
    prints = {x: {h for side, u in seen.values() if side == x for k in overlap.schemes(len(u)) for h in overlap.fingerprints(u, k)[0].tolist()} for x in "ab"}
    for rec, (side, u) in seen.items():
        shares = []
        for k in overlap.schemes(len(u)):
            h, count, _ = overlap.fingerprints(u, k)
            shares.append(sum(c for x, c in zip(h.tolist(), count.tolist()) if x in prints["b" if side == "a" else "a"]) / count.sum())
        assert got[rec]["links"] == 0 and got[rec]["coverage"] == round(max(shares), 6)
    assert 0.05 < got[0]["coverage"] < 0.12 and 0.08 < got[500]["coverage"] < 0.16


def test_empty_tables_and_system_messages(spark):
    assert overlap.record_pairs(*(lambda s: (overlap.similar_classes(s), overlap.members(s)))(records(spark, [(1, "a", "x")]).filter("false"))).count() == 0
    kind = "m array<struct<role:string,content:string>>"
    df = spark.createDataFrame([([("system", "s"), ("user", "u"), ("tool", None), ("assistant", "v"), (None, "w")],), (None,)], kind)
    assert [r[0] for r in df.select(overlap.conversation("m")).collect()] == ["u\n\nv", None]
