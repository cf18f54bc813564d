import random

import pytest
from pyspark.sql import functions as F

from trajlake.llm import budget, encode, pieces
from trajlake.llm.bpe import symbol_count
from trajlake.llm.vocab import decode, default_vocab, encoder, ranks, safe_parts, splitter

PATH = default_vocab()
ODD = ["", None, " ", "\n\n\t ", "a", "中文，标点。", "<|endoftext|>", "it's we'll 'tis", "é ‍ 👩‍👩‍👧 \x00\x07", "１２３ ＡＢＣ", "  two  spaces  ", "x" * 3000, " " * 500 + "y", "日本語のテキスト" * 40, "a1b2 " * 900, "\r\n\r\nline\r\n"]


def random_text(rng, n):
    return "".join(rng.choice(["a", "bc", " ", "  ", "\n", "中", "。", "7", "'s", "!", "ä", "👍", "　"]) for _ in range(n))


def brute(t):
    return encoder(PATH).encode_ordinary(t) if t else []


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_symbol_counts_equal_the_encoder():
    rng = random.Random(1)
    words = ["", "a", "hello", " internationalisation", "中文", "aaaaaaaaaaaaaaaaaaaaaaa", "\x00\xff", "==========", *("".join(rng.choice("abcdexyz01 ") for _ in range(rng.randint(1, 30))) for _ in range(500))]
    for text in words:
        for piece in splitter().findall(text):
            assert symbol_count(piece.encode(), ranks(PATH)) == len(brute(piece))
    assert symbol_count(b"a" * 200_000, ranks(PATH)) > 0


def test_safe_parts_keep_the_ids():
    rng = random.Random(2)
    for _ in range(60):
        t = random_text(rng, rng.randint(0, 400))
        assert "".join(safe_parts(t, 20)) == t
        assert [i for p in safe_parts(t, 20) for i in brute(p)] == brute(t)


def test_stitched_ids_equal_those_of_the_whole(spark):
    rng = random.Random(3)
    texts = ODD + [random_text(rng, rng.randint(0, 600)) for _ in range(60)] + ["word " * 3000, "中" * 2000]
    got = {r["doc_id"]: r["ids"] for r in encode.encode_ids(documents(spark, texts), chunk_chars=50, overlap_chars=5).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    counts = {r["doc_id"]: r["n_tokens"] for r in encode.token_counts(documents(spark, texts)).collect()}
    assert counts == {i: len(brute(t)) for i, t in enumerate(texts)}


def test_decoding_is_exact(spark):
    rows = encode.decode_text(encode.encode_ids(documents(spark, ODD))).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == {i: t or "" for i, t in enumerate(ODD)}
    assert decode(brute("中文👍"), PATH) == "中文👍".encode()


def test_empty_table_and_clashing_columns(spark):
    df = documents(spark, ["a"]).withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit(2)).withColumn("seq", F.lit(3))
    assert encode.encode_ids(df).columns == ["doc_id", "ids"] and encode.encode_ids(df).count() == 1
    empty = df.filter("false")
    assert encode.encode_ids(empty).count() == encode.token_counts(empty).count() == 0
    assert pieces.split(empty, 100, 10).count() == 0


def test_counts_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate(ODD + ODD + [random_text(rng, 200) for _ in range(30)])]
    df = spark.createDataFrame(rows, "g bigint, t string")
    assert {r["g"]: r["tokens"] for r in budget.with_tokens(df, "t").collect()} == {g: len(brute(t)) if t else 0 for g, t in rows}


def test_document_budget(spark):
    rows = [(1, "two words", "en-US", "SANDBOX-1", " kb"), (2, None, "eng", "sandbox_1", "KB"), (3, "中文", None, None, None)]
    df = spark.createDataFrame(rows + rows[:1] * 3, "doc_id bigint, text string, lang string, source string, domain string")
    got = {(r["source"], r["lang"], r["domain"]): (r["documents"], r["characters"], r["tokens"]) for r in budget.document_budget(df).collect()}
    assert got == {("sandbox_1", "en", "kb"): (2, 9, len(brute("two words"))), ("unknown", "und", "unknown"): (1, 2, len(brute("中文")))}
    assert budget.document_budget(df.filter("false")).count() == 0


CATALOG = "record_id bigint, source_family string, source_file string, type string, characters bigint, input_tokens bigint, supervised_tokens bigint, cataloged_at timestamp_ntz"


def test_record_budget(spark):
    import datetime

    t = datetime.datetime(2026, 1, 1)
    late = datetime.datetime(2026, 1, 2)
    f = ("quessel-v3", "quessel_1.jsonl", "kb")
    rows = [
        (1, *f, 100, 50, 10, t), (1, *f, 100, 60, 12, late),  # repeated: the later counts
        (2, *f, 100, None, None, t), (3, *f, 100, 0, None, t), (4, *f, 100, 4, 1, t), (5, *f, 100, 401, 1, t), (6, *f, 100, 50, 51, t),
        (7, *f, 100, 5, 5, t), (8, *f, 100, 400, 0, t), (9, *f, None, 40, None, t), (10, None, None, None, None, None, None, None),
    ]
    trajectories = spark.createDataFrame([(i, [("some words here", "and thoughts")], t) for i in (2, 2, 3, 4, 1)], "record_id bigint, messages array<struct<content:string,reasoning_content:string>>, ingested_at timestamp_ntz")
    got = {r["record_id"]: r for r in budget.record_budget(spark.createDataFrame(rows, CATALOG), trajectories).collect()}
    assert {i for i, r in got.items() if r["method"] != "catalog"} == {2, 3, 4, 5, 6, 10}
    n = len(brute("some words here\nand thoughts"))
    assert [got[i]["method"] for i in (2, 5, 10)] == ["counted", "ratio", "ratio"]
    assert got[1]["input_tokens"] == 60 and got[2]["input_tokens"] == n
    # usable and complete: 60 + 5 + 400 tokens of 300 characters
    assert got[5]["input_tokens"] == round(100 * 465 / 300) and got[10]["input_tokens"] == 0
    assert got[2]["supervised_tokens"] == round(n * 17 / 465)
    assert len(got) == 10
    found = budget.found_unusable(budget.record_budget(spark.createDataFrame(rows, CATALOG), trajectories)).collect()
    assert {r["record_id"] for r in found} == {2, 3, 4, 5, 6, 10}
    totals = budget.budget_by_family(budget.record_budget(spark.createDataFrame(rows, CATALOG), trajectories)).collect()
    assert sum(r["records"] for r in totals) == 10 and sum(r["replaced"] for r in totals) == 6


@pytest.mark.parametrize("limit, overlap", [(64, 8), (40, 0), (200, 50)])
def test_pieces(spark, limit, overlap):
    rng = random.Random(limit)
    sentence = lambda: " ".join(rng.choice(["alpha", "beta", "中文字", "x9", "👩‍👧"]) for _ in range(rng.randint(3, 12))) + rng.choice([". ", "。", "\n", "\n\n", ", "])
    texts = ODD + ["".join(sentence() for _ in range(rng.randint(1, 60))) for _ in range(25)] + ["👩‍👩‍👧" * 200, "x" * 5000]
    by_doc = {}
    for r in pieces.split(documents(spark, texts), limit, overlap).orderBy("doc_id", "piece").collect():
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == {i for i, t in enumerate(texts) if len(brute(t)) > limit}
    for i, rows in by_doc.items():
        ids, at = brute(texts[i]), 0
        assert [r["piece"] for r in rows] == list(range(len(rows))) and len(rows) > 1
        for k, r in enumerate(rows):
            assert r["ids"] == ids[r["begin_token"] : r["begin_token"] + r["n_tokens"]] and 0 < r["n_tokens"] <= limit
            assert decode(r["ids"], PATH).decode() == r["text"]
            assert (0 if k == 0 else overlap) <= at - r["begin_token"] <= (0 if k == 0 else overlap + 3)
            at = r["begin_token"] + r["n_tokens"]
        assert at == len(ids) and rows[-1]["boundary"] == "end"


def test_pieces_end_at_the_strongest_boundary(spark):
    text = ("word " * 30 + "end. ") * 3 + "\n\n" + "more words " * 40
    rows = pieces.split(documents(spark, [text]), 140, 10).orderBy("piece").collect()
    assert rows[0]["boundary"] == "paragraph" and {r["boundary"] for r in rows} <= {"paragraph", "sentence", "word", "end"}
    with pytest.raises(ValueError):
        pieces.split(documents(spark, [text]), 20, 15)


def test_far_boundaries_go_by_strength_too(spark):
    """No boundary in the last half: the early paragraph end is taken, not the last end of a character."""
    # every token but the paragraph's is one of a long run without a boundary
    text = "a few words. And more\n\n" + "中" * 150
    rows = pieces.split(documents(spark, [text]), 100, 0).orderBy("piece").collect()
    assert rows[0]["boundary"] == "paragraph" and rows[0]["text"].startswith("a few words. And more\n") and rows[0]["n_tokens"] <= 10
    assert "".join(r["text"] for r in rows) == text
    text = "x, y" + "中" * 150
    assert [r["boundary"] for r in pieces.split(documents(spark, [text]), 100, 0).orderBy("piece").limit(1).collect()] == ["clause"]


def test_boundary_strengths():
    text = "one, two. Three\nfour\n \n five。六：七 8.5 nine"
    ids = brute(text)
    cls, texts, back = pieces._classes(text, ids, PATH)
    assert "".join(texts) == text and len(texts) == len(ids) == len(cls)
    assert back.tolist() == [len(cls[:i]) - len(cls[:i].rstrip("x")) for i in range(len(cls))]
    shown = {"".join(texts[: i + 1]): c for i, c in enumerate(cls) if c != "x"}
    assert shown["one,"] == "k" and shown["one, two."] == "s" and shown["one, two. Three"] == "l" and shown["one, two. Three\nfour"] == "p"
    assert next(c for t, c in shown.items() if t.endswith("。")) == "s" and next(c for t, c in shown.items() if t.endswith("：")) == "k"
    assert next(c for t, c in shown.items() if t.endswith("8.")) not in "sk"


def test_long_runs_are_no_hazard():
    import time

    for text in (" " * 300_000, "." * 300_000, "a" * 300_000, "\n" * 300_000, "，" * 100_000):
        began = time.time()
        ids = pieces._ids(text, PATH)
        assert len(pieces._classes(text, ids, PATH)[0]) == len(ids)
        assert time.time() - began < 20


def test_repeated_keys_and_clashing_names(spark):
    text = "some words and more. " * 40
    df = spark.createDataFrame([(1, text, "x"), (1, text, "y"), (None, text, "z")], "doc_id bigint, text string, ids string")
    rows = pieces.split(df, 64, 8).collect()
    one = len(pieces.split(df.filter("ids = 'x'"), 64, 8).collect())
    assert len(rows) == 3 * one and sum(r["doc_id"] is None for r in rows) == one


def test_violations_are_told(spark):
    text = "some words and more. " * 60
    df = documents(spark, [text, "short"])
    good, sizes = pieces.split(df, 64, 8), encode.token_counts(df)
    assert pieces.violated(good, sizes, 64, 8).count() == 0
    wrong = {
        "size": (good, sizes, 40, 8),
        "overlap": (good, sizes, 64, 12),
        "end": (good.filter("boundary <> 'end'"), sizes, 64, 8),
        "number": (good.filter("piece <> 1"), sizes, 64, 8),
        "text without pieces": (good.filter("false"), sizes, 64, 8),
        "text within the limit": (good, sizes, 1000, 8),
    }
    for fault, given in wrong.items():
        assert fault in {r["fault"] for r in pieces.violated(*given).collect()}
