"""Splitting oversized texts at natural boundaries (problem 8).

A text is encoded, and each token becomes one character that tells the strength of the boundary after
it. A regular expression with bounded quantifiers, its alternatives ordered by strength, then takes
one piece after the other from this string; positions, overlap and text of the pieces follow by SQL
array functions. Bounds are in tokens, so the limit holds exactly. The text goes along as an array of
what each token completes, so a piece is a slice and costs its own length, not that of its text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .encode import CHUNK_CHARS
from .vocab import default_vocab, encoder, safe_parts, token_bytes

# The strengths, weakest first. x is no end of a character.
STRENGTHS = "xcwkslp"
NAMES = {"p": "paragraph", "l": "line", "s": "sentence", "k": "clause", "w": "word", "c": "character"}
# What ends a sentence or a clause; closing quotes and brackets go with it.
SENTENCE = r"(?:(?<![.!?])[.!?]++[\"')\]]*+(?=\s|$)|(?<![。！？；…])[。！？；…]++[”’」』）]*+)"
CLAUSE = r"(?:[,;:](?=\s)|[，、：])"
WORD = r"(?<=\p{L})(?=[^\p{L}])|(?<=\p{N})(?=[^\p{N}])"
BREAKS = "\r\u2028\u2029"
#: A character has at most four bytes, so at most three tokens end inside it.
INSIDE = 3
#: Tokens of the texts that are sent to the JVM in one batch, about.
BATCH_TOKENS = 500_000


def _ids(text: str, path: str) -> list[int]:
    enc, ids = encoder(path).encode_ordinary, []
    for part in safe_parts(text, CHUNK_CHARS):
        ids.extend(enc(part))
    return ids


def _classes(text: str, ids: list[int], path: str) -> tuple[str, list[str], np.ndarray]:
    """Strength after each token; the characters that each token completes; and of each token how many
    tokens right before it end inside a character.

    A boundary reaches over the white space that follows it, as tokens may end anywhere in it.
    """
    import regex

    table = token_bytes(path)
    raw = np.frombuffer(text.encode(), np.uint8)
    starts = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # first byte of each character
    ends = np.cumsum([len(table[i]) for i in ids])
    chars = np.searchsorted(starts, ends, side="right") - 1  # characters completed up to each token's end
    whole = starts[chars] == ends
    level = whole.astype(np.uint8)

    def raise_to(strength: int, spans: list[tuple[int, int]]):
        if spans:
            lo, hi = np.array(spans).T
            edges = np.zeros(len(ids) + 1, np.int32)
            np.add.at(edges, np.searchsorted(chars, lo, side="left"), 1)
            np.add.at(edges, np.searchsorted(chars, hi, side="right"), -1)
            level[(np.cumsum(edges[:-1]) > 0) & whole] = strength

    blanks: dict[int, list[tuple[int, int]]] = {2: [m.span() for m in regex.finditer(WORD, text)], 5: [], 6: []}
    for m in regex.finditer(r"\s+", text):
        run = m.group()
        lines = run.count("\n")
        blanks[6 if lines > 1 else 5 if lines or any(b in run for b in BREAKS) else 2].append(m.span())
    raise_to(2, blanks[2])
    for strength, pattern in ((3, CLAUSE), (4, SENTENCE)):
        raise_to(strength, [m.span(1) for m in regex.finditer(pattern + r"(\s*+)", text)])
    raise_to(5, blanks[5])
    raise_to(6, blanks[6])
    cut = [0, *chars.tolist()]
    last_whole = np.maximum.accumulate(np.where(whole, np.arange(len(ids)), -1))
    back = np.append(0, np.arange(len(ids)) - last_whole)[:-1]
    return np.frombuffer(STRENGTHS.encode(), np.uint8)[level].tobytes().decode(), [text[a:b] for a, b in zip(cut, cut[1:])], back


def _classify(path: str, key: str, limit: int):
    def flush(keys, keep):
        at, ids, cls, texts, back = zip(*keep)
        columns = [keys.take(pa.array(at)), pa.array(ids, pa.list_(pa.int32())), pa.array(cls, pa.string()), pa.array(texts, pa.list_(pa.string())), pa.array(back, pa.list_(pa.int8()))]
        return pa.RecordBatch.from_arrays(columns, [key, "ids", "cls", "texts", "back"])

    def run(batches):
        for batch in batches:
            keep: list[tuple] = []
            held = 0
            for i, t in enumerate(batch.column("text").to_pylist()):
                ids = _ids(t, path)
                if len(ids) <= limit:
                    continue
                keep.append((i, ids, *_classes(t, ids, path)))
                held += len(ids)
                if held >= BATCH_TOKENS:
                    yield flush(batch.column(key), keep)
                    keep, held = [], 0
            if keep:
                yield flush(batch.column(key), keep)

    return run


def piece_pattern(room: int) -> str:
    """Takes at most `room` tokens: the rest if it fits, else up to the strongest boundary in the last half,
    else up to the strongest boundary at all, else up to the last end of a character."""
    half = max(1, room // 2)
    tail = [f"[a-z]{{1,{room}}}$"]
    near = [f"[a-z]{{{half - 1},{room - 1}}}{s}" for s in "plskw"]
    far = [f"[a-z]{{0,{room - 1}}}{s}" for s in "plskwc"]
    return "|".join(tail + near + far)


def split(df: DataFrame, limit: int, overlap: int, key: str = "doc_id", text: str = "text", vocab: str | None = None) -> DataFrame:
    """The pieces of every text of more than `limit` tokens; shorter, empty and null texts give no row.

    Columns: key, piece (from 0), begin_token, n_tokens, boundary (name of the strength after it; 'end'),
    ids, text. A piece has at most `limit` tokens. Each piece but the first repeats the last `overlap`
    tokens of the piece before it, up to three more where the overlap would begin inside a character.
    Rows of one key are split each for itself; a null key is an ordinary key.
    A token has at least one byte, so texts of at most `limit` bytes are passed over unread by Python.
    """
    if overlap < 0 or limit - overlap - INSIDE < 8:
        raise ValueError("the limit must exceed the overlap by at least 11 tokens")
    room = limit - overlap - INSIDE
    kind = df.schema[key].dataType.simpleString()
    long = df.select(key, F.col(text).alias("text")).filter(F.octet_length("text") > limit)
    big = long.mapInArrow(_classify(vocab or default_vocab(), key, limit), f"`{key}` {kind}, ids array<int>, cls string, texts array<string>, back array<tinyint>")
    big = big.withColumn("taken", F.regexp_extract_all("cls", F.lit(piece_pattern(room)), F.lit(0)))
    # where each piece's new tokens begin, by a running sum
    big = big.withColumn("sums", F.aggregate("taken", F.array(F.lit(0)), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(s)))))

    def cut(s, i):
        fresh, end = F.element_at("sums", i + 1), F.element_at("sums", i + 2)
        overlapped = F.greatest(F.lit(0), fresh - overlap)
        # tokens before it that end inside a character are drawn in
        begin = F.when(i == 0, F.lit(0)).otherwise(overlapped - F.element_at("back", overlapped + 1))
        named = F.lit(None).cast("string")
        for sign, name in NAMES.items():
            named = F.when(F.right(s, F.lit(1)) == sign, name).otherwise(named)
        n = end - begin
        return F.struct(
            i.alias("piece"),
            begin.alias("begin_token"),
            n.alias("n_tokens"),
            F.when(end == F.size("ids"), "end").otherwise(named).alias("boundary"),
            F.slice("ids", begin + 1, n).alias("ids"),
            F.array_join(F.slice("texts", begin + 1, n), "").alias("text"),
        )

    # the pieces alone go through the explode; every text has some, and the outer form keeps the optimizer
    # from testing that by a filter that computes all of them a second time
    return big.select(key, F.transform("taken", cut).alias("_pieces")).select(key, F.inline_outer("_pieces"))


def oversized(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """The texts that were split: those of which there is a second piece."""
    return pieces.filter(F.col("piece") == 1).select(key)


def violated(pieces: DataFrame, sizes: DataFrame, limit: int, overlap: int, key: str = "doc_id") -> DataFrame:
    """key, piece and fault of what breaks a rule: none, if split works. sizes: key (unique) and n_tokens of every text.

    A text above the limit has pieces from 0 on, each within the limit and beginning `overlap` to
    `overlap` + INSIDE tokens before the end of the one before, the last one ending the text; texts within it have none.
    """
    w = Window.partitionBy(key).orderBy("piece")
    end = F.col("begin_token") + F.col("n_tokens")
    rows = pieces.select(key, "piece", "begin_token", "n_tokens", "boundary", F.size("ids").alias("n_ids"), end.alias("end"))
    rows = rows.withColumns({"before": F.lag("end").over(w), "place": F.row_number().over(w) - 1, "last": F.max("piece").over(Window.partitionBy(key)) == F.col("piece")})
    rows = rows.join(sizes.filter(F.col("n_tokens") > limit).select(key, F.col("n_tokens").alias("whole")), key, "full_outer")
    back = F.col("before") - F.col("begin_token")
    faults = [
        (F.col("whole").isNull(), "text within the limit"),
        (F.col("piece").isNull(), "text without pieces"),
        (F.col("piece") != F.col("place"), "number"),
        ((F.col("n_tokens") > limit) | (F.col("n_tokens") < 1) | (F.col("n_ids") != F.col("n_tokens")), "size"),
        (F.col("before").isNull() & (F.col("begin_token") != 0), "beginning"),
        ((back > overlap + INSIDE) | ((back < overlap) & (F.col("begin_token") > 0)), "overlap"),
        (F.col("last") & ((F.col("end") != F.col("whole")) | (F.col("boundary") != "end")), "end"),
    ]
    fault = F.lit(None).cast("string")
    for wrong, name in reversed(faults):
        fault = F.when(wrong, name).otherwise(fault)
    return rows.select(key, F.col("piece").cast("bigint").alias("piece"), fault.alias("fault")).filter("fault IS NOT NULL")
