"""Encoding of a corpus with a public byte-level tokenizer (problem 6), and token counts.

Texts up to `chunk_chars` characters are encoded where they lie, in the scan's partitions. A longer
text is cut into overlapping chunks that are spread over the cluster; each chunk is split into
pre-tokens and encoded on its own, and neighbours are stitched at the first pre-token boundary that
both have in their overlap. From such a boundary on, the split depends on the following text only,
so the stitched ids equal those of the whole text. Every overlap is chosen to hold a boundary that
is certain from its two neighbouring characters, so the stitch always succeeds.

Null and empty texts have the empty list of ids.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vocab import default_vocab, encoder, safe_boundary, safe_parts, splitter

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
#: Rows per returned Arrow batch; bounds what a worker holds besides the incoming batch.
OUT_ROWS = 1_000
#: Distinct pre-tokens a worker remembers before it starts anew.
MEMO = 200_000

_WINDOW = "seq int, text string, starts_doc boolean, ends_doc boolean, zone_end int"


def _field(name: str, df: DataFrame) -> str:
    return f"`{name}` {df.schema[name].dataType.simpleString()}"


def _encode_short(path: str, key: str, text: str, count_only: bool):
    def run(batches):
        encode = encoder(path).encode_ordinary
        for batch in batches:
            keys, texts = batch.column(key), batch.column(text)
            for at in range(0, len(texts), OUT_ROWS):
                part = texts.slice(at, OUT_ROWS).to_pylist()
                if count_only:
                    values = pa.array([sum(len(encode(p)) for p in safe_parts(t, CHUNK_CHARS)) if t else 0 for t in part], pa.int64())
                else:
                    values = pa.array([encode(t) if t else [] for t in part], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([keys.slice(at, OUT_ROWS), values], [key, "n_tokens" if count_only else "ids"])

    return run


def _cut(key: str, text: str, chunk: int, overlap: int):
    """Long texts as overlapping chunks; zone_end is where the overlap with the next chunk ends, from its start."""

    def run(batches):
        for batch in batches:
            for k, t in zip(batch.column(key), batch.column(text).to_pylist()):
                rows: list[tuple] = []
                seq = begin = 0
                while begin < len(t):
                    after = begin + chunk
                    end = len(t)
                    if after < end and (sure := safe_boundary().search(t, after + overlap)):
                        end = min(end, sure.start() + 2)
                    last = end >= len(t)
                    rows.append((seq, t[begin:end], seq == 0, last, -1 if last else end - after))
                    if last:
                        break
                    seq, begin = seq + 1, after
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.as_py()] * len(rows), k.type), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2]), pa.array(cols[3]), pa.array(cols[4], pa.int32())],
                    [key, "seq", "text", "starts_doc", "ends_doc", "zone_end"],
                )

    return run


def _encode_chunks(path: str, key: str, chunk: int):
    def run(batches):
        enc, memo, find = encoder(path), {}, splitter().finditer
        for batch in batches:
            n = {name: batch.column(name) for name in (key, "seq", "text", "ends_doc", "zone_end")}
            for i in range(batch.num_rows):
                ids: list[int] = []
                pos: list[int] = []
                at: list[int] = []
                for m in find(n["text"][i].as_py()):
                    pos.append(m.start())
                    at.append(len(ids))
                    piece = m.group()
                    if (known := memo.get(piece)) is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        known = memo[piece] = enc.encode_ordinary(piece)
                    ids.extend(known)
                yield pa.RecordBatch.from_arrays(
                    [n[key].slice(i, 1), n["seq"].slice(i, 1), n["ends_doc"].slice(i, 1), n["zone_end"].slice(i, 1), pa.array([ids], pa.list_(pa.int32())), pa.array([pos], pa.list_(pa.int32())), pa.array([at], pa.list_(pa.int32()))],
                    [key, "seq", "ends_doc", "zone_end", "ids", "pos", "at"],
                )

    return run


def _stitched(chunks: DataFrame, key: str, chunk: int) -> DataFrame:
    """The chunks' ids in document order, cut at the first boundary that neighbours share."""
    w = Window.partitionBy(key).orderBy("seq")
    tail = F.filter("pos", lambda p: p >= chunk)
    chunks = chunks.withColumn("tail", F.when(~F.col("ends_doc"), F.transform(tail, lambda p: p - chunk)))
    chunks = chunks.withColumn("before", F.lag("tail").over(w)).withColumn("zone_before", F.lag("zone_end").over(w)).withColumn("after", F.lead("pos").over(w))
    # the part of a position array that lies in the overlap zone
    zone = lambda p, end: F.filter(p, lambda x: x < end)
    first = lambda a, b: F.array_min(F.array_intersect(a, b))
    begin = F.when(F.col("before").isNull(), F.lit(0)).otherwise(first(F.col("before"), zone(F.col("pos"), F.col("zone_before"))))
    end = F.when(F.col("ends_doc"), F.lit(None).cast("int")).otherwise(first(F.col("tail"), zone(F.col("after"), F.col("zone_end"))) + F.lit(chunk))
    chunks = chunks.withColumn("cut_from", begin).withColumn("cut_to", end)

    def id_at(p: Column) -> Column:
        return F.element_at("at", F.array_position("pos", p).cast("int"))

    lo = id_at(F.col("cut_from"))
    hi = F.when(F.col("cut_to").isNull(), F.size("ids")).otherwise(id_at(F.col("cut_to")))
    kept = chunks.select(key, "seq", F.slice("ids", lo + 1, hi - lo).alias("part"))
    parts = F.array_sort(F.collect_list(F.struct("seq", "part")))
    return kept.groupBy(key).agg(F.flatten(F.transform(parts, lambda s: s["part"])).alias("ids"))


def encode_ids(df: DataFrame, key: str = "doc_id", text: str = "text", vocab: str | None = None, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """key and ids of every row; key must be unique.

    Null or empty text: the empty list. Strings of special tokens are ordinary text. Rows that share
    the key of a text longer than chunk_chars aren't allowed, as chunks are put together by key.
    """
    path = vocab or default_vocab()
    df = df.select(key, text)
    out = f"{_field(key, df)}, ids array<int>"
    long = F.length(text) > chunk_chars
    short = df.filter(F.coalesce(~long, F.lit(True))).mapInArrow(_encode_short(path, key, text, False), out)
    chunks = df.filter(long).mapInArrow(_cut(key, text, chunk_chars, overlap_chars), f"{_field(key, df)}, {_WINDOW}")
    chunks = chunks.repartition(F.col(key), F.col("seq"))
    encoded = chunks.mapInArrow(_encode_chunks(path, key, chunk_chars), f"{_field(key, df)}, seq int, ends_doc boolean, zone_end int, ids array<int>, pos array<int>, at array<int>")
    return short.unionByName(_stitched(encoded, key, chunk_chars))


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", vocab: str | None = None) -> DataFrame:
    """key and n_tokens of every row; 0 for null or empty text. No shuffle."""
    df = df.select(key, text)
    return df.mapInArrow(_encode_short(vocab or default_vocab(), key, text, True), f"{_field(key, df)}, n_tokens bigint")


def decode_text(df: DataFrame, ids: str = "ids", vocab: str | None = None) -> DataFrame:
    """df with column text: the raw bytes of the ids concatenated, read as UTF-8 (null ids: null)."""
    path = vocab or default_vocab()

    @F.pandas_udf(T.StringType())
    def text_of(column):
        from .vocab import decode

        return column.map(lambda x: None if x is None else decode(x, path).decode("utf-8", "replace"))

    return df.withColumn("text", text_of(F.col(ids)))
