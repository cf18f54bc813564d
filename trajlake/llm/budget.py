"""Token budgets (problem 3).

Texts are split into pre-tokens, and the merges run once for each distinct pre-token of a task
(bpe.symbol_count); the surviving symbols, weighted by how often the pre-token occurs, are the exact
count. Texts are counted where they are read: only numbers are shuffled, neither texts nor pre-tokens,
so a frequent pre-token or a group of a third of all rows costs no more than others.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions import keys
from trajlake.session import work_table

from .bpe import symbol_count
from .encode import CHUNK_CHARS
from .lookup import small
from .vocab import default_vocab, ranks, safe_parts, splitter

#: Distinct pre-tokens whose counts a task remembers before it starts anew.
MEMO = 500_000


def _count(path: str, text: str):
    def run(batches):
        table, find = ranks(path), splitter().findall
        memo: dict[str, int] = {}

        def tokens(t):
            total = 0
            for part in safe_parts(t, CHUNK_CHARS):
                pieces = find(part)
                try:
                    # each occurrence adds the count of its piece: the counts weighted by frequency
                    total += sum(map(memo.__getitem__, pieces))
                except KeyError:
                    if len(memo) > MEMO:
                        memo.clear()
                    for piece, n in Counter(pieces).items():
                        if (size := memo.get(piece)) is None:
                            size = memo[piece] = symbol_count(piece.encode(), table)
                        total += size * n
            return total

        for batch in batches:
            counts = pa.array([tokens(t) if t else 0 for t in batch.column(text).to_pylist()], pa.int64())
            at = batch.schema.get_field_index(text)
            yield batch.remove_column(at).append_column("tokens", counts)

    return run


def with_tokens(df: DataFrame, text: str, vocab: str | None = None) -> DataFrame:
    """df without the text, but with tokens, its exact number of tokens; 0 for null and empty texts."""
    rest = [c for c in df.columns if c != text]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest), "tokens bigint"])
    return df.select(*rest, text).mapInArrow(_count(vocab or default_vocab(), text), schema)


def document_budget(documents: DataFrame, vocab: str | None = None) -> DataFrame:
    """Per source, lang and domain (canonical spellings; unknown for null): documents, characters, tokens.

    Each doc_id counts once, a null one as any other; should its rows differ, with the largest of their
    numbers and the first of their groups by hash. Null and empty texts count as documents of no token.
    Groups are told by a 64-bit hash in the rows that are shuffled, and named again by a join on the far
    smaller group table.
    """
    docs = documents.select(
        "doc_id",
        "text",
        keys.source_key(F.col("source")).alias("source"),
        keys.lang_key(F.col("lang")).alias("lang"),
        keys.label_key(F.col("domain")).alias("domain"),
    ).withColumn("grp", F.xxhash64("source", "lang", "domain"))
    rows = with_tokens(docs.select("doc_id", "grp", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("characters"), "text"), "text", vocab)
    once = rows.groupBy("doc_id").agg(F.min("grp").alias("grp"), F.max("characters").alias("characters"), F.max("tokens").alias("tokens"))
    totals = once.groupBy("grp").agg(F.count(F.lit(1)).alias("documents"), F.sum("characters").alias("characters"), F.sum("tokens").alias("tokens"))
    names = docs.select("grp", "source", "lang", "domain").distinct()
    return totals.join(names, "grp").select("source", "lang", "domain", "documents", "characters", "tokens")


def unusable(characters: Column, input_tokens: Column, supervised_tokens: Column) -> Column:
    """True where a count can't be used; never null: null characters or supervised_tokens prove nothing."""
    return F.coalesce(
        input_tokens.isNull() | (input_tokens <= 0) | (input_tokens * 20 < characters) | (input_tokens > characters * 4) | (supervised_tokens > input_tokens),
        F.lit(False),
    )


UNUSABLE_SQL = "(input_tokens IS NULL OR input_tokens <= 0 OR input_tokens * 20 < characters OR input_tokens > characters * 4 OR supervised_tokens > input_tokens)"


def record_budget(catalog: DataFrame, trajectories: DataFrame, vocab: str | None = None) -> DataFrame:
    """One row per record_id: family, type, input_tokens, supervised_tokens and how they were come by.

    Of repeated rows the last cataloged_at counts. method is 'catalog' where the catalog's counts can be
    used; 'counted' where the record's own text (content and reasoning, as in `characters`) was counted
    with the vocabulary instead; 'ratio' where the text is missing too: characters at the family and
    type's ratio of tokens to characters, or the ratio of all records.
    Of several deliveries of the text the last one counts (of equally late ones the longest, in tokens).
    The supervised tokens of a replaced count take the share of the usable records of its family and type.
    """
    latest = F.max_by(
        F.struct("source_family", "source_file", "type", "characters", "input_tokens", "supervised_tokens"),
        F.struct("cataloged_at", "input_tokens", "supervised_tokens", "characters"),
    )
    once = catalog.groupBy("record_id").agg(latest.alias("row")).select("record_id", "row.*")
    once = once.select(
        "record_id",
        keys.family_key(F.col("source_family"), F.col("source_file")).alias("source_family"),
        keys.label_key(F.col("type")).alias("type"),
        "characters",
        "input_tokens",
        "supervised_tokens",
        unusable(F.col("characters"), F.col("input_tokens"), F.col("supervised_tokens")).alias("unusable"),
    )
    once = work_table(once, "catalog")
    bad = work_table(once.filter("unusable").select("record_id"), "unusable")
    parts = F.flatten(F.transform("messages", lambda m: F.array(m["content"], m["reasoning_content"])))
    # every delivery is counted where it is read, and the last one's number is taken
    texts = trajectories.join(small(bad), "record_id", "left_semi").select("record_id", "ingested_at", F.array_join(parts, "\n").alias("text"))
    deliveries = with_tokens(texts, "text", vocab)
    counted = deliveries.groupBy("record_id").agg(F.max(F.struct("ingested_at", "tokens"))["tokens"].alias("counted"))

    usable = ~F.col("unusable") & F.col("supervised_tokens").isNotNull() & F.col("characters").isNotNull()
    summed = lambda c: F.sum(F.when(usable, F.col(c)))
    ratios = once.groupBy("source_family", "type").agg(summed("input_tokens").alias("g_in"), summed("supervised_tokens").alias("g_sup"), summed("characters").alias("g_chars"))
    # one row for each family and type, a closed list of a few dozen pairs: small enough for one window and a broadcast
    everywhere = Window.partitionBy(F.lit(1))
    ratios = ratios.select("*", *(F.sum(f"g_{x}").over(everywhere).alias(f"a_{x}") for x in ("in", "sup", "chars")))
    out = once.join(counted, "record_id", "left").join(ratios, ["source_family", "type"], "left")
    ratio = F.coalesce(F.expr("try_divide(g_in, g_chars)"), F.expr("try_divide(a_in, a_chars)"), F.lit(0.0))
    share = F.coalesce(F.expr("try_divide(g_sup, g_in)"), F.expr("try_divide(a_sup, a_in)"), F.lit(0.0))
    by_ratio = F.rint(F.coalesce("characters", F.lit(0)) * ratio).cast("bigint")
    method = F.when(~F.col("unusable"), "catalog").when(F.col("counted").isNotNull(), "counted").otherwise("ratio")
    tokens = F.when(~F.col("unusable"), F.col("input_tokens")).otherwise(F.coalesce("counted", by_ratio))
    out = out.withColumn("tokens", tokens)
    supervised = F.when(~F.col("unusable") & F.col("supervised_tokens").isNotNull(), F.col("supervised_tokens")).otherwise(F.rint(F.col("tokens") * share).cast("bigint"))
    return out.select("record_id", "source_family", "type", F.col("tokens").alias("input_tokens"), supervised.alias("supervised_tokens"), method.alias("method"))


def found_unusable(budget: DataFrame) -> DataFrame:
    """The records whose count the budget had to replace."""
    return budget.filter(F.col("method").isin("counted", "ratio")).select("record_id")


def budget_by_family(budget: DataFrame) -> DataFrame:
    """Exact totals per source_family and type."""
    return budget.groupBy("source_family", "type").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("supervised_tokens").alias("supervised_tokens"),
        F.count_if(F.col("method") != "catalog").alias("replaced"),
    )
