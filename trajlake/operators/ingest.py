"""Deduplication and conflict rules for rows that arrive more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_wins(df: DataFrame, by: list[str], order: list[Column | str]) -> DataFrame:
    """One row for each key: the one that comes last in the order (nulls first). Columns stay as they are.

    A pre-aggregated maximum: a key of a third of all rows sends one row a task. The order should end in
    something unique, or which of equal rows stays is open.
    """
    rest = [c for c in df.columns if c not in by]
    rows = df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return rows.select(*by, "_r.*").select(*df.columns)


def conflicts(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """by, n_values and conflict: whether a key has more than one value; null counts as a value."""
    shown = F.coalesce(value.cast("string"), F.lit("\0null"))
    # minimum and maximum tell a conflict without a distinct count, so no second shuffle by value
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_seen"), (F.min(shown) != F.max(shown)).alias("conflict"))


def first_of_key(df: DataFrame, by: list[str], fingerprint: str, order: list[str]) -> DataFrame:
    """One row for each key whose rows all have the first row's fingerprint: the latest such row; with `conflict`.

    A key with a differing fingerprint is a conflict; its row is the latest among those that equal the first.
    """
    first = df.groupBy(*by).agg(F.min_by(fingerprint, F.struct(*order)).alias("_first"), F.min(fingerprint).alias("_lo"), F.max(fingerprint).alias("_hi"))
    same = df.join(first, by).filter(F.col(fingerprint) == F.col("_first"))
    rest = [c for c in df.columns if c not in by]
    rows = same.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"), F.max(F.col("_lo") != F.col("_hi")).alias("conflict"))
    return rows.select(*by, "_r.*", "conflict")


def ordinals(df: DataFrame, by: list[str], order: list[Column | str], name: str = "ordinal") -> DataFrame:
    """The 1-based position of each row in its group, by the given order (which should be total)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def require_unique(df: DataFrame, by: list[str]) -> DataFrame:
    """df, if no key repeats; else ValueError that names up to ten keys."""
    twice = df.groupBy(*by).count().filter("count > 1").select(*by).limit(10).collect()
    if twice:
        raise ValueError(f"repeated keys {by}: {[tuple(r) for r in twice]}")
    return df


def require_complete(wanted: DataFrame, present: DataFrame, by: list[str]) -> DataFrame:
    """present, if it has every key of wanted; else ValueError that names up to ten missing keys."""
    gone = wanted.join(present, by, "left_anti").select(*by).limit(10).collect()
    if gone:
        raise ValueError(f"missing {by}: {[tuple(r) for r in gone]}")
    return present


def reconcile(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """One row: keys on both sides, on the left only and on the right only; keys count once, null keys never match."""
    sides = left.select(*by, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(right.select(*by, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    keys = sides.groupBy(*by).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return keys.agg(
        F.count_if((F.col("_l") == 1) & (F.col("_r") == 1)).alias("both_sides"),
        F.count_if(F.col("_r") == 0).alias("left_only"),
        F.count_if(F.col("_l") == 0).alias("right_only"),
    )


def merge_exact(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Full-key join in which every key must be on both sides; shared columns come from the left.

    The check is part of the plan: a row without a partner raises when it is computed.
    """
    only = [c for c in right.columns if c not in left.columns]
    l, r = left.withColumn("_l", F.lit(1)), right.select(*by, *only).withColumn("_r", F.lit(1))
    rows = l.join(r, by, "full_outer")
    ok = F.assert_true(F.col("_l").isNotNull() & F.col("_r").isNotNull(), "key sets differ").isNull()
    return rows.filter(ok).select(*left.columns, *only)
