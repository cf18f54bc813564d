"""Token estimates from character counts, by ratios measured on calibrated records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import nearest_rank


def ratios(calibration: DataFrame) -> DataFrame:
    """p05, p50 and p95 of tokens a character and p50 of the supervised ratio: per family and type, per family
    (type null) and of all (both null), in one pass over the calibrated records."""
    per_char = F.col("input_tokens") / F.greatest(F.lit(1), F.col("characters"))
    levels = F.array(
        F.struct(F.lit(2).alias("level"), F.col("source_family"), F.col("type")),
        F.struct(F.lit(1).alias("level"), F.col("source_family"), F.lit(None).cast("string").alias("type")),
        F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("source_family"), F.lit(None).cast("string").alias("type")),
    )
    rows = calibration.select(F.explode(levels).alias("_g"), per_char.alias("chars"), F.col("supervised_ratio").alias("supervised")).select("_g.*", "chars", "supervised")
    by = ["level", "source_family", "type"]
    found = nearest_rank(rows, by, ["chars", "supervised"], [0.05, 0.5, 0.95])
    return found.select("source_family", "type", "chars_p05", "chars_p50", "chars_p95", "supervised_p50")


def tokens(characters: Column, ratio: Column) -> Column:
    """characters x ratio, rounded half-even, at least 1."""
    return F.greatest(F.lit(1), F.rint(characters * ratio).cast("bigint"))


def estimate(rows: DataFrame, calibration: DataFrame, exact: DataFrame | None = None) -> DataFrame:
    """rows with estimate, low, high, supervised and token_method.

    The ratios of the row's family and type hold, else those of its family, else those of all. exact, if
    given, has source_file, source_line, input_tokens and supervised_tokens (one row a place): counts that
    are reused instead ('exact_reused'), without low and high.
    The ratio tables have one row for each family and type, a bounded list.
    """
    table = ratios(calibration)
    fields = ["chars_p05", "chars_p50", "chars_p95", "supervised_p50"]
    renamed = lambda d, prefix: d.select(*(c for c in d.columns if c not in fields), *(F.col(f).alias(f"{prefix}_{f}") for f in fields))
    both = renamed(table.filter("type IS NOT NULL"), "g")
    family = renamed(table.filter("type IS NULL AND source_family IS NOT NULL").drop("type"), "f")
    # the one row of all is put beside the family rows, so no cross join is needed; unknown families take it by the key ''
    everything = renamed(table.filter("source_family IS NULL").select(F.lit(0).alias("_k"), *fields), "a")
    out = rows.withColumn("_k", F.lit(0)).join(both, ["source_family", "type"], "left").join(family, "source_family", "left").join(everything, "_k", "left").drop("_k")
    pick = lambda f: F.coalesce(*(F.col(f"{p}_{f}") for p in "gfa"))
    guess = tokens(F.col("characters"), pick("chars_p50"))
    out = out.withColumns(
        {
            "estimate": guess,
            "low": tokens(F.col("characters"), pick("chars_p05")),
            "high": tokens(F.col("characters"), pick("chars_p95")),
            "supervised": tokens(guess, pick("supervised_p50")),
            "token_method": F.lit("estimated_by_calibration"),
        }
    ).drop(*(f"{p}_{f}" for p in "gfa" for f in fields))
    if exact is None:
        return out
    known = exact.select("source_file", "source_line", F.col("input_tokens").alias("_in"), F.col("supervised_tokens").alias("_sup"))
    out = out.join(known, ["source_file", "source_line"], "left")
    reused = F.col("_in").isNotNull()
    keep = {c: F.when(~reused, F.col(c)) for c in ("low", "high")}
    return out.withColumns(keep | {"estimate": F.coalesce("_in", "estimate"), "supervised": F.when(reused, F.col("_sup")).otherwise(F.col("supervised")), "token_method": F.when(reused, "exact_reused").otherwise(F.col("token_method"))}).drop("_in", "_sup")


def boundary_sensitive(low: str, high: str, bounds: list[int]) -> Column:
    """How many rows have a bound in [low, high); an aggregate."""
    return F.count_if(F.exists(F.array(*map(F.lit, bounds)), lambda b: (F.col(low) <= b) & (b < F.col(high))))
