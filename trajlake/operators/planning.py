"""Curriculum plans: gates, best of duplicates, source-diverse limits, longest and nearest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.labels import LONG_PHASE, TIERS, any_of, cases, phase

# How the nearest-row search ranks the tiers; other than a plan's order.
BENCHMARK_TIERS = ("sql_result_verified", "report_rule_only", "kb_rule_only", "judge_rule_only")


def position(c: Column, names: tuple[str, ...], otherwise: int) -> Column:
    return cases([(c == n, F.lit(i)) for i, n in enumerate(names)], F.lit(otherwise))


def gate_reasons(min_ratio: float = 0.10, min_final_chars: int = 50) -> Column:
    """All reasons for which a row is left out of a plan, empty if none; null metrics give no reason."""
    return any_of(
        [
            (F.col("supervised_ratio") < min_ratio, "low_supervised_ratio"),
            (F.col("final_assistant_chars") < min_final_chars, "short_final_answer"),
            (F.col("secret_pattern_hits") > 0, "secret_pattern"),
            (F.col("destructive_commands") > 0, "destructive_command"),
            (F.col("network_commands") > 0, "network_command"),
        ]
    )


def gated(rows: DataFrame, production_max: int = 16_384, min_ratio: float = 0.10, min_final_chars: int = 50) -> DataFrame:
    """rows with phase and reasons; a row of no phase has the one reason over_32k."""
    reasons = F.when(F.col("phase").isNull(), F.array(F.lit("over_32k"))).otherwise(gate_reasons(min_ratio, min_final_chars))
    return rows.withColumn("phase", phase(F.col("input_tokens"), production_max)).withColumn("reasons", reasons)


def reason_counts(rows: DataFrame) -> DataFrame:
    """Rows per reason; a row counts under each of its reasons."""
    return rows.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def plan_order() -> list[Column]:
    """The total order of plan rows, best first; ends in the location, so it is the same on every run."""
    return [
        position(F.col("quality_tier"), TIERS, 9).asc(),
        (F.coalesce("network_commands", F.lit(0)) > 0).asc(),
        F.least(F.coalesce("tool_error_messages", F.lit(0)), F.lit(20)).asc(),
        F.least(F.coalesce("duplicate_tool_calls", F.lit(0)), F.lit(20)).asc(),
        (F.coalesce("nonportable_path_occurrences", F.lit(0)) > 0).asc(),
        F.col("input_tokens").asc(),
        F.col("supervised_ratio").desc(),
        F.col("final_assistant_chars").desc(),
        F.col("source_file").asc(),
        F.col("source_line").asc(),
    ]


def best_of(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in the given order; null keys form a group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def first_k(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group in the given order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n")


def diverse_k(rows: DataFrame, by: list[str], source: str, order: list[Column], k: int) -> DataFrame:
    """At most k rows of each group: first the best row of each source, best first, then the rest in order.

    A row beyond the k-th of its group and source can't be among the k chosen, so those go first; Spark
    drops them before the shuffle, and a group of a third of all rows is cut down where it is read.
    """
    few = rows.withColumn("_s", F.row_number().over(Window.partitionBy(*by, source).orderBy(*order))).filter(F.col("_s") <= k)
    w = Window.partitionBy(*by).orderBy((F.col("_s") > 1).asc(), *order)
    return few.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_s", "_n")


def upper_tokens() -> Column:
    """The high estimate where there is one, else the count."""
    return F.coalesce("input_tokens_estimate_high", "input_tokens")


def longest(rows: DataFrame, n: int, max_tokens: int) -> DataFrame:
    """The n longest train rows outside the long phase within max_tokens; ties by tokens, file and line, all descending."""
    ok = (F.col("split") == "train") & (F.col("phase") != LONG_PHASE) & (upper_tokens() <= max_tokens)
    return rows.filter(ok).orderBy(upper_tokens().desc(), F.col("input_tokens").desc(), F.col("source_file").desc(), F.col("source_line").desc()).limit(n)


def exactly(rows: DataFrame, n: int) -> DataFrame:
    """rows, if they are n; else ValueError."""
    got = rows.count()
    if got != n:
        raise ValueError(f"{got} rows where {n} are needed")
    return rows


def nearest(rows: DataFrame, targets: list[int], min_ratio: float = 0.10) -> DataFrame:
    """For each target the row nearest to it in tokens: best by (distance, low ratio, tier, -supervised, file, line).

    Each row is compared with each of the few targets where it is read; one minimum per task is shuffled.
    """
    targets = sorted({int(t) for t in targets})
    if not targets or targets[0] <= 0:
        raise ValueError("targets must be positive")
    known = rows.filter("input_tokens IS NOT NULL")
    spread = known.select("*", F.explode(F.array(*map(F.lit, targets))).alias("target"))
    rank = F.struct(
        F.abs(F.col("input_tokens") - F.col("target")),
        (F.coalesce("supervised_ratio", F.lit(0.0)) < min_ratio),
        position(F.col("quality_tier"), BENCHMARK_TIERS, 4),
        -F.coalesce("supervised_tokens", F.lit(0)),
        F.col("source_file"),
        F.col("source_line"),
    )
    return spread.groupBy("target").agg(F.min_by(F.struct(*rows.columns), rank).alias("_row")).select("target", "_row.*")


def parse_targets(text: str) -> list[int]:
    """The distinct positive numbers of a comma-separated list, ascending; ValueError for others, or for none."""
    targets = sorted({int(t) for t in text.split(",") if t.strip()})
    if not targets or targets[0] <= 0:
        raise ValueError("targets must be positive")
    return targets
